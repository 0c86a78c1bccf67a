"""Readers (S01-S11) and the driver-table loader."""

from tessera.sources.readers import (  # noqa: F401
    delimited,
    inline_rows,
    integer_range,
    quoted_tsv,
    text_lines,
    csv_with_header,
    whole_files,
)
from tessera.sources.tables import SCAN_PARTITIONS, TABLES, load  # noqa: F401
