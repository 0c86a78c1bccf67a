"""Column builders (F01-F20): pure ``Column -> Column`` functions, all JVM-side built-ins."""

from tessera.functions.arrays import (  # noqa: F401
    array_mean,
    flags_to_names,
    squared_distance,
)
from tessera.functions.dates import (  # noqa: F401
    hour_of_epoch,
    hour_of_timestamp,
    iso_weekday,
    time_of_day,
    time_of_day_literal,
    weekend_flag,
)
from tessera.functions.numeric import (  # noqa: F401
    age_from_year,
    clean_numeric,
    safe_half,
    squared_log_error,
)
from tessera.functions.strings import (  # noqa: F401
    WORD_PATTERN,
    parent_folder,
    split_literal,
    strip_quotes,
    title_without_parenthesis,
    tokens,
    year_from_text,
)
