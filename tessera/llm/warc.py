"""WARC archives whose records are compressed one by one against an embedded Zstandard dictionary.

An archive file starts with a skippable frame that holds the dictionary; a ``warcinfo`` record and
the pages' records follow, each a Zstandard frame of its own, so any record can be read alone.
The files are written by Spark's own text sink: a record's frame is one "line", and the separator
is a skippable frame whose only byte is the line feed. So the bytes between records are valid
Zstandard too, files reach any file system that Spark writes to, and lost tasks are redone by
Spark's commit protocol. The reader splits large files at the same separator.

Equal payloads: of records whose payload has at least ``revisit_bytes`` bytes, the one with the
least page id is a ``response``, the others are ``revisit`` records without payload that refer to
it. Hot payloads: the least id is combined before the shuffle, and the join back is one that Spark
splits.

Every record has a ``WARC-Record-ID`` of its own: a uuid made from the writer's run and, for a
response that revisits refer to, its page id and digest, else the task and the place in it. The
``WARC-Date`` is the time of writing, as pages carry no time of capture.

Defined results: null html is an empty payload; a null url leaves out the target; control
characters in a url are percent-encoded; rows that repeat a page id with an equal payload are all
responses if that id is the least (those that others refer to then share a record id); a null page id is larger than any other (its record has no page
number, and if no copy has an id all of them are responses); no pages: no files and no rows.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from datetime import datetime, timezone
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: magic numbers of the Zstandard frame format
SKIP_DICTIONARY = struct.pack("<I", 0x184D2A5D)
#: A skippable frame of one byte, the line feed.
SEPARATOR = struct.pack("<II", 0x184D2A50, 1) + b"\n"

READ_SCHEMA = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
    "payload binary"
)


def payloads(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest``."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest")
    )


def with_record_types(pages: DataFrame, revisit_bytes: int = 100) -> DataFrame:
    """``payloads`` with ``record_type``, ``refers_to`` and ``referred_to`` (whether revisits refer to the row)."""
    rows = payloads(pages)
    first = (
        rows.where(F.col("payload_bytes") >= revisit_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and least is not null")
        .select("payload_digest", "least")
    )
    again = F.col("least").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("least"))
    named = F.col("least").isNotNull() & F.col("page_id").eqNullSafe(F.col("least"))
    return rows.join(first, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("least")).alias("refers_to"), named.alias("referred_to"),
    )


def train_dictionary(records: DataFrame, size: int = 64 << 10, rows: int = 400, row_bytes: int = 16 << 10) -> bytes:
    """A dictionary trained on the first ``row_bytes`` bytes of at most ``rows`` payloads, those
    with the least hashes: about 6 MB at any table size, as the hashes are chosen first. Empty if
    there is too little to train on.
    """
    import zstandard

    full = records.where("payload_bytes > 0").withColumn("h", F.xxhash64("page_id", "payload_digest"))
    last = full.select("h").orderBy("h").limit(rows).agg(F.max("h").alias("h")).first()["h"]
    if last is None:
        return b""
    some = full.where(F.col("h") <= last).select(F.expr(f"substring(payload, 1, {int(row_bytes)})").alias("part")).limit(rows)
    samples = [bytes(r["part"]) for r in some.collect()]
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few or too small
        return b""


def _urn(run: uuid.UUID, *key) -> str:
    return f"<{uuid.uuid5(run, ':'.join(map(str, key))).urn}>"


def _record(
    run, date: str, place, page_id, url, payload: bytes, size: int, digest: str, kind: str, refers_to, named
) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {date}"]
    head.append(f"WARC-Record-ID: {_urn(run, 'page', page_id, digest) if named else _urn(run, 'place', *place)}")
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if url is not None:
        target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {target}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    head.append(f"Page-Payload-Length: {size}")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {_urn(run, 'page', refers_to, digest)}")
        head.append(f"Page-Refers-To: {refers_to}")
    else:
        block += payload
    head.append("Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(records: DataFrame, path: str, dictionary: bytes, level: int = 3) -> None:
    """Writes ``with_record_types`` rows as archive files below ``path``, one per task."""
    run, date = uuid.uuid4(), datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def frames(batches):
        import zstandard

        embedded = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=level, dict_data=embedded)
        plain = zstandard.ZstdCompressor(level=1, write_checksum=True, dict_data=embedded)

        def frame(record: bytes) -> bytes:
            for how in (packer, plain):
                code = how.compress(record)
                if SEPARATOR not in code:
                    return code
            raise ValueError("a compressed record holds the separator")

        task, row = TaskContext.get().partitionId(), 0
        started = False
        for batch in batches:
            out = []
            if not started and batch.num_rows:
                started = True
                if dictionary:
                    if SEPARATOR in dictionary:
                        raise ValueError("the dictionary holds the separator")
                    out.append(SKIP_DICTIONARY + struct.pack("<I", len(dictionary)) + dictionary)
                info = b"software: tessera\r\nformat: WARC File Format 1.1\r\n"
                out.append(frame(
                    b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Date: %b\r\nWARC-Record-ID: %b\r\n"
                    b"Content-Type: application/warc-fields\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n"
                    % (date.encode(), _urn(run, "info", task).encode(), len(info), info)
                ))
            columns = [batch[c].to_pylist() for c in
                       ("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to", "referred_to")]
            for row, values in enumerate(zip(*columns, strict=True), row):
                out.append(frame(_record(run, date, (task, row), *values)))
            row += batch.num_rows > 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    rows = records.select(
        "page_id", "url", F.when(F.col("record_type") == "response", F.col("payload")).alias("payload"), "payload_bytes",
        "payload_digest", "record_type", "refers_to", "referred_to",
    )
    lines = rows.mapInArrow(frames, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", SEPARATOR.decode("latin-1")).text(path)


def read_archives(spark: SparkSession, path: str, max_dictionaries: int = 64) -> DataFrame:
    """One row per response or revisit record below ``path``, as ``READ_SCHEMA``.

    A response's payload is checked against its digest and length. The files' distinct dictionaries
    (one writer run makes one) are read first, ``max_dictionaries`` at a time: beyond that number the
    frames are read once per block of dictionaries, each frame unpacked with its own.
    """
    lines = spark.read.option("lineSep", SEPARATOR.decode("latin-1")).text(path)
    frames = lines.select(F.col("value").cast("binary").alias("frame"))
    is_dictionary = F.substring("frame", 1, 4) == F.lit(SKIP_DICTIONARY)
    found = frames.where(is_dictionary).distinct().collect()  # one per writer run, 64 KiB each
    dictionaries = sorted(bytes(r["frame"])[8:] for r in found)
    identity = [struct.unpack_from("<I", code, 4)[0] for code in dictionaries]  # after the magic number
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
         ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    )

    def number(text: str | None):
        return None if text is None else int(text)

    def records(batches, block, elsewhere):
        import zstandard

        known = {}
        for code in block:
            embedded = zstandard.ZstdCompressionDict(code)
            known[embedded.dict_id()] = zstandard.ZstdDecompressor(dict_data=embedded)
        if 0 not in elsewhere:
            known[0] = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for frame in batch["frame"]:
                code = frame.as_py()
                packed_with = zstandard.get_frame_parameters(code).dict_id
                if packed_with in elsewhere:
                    continue
                text = known[packed_with].decompress(code)
                head, _, rest = text.partition(b"\r\n\r\n")
                fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
                kind = fields["WARC-Type"]
                if kind not in ("response", "revisit"):
                    continue
                size, digest = int(fields["Page-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:")
                payload = None
                if kind == "response":
                    payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
                    if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
                rows.append((number(fields.get("Page-ID")), fields.get("WARC-Target-URI"), kind, size, digest,
                             number(fields.get("Page-Refers-To")), payload))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    packed = frames.where(~is_dictionary & (F.octet_length("frame") > 0))
    out = None
    for low in range(0, max(len(dictionaries), 1), max_dictionaries):
        high = low + max_dictionaries
        elsewhere = {*identity[:low], *identity[high:]} | ({0} if low else set())  # frames without one: first block
        some = packed.mapInArrow(partial(records, block=dictionaries[low:high], elsewhere=elsewhere), READ_SCHEMA)
        out = some if out is None else out.unionByName(some)
    return out
