"""Large served listings: one JSON array read by many tasks, cut at the commas between its entries.

Whether a byte stands inside a string, and how deep, depends on all bytes before it, but little of it
has to travel: a first pass tells for each range of bytes how many quotes it has and by how much it
moves the depth if it starts inside a string and if not. Those few numbers, added up in order, give
each range its true start, and a second pass cuts every range on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.plans import files
from webcorpus.sources.manifest import SERVED_SCHEMA, checked_entries
from webcorpus.sources.ranges import open_at, tasks_for

RANGE = 32 << 20  # bytes of a listing that one task takes
AHEAD = 1 << 16  # bytes read at a time to finish the last entry of a range

_QUOTE, _SLASH, _COMMA, _OPEN, _CLOSE = b'"\\', b"\\", b",", b"[{", b"]}"


def _read(path: str, start: int, stop: int) -> tuple[bytes, bool]:
    """The bytes of a range, and whether its first one is escaped by the backslashes before it."""
    look = min(start, AHEAD)
    stream = open_at(path, start - look)
    try:
        data = stream.read(stop - start + look)
    finally:
        stream.close()
    before = data[:look]
    return data[look:], (len(before) - len(before.rstrip(b"\\"))) % 2 == 1


def _marks(data: bytes, escaped: bool) -> tuple[np.ndarray, np.ndarray]:
    """Per byte: whether it is a quote that opens or closes a string, and whether an odd number of
    them came before it."""
    raw = np.frombuffer(data, np.uint8)
    slash = raw == _SLASH[0]
    at = np.arange(len(raw))
    other = np.maximum.accumulate(np.where(slash, -1, at))  # the last byte that is no backslash
    run = at - other  # backslashes that end here; those from the range's start on count from -1
    run = np.where(slash & (other < 0), at + 1 + escaped, run)
    odd = np.concatenate(([escaped], (run[:-1] % 2 == 1) & slash[:-1]))[: len(raw)]
    quote = (raw == _QUOTE[0]) & ~odd
    return quote, (np.cumsum(quote) - quote) % 2 == 1


def _depths(data: bytes, quote: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """How each byte moves the depth."""
    raw = np.frombuffer(data, np.uint8)
    opens, closes = np.isin(raw, list(_OPEN)), np.isin(raw, list(_CLOSE))
    return np.where(inside | quote, 0, opens.astype(np.int64) - closes)


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            data, escaped = _read(row["path"], row["start"], row["stop"])
            quote, inside = _marks(data, escaped)
            moves = [int(_depths(data, quote, inside ^ start).sum()) for start in (False, True)]
            yield pa.RecordBatch.from_pylist([{"path": row["path"], "start": row["start"], "quotes": int(quote.sum()), "outer": moves[0], "inner": moves[1]}])


def entries_of(path: str, start: int, stop: int, inside: bool, depth: int) -> Iterator[tuple[int, bytes | None]]:
    """(offset, JSON text) of the array entries that start in a range of a file, given whether the range
    starts inside a string and how deep. A text that the file's end cuts off is None."""
    data, escaped = _read(path, start, stop)
    quote, odd = _marks(data, escaped)
    within = odd ^ inside
    level = depth + np.cumsum(_depths(data, quote, within))  # behind each byte
    raw = np.frombuffer(data, np.uint8)
    outside = ~(within | quote)
    cuts = np.flatnonzero(outside & (level == 1) & ((raw == _COMMA[0]) | (raw == _OPEN[0]))).tolist()
    ends = np.flatnonzero(outside & (level == 0) & (raw == _CLOSE[0])).tolist()
    starts = [c + 1 for c in cuts]
    if not starts:
        return
    stops = [*cuts[1:], next((e for e in ends if e >= starts[-1]), None)]
    for a, b in zip(starts, stops):
        if b is not None:
            text = data[a:b]
        else:
            text = _finish(path, stop, data[a:], bool(within[-1] ^ quote[-1]), int(level[-1]))
        if text is None or text.strip():
            yield start + a, text
    return


def _finish(path: str, offset: int, head: bytes, inside: bool, depth: int) -> bytes | None:
    """The rest of an entry behind its range, up to the comma or bracket that ends it."""
    stream, parts = open_at(path, offset), [head]
    escaped = (len(head) - len(head.rstrip(b"\\"))) % 2 == 1
    try:
        while piece := stream.read(AHEAD):
            quote, odd = _marks(piece, escaped)
            within = odd ^ inside
            level = depth + np.cumsum(_depths(piece, quote, within))
            raw = np.frombuffer(piece, np.uint8)
            outside = ~(within | quote)
            end = np.flatnonzero(outside & (((raw == _COMMA[0]) & (level == 1)) | ((raw == _CLOSE[0]) & (level == 0))))
            if len(end):
                return b"".join([*parts, piece[: end[0]]])
            parts.append(piece)
            inside, depth = bool(within[-1] ^ quote[-1]), int(level[-1])
            escaped = (len(piece) - len(piece.rstrip(b"\\"))) % 2 == 1
        return None
    finally:
        stream.close()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("value", pa.string())])
    for batch in batches:
        for row in batch.to_pylist():
            rows = []
            for offset, text in entries_of(row["path"], row["start"], row["stop"], row["inside"], row["depth"]):
                rows.append({"file": row["path"], "offset": offset, "value": None if text is None else text.decode("utf-8", "replace")})
                if len(rows) >= 10_000:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_served_entries(spark: SparkSession, paths: list[str], size: int = RANGE) -> DataFrame:
    """Every entry of listings that are one JSON array each: object_key, object_index, path, status,
    error. An entry that is no JSON of a listing, or whose key is none, has an error and no place;
    so has what is left of a listing that is cut off.

    ``paths`` are files that a Python worker can open; there is one row of numbers per range on the driver.
    """
    with ThreadPoolExecutor(16) as pool:
        lengths = list(zip(paths, pool.map(partial(files.length, spark), paths)))
    ranges = [(path, start, min(start + size, length)) for path, length in lengths for start in range(0, length, size)]
    schema = "path STRING, start BIGINT, stop BIGINT"
    tasks = tasks_for(spark, len(ranges), sum(length for _, length in lengths), RANGE)
    several = spark.createDataFrame(ranges, schema).repartition(tasks, "path", "start")
    told = {(r.path, r.start): r for r in several.mapInArrow(_survey, "path STRING, start BIGINT, quotes BIGINT, outer BIGINT, inner BIGINT").collect()}
    placed, inside, depth, whole = [], False, 0, {}
    for path, start, stop in ranges:
        if start == 0:
            inside, depth = False, 0
        placed.append((path, start, stop, inside, depth))
        row = told[path, start]
        depth += row.inner if inside else row.outer
        inside ^= row.quotes % 2 == 1
        whole[path] = not inside and depth == 0
    dealt = spark.createDataFrame(placed, schema + ", inside BOOLEAN, depth BIGINT").repartition(tasks, "path", "start")
    texts = dealt.mapInArrow(_cut, "file STRING, offset BIGINT, value STRING")
    parsed = texts.select("file", "offset", "value", F.from_json("value", f"{SERVED_SCHEMA}, _corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("entry"))
    rows = checked_entries(parsed.select("file", "offset", "entry.*"))
    cut = [path for path, ok in whole.items() if not ok]
    broken = F.col("_corrupt").isNotNull() | F.col("db_key").isNull() & F.col("s3_key").isNull()
    error = F.when(F.col("file").isin(cut) & F.col("_corrupt").isNull() & F.col("db_key").isNull(), "cut_off").when(broken, "bad_entry").otherwise(F.col("error"))
    fine = error.isNull()
    return rows.select(
        "file", "offset", F.when(fine, F.col("object_key")).alias("object_key"), F.when(fine, F.col("object_index")).alias("object_index"),
        F.col("s3_key").alias("path"), "status", error.alias("error"),
    )
