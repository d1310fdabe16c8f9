"""Archive scan: files or payloads -> records, in one pass and without a shuffle.

Spark reads and inflates the files as fragments cut at the version line; the fragments of a
gzip file reach one task in file order. A streaming splitter in that task puts them back
together by the declared content lengths, which is exact also when a payload holds a version
line itself, numbers the records, and carries each file's first record along. Headers become one
map per record; everything after is Column expressions.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.functions.headers import VERSION
from webcorpus.functions.text import WHITESPACE

# Fixed value: the version line, and with it the cut between fragments.
VERSION_LINE = VERSION.encode()
SEPARATOR = VERSION_LINE + b"\r\n"

_BLANK_LINE = re.compile(rb"\n\r*\n")
_LENGTH = re.compile(r"\+?[0-9]+")
_BATCH_BYTES = 4 << 20

SPLIT_SCHEMA = """
    path STRING, record_idx BIGINT, headers MAP<STRING, STRING>, content BINARY,
    content_bytes BIGINT, parse_error STRING, info_headers MAP<STRING, STRING>, info_content BINARY
"""
_MAP = pa.map_(pa.string(), pa.string())
_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("record_idx", pa.int64()),
        ("headers", _MAP),
        ("content", pa.binary()),
        ("content_bytes", pa.int64()),
        ("parse_error", pa.string()),
        ("info_headers", _MAP),
        ("info_content", pa.binary()),
    ]
)


def _read_header(block: bytes) -> tuple[dict[str, str] | None, int, str | None]:
    """Header bytes -> (headers, content length, error). The last repeat of a header wins."""
    headers = {"Version": VERSION}
    try:
        text = block.decode("utf-8")
    except UnicodeDecodeError:
        return None, 0, "header_encoding"
    for line in text.split("\n"):
        key, colon, value = line.partition(":")
        if colon:
            headers[key.strip(WHITESPACE)] = value.strip(WHITESPACE)
        elif line.rstrip("\r"):
            return None, 0, "bad_header_line"
    length = headers.get("Content-Length")
    if length is None:
        return None, 0, "missing_content_length"
    if not _LENGTH.fullmatch(length) or int(length) >= 1 << 64:
        return None, 0, "bad_content_length"
    return headers, int(length), None


class Splitter:
    """Bytes of one inflated archive, piece by piece -> ``(headers, content, error)`` tuples.

    After an error the rest of the archive is dropped. ``framing="reference"`` starts a body at
    the blank line itself, so that content opens with its line break and lacks the last bytes.
    """

    def __init__(self, framing: str = "standard"):
        self.standard = framing == "standard"
        self.pieces: list[bytes] = []
        self.have = self.need = 0
        self.seeking = False  # between records; the first record must come at once
        self.at_start = False  # nothing skipped yet since the last record
        self.failed = False

    @property
    def between(self) -> bool:
        """Whether the bytes so far end with a record, so that a new splitter could go on."""
        return self.seeking and not self.failed and not b"".join(self.pieces).strip(b"\r\n")

    def feed(self, piece: bytes) -> Iterator[tuple]:
        self.pieces.append(piece)
        self.have += len(piece)
        return self._records(False) if self.have >= self.need and not self.failed else iter(())

    def close(self) -> Iterator[tuple]:
        return iter(()) if self.failed else self._records(True)

    def _fail(self, error: str) -> tuple:
        self.failed, self.pieces = True, []
        return None, None, error

    def _wait(self, rest: bytes, need: int) -> None:
        self.pieces, self.have, self.need = [rest], len(rest), need

    def _seek(self, buf: bytes, pos: int, end: bool) -> tuple[int, int]:
        """-> (start of the next record or -1, position to keep from)."""
        if not self.standard:
            found = buf.find(b"WARC", pos)
            return found, max(pos, len(buf) - 3)
        if self.at_start:
            if len(buf) - pos < 4 and not end:
                return -1, pos
            if buf.startswith(b"WARC", pos):
                return pos, pos
            self.at_start = False
        found = buf.find(b"\nWARC", pos)
        return (found + 1 if found >= 0 else -1), max(pos, len(buf) - 4)

    def _records(self, end: bool) -> Iterator[tuple]:
        buf, pos = b"".join(self.pieces), 0
        while True:
            if self.seeking:
                found, keep = self._seek(buf, pos, end)
                if found < 0:
                    return self._wait(buf[keep:], 0)
                self.seeking, pos = False, found
            if end and pos == len(buf):
                return self._wait(b"", 0)
            line_end = buf.find(b"\n", pos)
            if line_end < 0 and not end:
                return self._wait(buf[pos:], 0)
            if line_end < 0 or buf[pos:line_end].rstrip(b"\r") != VERSION_LINE:
                yield self._fail("invalid_version")
                return
            blank = _BLANK_LINE.search(buf, line_end)
            if blank:
                head_end = blank.start() + 1
                body = blank.end() if self.standard else head_end
            elif end:
                head_end = body = buf.rfind(b"\n") + 1
            else:
                return self._wait(buf[pos:], 0)
            headers, length, error = _read_header(buf[line_end + 1 : head_end])
            if error:
                yield self._fail(error)
                return
            stop = body + length
            if stop > len(buf):
                if end:
                    yield self._fail("truncated")
                    return
                return self._wait(buf[pos:], stop - pos)
            yield headers, buf[body:stop], None
            pos, self.seeking, self.at_start = stop, True, True


def _maps(dicts) -> pa.MapArray:
    offsets, keys, values, total = [], [], [], 0
    for headers in dicts:
        offsets.append(None if headers is None else total)
        if headers:
            keys.extend(headers)
            values.extend(headers.values())
            total += len(headers)
    return pa.MapArray.from_arrays(
        pa.array([*offsets, total], pa.int32()), pa.array(keys, pa.string()), pa.array(values, pa.string())
    )


class _Rows:
    """Collects record rows into Arrow batches of bounded size."""

    schema = _ARROW

    def __init__(self, with_content: bool):
        self.with_content = with_content
        self.rows: list[tuple] = []
        self.bytes = 0
        self.more: tuple = ()  # values of the schema's further columns

    def file(self, path: str, framing: str) -> None:
        self.path, self.splitter, self.next_idx, self.info = path, Splitter(framing), 0, (None, None)

    def add(self, records: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        for headers, content, error in records:
            size = None if content is None else len(content)
            kept = content if self.with_content else None
            self.rows.append((self.path, self.next_idx, headers, kept, size, error, *self.info, *self.more))
            if self.next_idx == 0 and error is None:
                self.info = (headers, content)
            self.next_idx += 1
            self.bytes += len(kept or b"") + 1024
            if self.bytes >= _BATCH_BYTES:
                yield self.flush()

    def flush(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [()] * len(self.schema)
        arrays = [_maps(c) if f.type == _MAP else pa.array(c, f.type) for c, f in zip(columns, self.schema)]
        self.rows, self.bytes = [], 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def _split_fragments(framing: str, with_content: bool):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, path = _Rows(with_content), None
        for batch in batches:
            for file, value in zip(batch.column(0), batch.column(1)):
                piece = value.as_py()
                if (file := file.as_py()) != path:
                    if path is not None:
                        yield from rows.add(rows.splitter.close())
                    path = file
                    if not path.endswith(".gz"):
                        raise ValueError(f"{path}: only .gz files stay in one piece; use read_objects")
                    rows.file(path, framing)
                else:
                    piece = SEPARATOR + piece
                yield from rows.add(rows.splitter.feed(piece))
        if path is not None:
            yield from rows.add(rows.splitter.close())
        yield rows.flush()

    return split


def inflate(payload: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """Every gzip member of a payload, in pieces of bounded size."""
    while payload:
        member = zlib.decompressobj(wbits=31)
        data = payload
        while data and not member.eof:
            yield member.decompress(data, size)
            data = member.unconsumed_tail
        if not member.eof:
            raise zlib.error("incomplete gzip member")
        payload = member.unused_data


def _split_payloads(framing: str, with_content: bool):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(with_content)
        for batch in batches:
            for file, value in zip(batch.column(0), batch.column(1)):
                rows.file(file.as_py(), framing)
                try:
                    for piece in inflate(value.as_py()):
                        yield from rows.add(rows.splitter.feed(piece))
                    yield from rows.add(rows.splitter.close())
                except zlib.error:
                    yield from rows.add(iter([(None, None, "bad_gzip")]))
        yield rows.flush()

    return split


def split_fragments(fragments: DataFrame, framing: str = "standard", with_content: bool = True) -> DataFrame:
    """``(path, value)`` fragments in file order -> record rows. Works on streams too."""
    source = fragments.select("path", F.col("value").cast("binary").alias("value"))
    return source.mapInArrow(_split_fragments(framing, with_content), SPLIT_SCHEMA)


# A session may skip damaged and missing files; a scan that marks objects done must not.
STRICT = {"ignoreCorruptFiles": "false", "ignoreMissingFiles": "false"}


def plain_path(uri: Column) -> Column:
    """The path that a file's URI stands for: what listings hold. A plus sign stands for itself."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def read_archives(spark: SparkSession, paths, framing: str = "standard", with_content: bool = True) -> DataFrame:
    """Gzip archives (``*.gz``) on any Hadoop file system -> record rows, one task per file.

    Columns: path, record_idx (0 is the file's first record), headers, content, content_bytes,
    parse_error, and the first record's headers and content on every later row. Without content
    only its length comes back. A damaged gzip stream fails the scan; ``split_payloads`` gives what
    comes before the damage and an error row instead.
    """
    fragments = (
        spark.read.options(**STRICT).option("lineSep", SEPARATOR.decode()).option("recursiveFileLookup", "true")
        .text(paths)
        .select(plain_path(F.col("_metadata.file_path")).alias("path"), "value")
    )
    return split_fragments(fragments, framing, with_content)


def read_objects(spark: SparkSession, paths) -> DataFrame:
    """Whole objects as ``(path, payload, length)``, whatever their file extension."""
    return (
        spark.read.options(**STRICT).format("binaryFile").option("recursiveFileLookup", "true").load(paths)
        .select("path", F.col("content").alias("payload"), "length")
    )


def split_payloads(objects: DataFrame, framing: str = "standard", with_content: bool = True) -> DataFrame:
    """``(path, payload)`` rows holding whole gzip objects -> record rows."""
    return objects.select("path", "payload").mapInArrow(_split_payloads(framing, with_content), SPLIT_SCHEMA)


# Object listings up to this many rows, about 40 MB, are broadcast; a year of crawls has more.
BROADCAST_OBJECTS = 200_000


def attach_objects(records: DataFrame, objects: DataFrame) -> DataFrame:
    """Replace ``path`` by the other columns of ``objects``: key, index and what else it holds.

    Counts the listing first. A larger one is joined by shuffle; ``populate`` never gets there,
    as it scans one window of the listing at a time.
    """
    small = objects.count() <= BROADCAST_OBJECTS
    return records.join(F.broadcast(objects) if small else objects, "path").drop("path")


def attach_header_record(records: DataFrame, key: str = "object_key") -> DataFrame:
    """Join each object's record 0 to its other records, for record tables stored without it.

    The scan already carries it; from a stored table the small side is one row per object and
    its scan reads row 0 only.
    """
    plain = records.drop("info_headers", "info_content")
    first = plain.filter("record_idx = 0 AND parse_error IS NULL").select(
        key, F.col("headers").alias("info_headers"), F.col("content").alias("info_content")
    )
    return plain.filter("record_idx > 0").join(first, key)


def to_pairs(records: DataFrame) -> DataFrame:
    """Record rows -> documents paired with their file's first record, which is none itself.

    A first record that cannot be read stays, as the only row of its object, to be rejected.
    """
    return records.filter("record_idx > 0 OR parse_error IS NOT NULL")
