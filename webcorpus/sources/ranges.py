"""Archives read in byte ranges, one task per range, by a Python data source.

A gzip archive is a row of members, as a rule one per record. A task starts at the member where it is
told to, so that a resumed object isn't read from its beginning and a large one is read by many tasks.
A missing or damaged object ends in an error row and leaves the others alone.
"""

from __future__ import annotations

import json
import urllib.error
import urllib.request
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from webcorpus.plans import files
from webcorpus.sources.archive import _ARROW, SPLIT_SCHEMA, Splitter, _Rows

# A member's first bytes, and what its content starts with where a record does: fixed values.
MAGIC = b"\x1f\x8b\x08"
RECORD = b"WARC/"

CHUNK = 1 << 16  # bytes asked for at a time
PIECE = 1 << 20  # inflated bytes handed on at a time
RANGE = 64 << 20  # bytes of an object that one task takes, where objects are split

# Path schemes that a Python worker opens by itself; others are for Spark's own readers.
DIRECT = ("file:", "s3:", "s3a:", "http:", "https:", "/")

RANGE_SCHEMA = SPLIT_SCHEMA.rstrip() + ", resume_offset BIGINT, resume_idx BIGINT"


@dataclass(frozen=True)
class Range:
    """Members of one object: those that start from ``start`` on and before ``stop``; the first one
    opens with record ``first_idx``. ``label`` names the object in the rows."""

    label: str
    path: str
    start: int = 0
    stop: int | None = None
    first_idx: int = 0


class MissingObject(Exception):
    pass


def open_at(path: str, offset: int):
    """A binary stream of the object from a byte on, and no byte before it."""
    if path.startswith(("http:", "https:")):
        asked = urllib.request.Request(path, headers={"Range": f"bytes={offset}-"} if offset else {})
        try:
            return urllib.request.urlopen(asked)
        except urllib.error.HTTPError as error:
            if error.code in (403, 404, 410):
                raise MissingObject(path) from error
            if error.code == 416:  # nothing there from this byte on
                return pa.BufferReader(b"")
            raise
    try:
        if path.startswith(("s3:", "s3a:")):
            from pyarrow import fs

            system, key = fs.FileSystem.from_uri("s3" + path[path.index(":") :])
            stream = system.open_input_file(key)
        else:
            stream = open(path.removeprefix("file://").removeprefix("file:"), "rb")  # as listed: a percent sign is one
        stream.seek(offset)
        return stream
    except (FileNotFoundError, PermissionError, IsADirectoryError) as error:
        raise MissingObject(path) from error


class Members:
    """The members of an object from an offset on, inflated piece by piece."""

    def __init__(self, path: str, start: int):
        self.stream = open_at(path, start)
        self.offset = start  # of the member that comes next
        self.data = b""
        self.read = 0  # bytes asked from the stream

    def close(self) -> None:
        self.stream.close()

    def _more(self) -> bytes:
        data = self.stream.read(CHUNK)
        self.read += len(data)
        return data

    def ended(self) -> bool:
        if not self.data:
            self.data = self._more()
        return not self.data

    def inflate(self) -> Iterator[bytes]:
        """The next member. Moves the offset behind it when it was read to its end."""
        member, used = zlib.decompressobj(wbits=31), 0
        data = self.data
        while not member.eof:
            if not data:
                data = self._more()
                if not data:
                    raise zlib.error("incomplete gzip member")
            used += len(data)
            yield member.decompress(data, PIECE)
            while member.unconsumed_tail and not member.eof:
                yield member.decompress(member.unconsumed_tail, PIECE)
            data = b""
        self.data = member.unused_data
        self.offset += used - len(self.data)

    def find(self, stop: int | None) -> bool:
        """Move to the first member that starts a record, before ``stop`` -> whether there is one.

        The magic bytes also come up by chance, so a place counts only if a whole member with a
        right checksum and a record's first bytes follows.
        """
        while True:
            while (at := self.data.find(MAGIC)) < 0:
                kept = self.data[-(len(MAGIC) - 1) :]
                more = self._more()
                if not more:
                    return False
                self.offset += len(self.data) - len(kept)
                self.data = kept + more
            self.offset += at
            self.data = self.data[at:]
            if stop is not None and self.offset >= stop:
                return False
            if self._starts_record():
                return True
            self.offset += 1
            self.data = self.data[1:]

    def _starts_record(self) -> bool:
        member, at, first = zlib.decompressobj(wbits=31), 0, b""
        try:
            while not member.eof:
                if at == len(self.data):
                    more = self._more()
                    if not more:
                        return False
                    self.data += more
                piece = member.decompress(self.data[at:], PIECE)
                at = len(self.data)
                if len(first) < len(RECORD):
                    first += piece[: len(RECORD)]
                    if not RECORD.startswith(first[: len(RECORD)]):
                        return False
                while member.unconsumed_tail and not member.eof:
                    member.decompress(member.unconsumed_tail, PIECE)
        except zlib.error:
            return False
        return first.startswith(RECORD)


class _RangeRows(_Rows):
    """Record rows with the place where reading can go on before them: a member's offset and the
    number of the record that opens it."""

    schema = pa.schema([*_ARROW, ("resume_offset", pa.int64()), ("resume_idx", pa.int64())])


def first_record(path: str, framing: str) -> tuple[dict | None, bytes | None]:
    """Headers and content of an object's record 0, from its first bytes alone."""
    members, splitter = Members(path, 0), Splitter(framing)
    try:
        while not members.ended():
            for piece in members.inflate():
                for headers, content, error in splitter.feed(piece):
                    return (headers, content) if error is None else (None, None)
            if splitter.between:
                break
        for headers, content, error in splitter.close():
            return (headers, content) if error is None else (None, None)
    except zlib.error:
        pass
    finally:
        members.close()
    return None, None


def read_range(part: Range, framing: str = "standard", with_content: bool = True) -> Iterator[pa.RecordBatch]:
    """The records of a range. What can't be read gives one row with the reason, as its object's last."""
    rows = _RangeRows(with_content)
    rows.file(part.label, framing)
    rows.next_idx, rows.more = part.first_idx, (part.start, part.first_idx)
    failed = lambda reason: rows.add(iter([(None, None, reason)]))
    try:
        if part.first_idx:
            rows.info = first_record(part.path, framing)
        members = Members(part.path, part.start)
    except MissingObject:
        yield from failed("missing_object")
        yield rows.flush()
        return
    try:
        if not part.start and members.ended():
            raise zlib.error("empty object")
        while (part.stop is None or members.offset < part.stop) and not members.ended():
            place, clean = (members.offset, rows.next_idx), rows.splitter.between
            for piece in members.inflate():
                if clean and piece.startswith(RECORD):
                    rows.more = place
                clean = False
                yield from rows.add(rows.splitter.feed(piece))
            if rows.splitter.failed:
                break
        yield from rows.add(rows.splitter.close())
    except zlib.error:
        yield from failed("bad_gzip")
    finally:
        members.close()
    yield rows.flush()


@dataclass
class _Task(InputPartition):
    part: Range

    def __init__(self, part: Range):
        super().__init__(part.label)
        self.part = part


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.parts = options["ranges"]
        self.framing, self.with_content = options["framing"], options["content"] == "true"

    def partitions(self):
        return [_Task(Range(**part)) for part in json.loads(self.parts)]

    def read(self, partition):
        yield from read_range(partition.part, self.framing, self.with_content)


class ArchiveRanges(DataSource):
    """``spark.read.format("archive_ranges")``: options ``ranges`` (JSON), ``framing``, ``content``."""

    @classmethod
    def name(cls) -> str:
        return "archive_ranges"

    def schema(self) -> str:
        return RANGE_SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


def readable(path: str) -> bool:
    """Whether a Python worker can open the path by itself."""
    return path.startswith(DIRECT)


def read_ranges(spark: SparkSession, parts: list[Range], framing: str = "standard", with_content: bool = True) -> DataFrame:
    """Record rows of the ranges, a task each; ``path`` holds the label. Meant for one window of
    objects: the ranges travel with the plan."""
    spark.dataSource.register(ArchiveRanges)
    return (
        spark.read.format("archive_ranges")
        .option("ranges", json.dumps([asdict(p) for p in parts])).option("framing", framing)
        .option("content", str(with_content).lower()).load()
    )


# --- splitting an object ---

_SPLIT = "label STRING, begin BIGINT, start BIGINT, stop BIGINT, records BIGINT, whole BOOLEAN"


def _survey(part: Range, framing: str) -> tuple:
    """Where a range's first member starts and its last one ends, with the records between them."""
    members = Members(part.path, part.start)
    try:
        if part.start and not members.find(part.stop):
            return part.label, part.start, None, None, 0, True
        start, records, splitter = members.offset, 0, Splitter(framing)
        while (part.stop is None or members.offset < part.stop) and not members.ended():
            for piece in members.inflate():
                records += sum(1 for _ in splitter.feed(piece))
        # Records that go on in the next range, or an error, keep the object in one piece.
        return part.label, part.start, start, members.offset, records, splitter.between
    except zlib.error:
        return part.label, part.start, part.start, None, 0, False
    finally:
        members.close()


def _survey_all(framing: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["label", "begin", "start", "stop", "records", "whole"]
        for batch in batches:
            made = [_survey(Range(**row), framing) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*made), [pa.string(), *[pa.int64()] * 4, pa.bool_()])], names=names
            )

    return run


def tasks_for(spark: SparkSession, ranges: int, length: int, size: int = RANGE) -> int:
    """Tasks for so many ranges of files: one each, unless the ranges are far smaller than what a task takes."""
    return max(1, min(ranges, max(4 * spark.sparkContext.defaultParallelism, -(-length // size))))


def placed_ranges(spark: SparkSession, sizes: list[tuple[str, str, int]], framing: str = "standard", size: int = RANGE) -> DataFrame:
    """(label, path, bytes) of a window's objects -> their ranges of about ``size`` bytes, with the
    numbers of their first records: (label, path, start, stop, first_idx). Ranges stay on the executors.

    One pass inflates every range on its own to find its members and count its records. The ranges
    of an object must meet member by member; an object where they don't, because a record runs over
    a border, a member isn't one, or bytes are damaged, stays in one piece.
    """
    objects = spark.createDataFrame(sizes, "label STRING, path STRING, length BIGINT")
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(size).cast("bigint")))
    asked = objects.filter(F.col("length") > size).withColumn("start", start).select(
        "label", "path", "start", F.least(F.col("start") + size, "length").alias("stop"), F.lit(0).cast("bigint").alias("first_idx")
    )
    long = [length for _, _, length in sizes if length > size]
    tasks = tasks_for(spark, sum(-(-length // size) for length in long), sum(long))
    surveyed = asked.repartition(tasks, "label", "start").mapInArrow(_survey_all(framing), _SPLIT)
    order = Window.partitionBy("label").orderBy("begin")
    held = surveyed.filter("start IS NOT NULL").withColumn("before", F.lag("stop", 1, 0).over(order)).withColumn(
        "first_idx", F.sum("records").over(order) - F.col("records")
    )
    meet = F.coalesce(F.col("whole") & (F.col("start") == F.col("before")), F.lit(False))
    all_of = Window.partitionBy("label")
    held = held.withColumn("meet", F.bool_and(meet).over(all_of)).withColumn("end", F.max_by("stop", "begin").over(all_of))
    cut = objects.join(held.filter("meet").drop("records", "whole", "before"), "label").filter("end = length")
    cut = cut.select("label", "path", "start", "stop", "first_idx")
    none = F.lit(None).cast("bigint")
    alone = objects.join(cut.filter("start = 0").select("label"), "label", "left_anti").select(
        "label", "path", F.lit(0).cast("bigint").alias("start"), none.alias("stop"), F.lit(0).cast("bigint").alias("first_idx")
    )
    return cut.unionByName(alone)


def split_objects(spark: SparkSession, sizes: list[tuple[str, str, int]], framing: str = "standard", size: int = RANGE) -> list[Range]:
    """The placed ranges as a list, in the order of the objects: a row per range on the driver."""
    found: dict[str, list[Range]] = {}
    for row in placed_ranges(spark, sizes, framing, size).orderBy("label", "start").collect():
        found.setdefault(row.label, []).append(Range(**row.asDict()))
    return [part for label, _, _ in sizes for part in found[label]]


def _read_all(framing: str, with_content: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from read_range(Range(**row), framing, with_content)

    return run


def read_split(spark: SparkSession, paths: list[str], framing: str = "standard", with_content: bool = True, size: int = RANGE) -> DataFrame:
    """Record rows of a window of objects, each read by as many tasks as it has ranges; ranges far smaller
    than a task's share are dealt to tasks together."""
    sizes = [(path, path, files.length(spark, path)) for path in paths]
    parts = sum(max(1, -(-length // size)) for *_, length in sizes)
    dealt = placed_ranges(spark, sizes, framing, size).repartition(tasks_for(spark, parts, sum(s[2] for s in sizes)), "label", "start")
    return dealt.mapInArrow(_read_all(framing, with_content), RANGE_SCHEMA)
