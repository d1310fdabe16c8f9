"""Bulk bodies in few files: a data source that writes many bodies after one another and notes where.

    <path>/bodies/part-<p>-<attempt>.ndjson      the bytes of the bodies' pieces
    <path>/index/part-<p>-<attempt>.parquet      object_key, batch_no, piece, file, offset, length
    <path>/committed.json                        the parts of the attempts that count

A body whose records lie in two segments of its object has two pieces. The parts of failed or
repeated attempts are never listed, so never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from webcorpus.operators.bulk import BULK_CAP, SEGMENT, pack_batches

_INDEX = pa.schema([
    ("object_key", pa.string()), ("batch_no", pa.int64()), ("piece", pa.int64()), ("file", pa.string()),
    ("offset", pa.int64()), ("length", pa.int64()),
])
INDEX_SCHEMA = "object_key STRING, batch_no BIGINT, piece BIGINT, file STRING, offset BIGINT, length BIGINT"
ROWS = 50_000  # index rows held before they are written


def _system(path: str):
    """The path's file system, as pyarrow has it, and the path on it."""
    from pyarrow import fs

    if path.startswith(("s3:", "s3a:")):
        return fs.FileSystem.from_uri("s3" + path[path.index(":") :])
    return fs.LocalFileSystem(), path.removeprefix("file://").removeprefix("file:")


@dataclass
class _Part(WriterCommitMessage):
    name: str | None


class _BodyWriter(DataSourceArrowWriter):
    """Rows (object_key, batch_no, piece, payload) in order -> one file of bodies and its index."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Part:
        system, root = _system(self.path)
        # An attempt of its own: a repeated or speculative task writes beside the first one.
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        for folder in ("bodies", "index"):
            system.create_dir(f"{root}/{folder}", recursive=True)
        rows, offset, bodies, index = [], 0, None, None
        try:
            for batch in iterator:
                for key, batch_no, piece, payload in zip(*(batch.column(c).to_pylist() for c in ("object_key", "batch_no", "piece", "payload"))):
                    if bodies is None:
                        bodies = system.open_output_stream(f"{root}/bodies/{name}.ndjson", compression=None)
                        index = pq.ParquetWriter(system.open_output_stream(f"{root}/index/{name}.parquet", compression=None), _INDEX)
                    if not rows or rows[-1][:3] != [key, batch_no, piece]:
                        if len(rows) >= ROWS:
                            index.write_table(_index_table(rows))
                            rows = []
                        rows.append([key, batch_no, piece, f"{name}.ndjson", offset, 0])
                    data = payload.encode()
                    bodies.write(data)
                    offset += len(data)
                    rows[-1][5] += len(data)
            if rows:
                index.write_table(_index_table(rows))
        finally:
            for stream in (bodies, index):
                if stream is not None:
                    stream.close()
        return _Part(None if bodies is None else name)

    def commit(self, messages) -> None:
        names = sorted(m.name for m in messages if m is not None and m.name)
        system, root = _system(self.path)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/committed.json", compression=None) as out:
            out.write("".join(json.dumps({"part": name}) + "\n" for name in names).encode())

    def abort(self, messages) -> None:
        """Nothing to do: parts that aren't committed are not read."""


def _index_table(rows: list[list]) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), _INDEX)], schema=_INDEX)


class BodySink(DataSource):
    """``df.write.format("bulk_bodies").option("path", ...)``."""

    @classmethod
    def name(cls) -> str:
        return "bulk_bodies"

    def schema(self) -> str:
        return "object_key STRING, batch_no BIGINT, piece BIGINT, payload STRING"

    def writer(self, schema, overwrite):
        return _BodyWriter(self.options["path"])


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a segment in record order, a body's first record marked -> payloads with their body."""
    key = batch_no = None
    for batch in batches:
        keys, segments, marks, payloads = (batch.column(c).to_pylist() for c in ("object_key", "segment", "batch_no", "payload"))
        out = []
        for k, segment, mark, payload in zip(keys, segments, marks, payloads):
            if (k, segment) != key:
                key, batch_no = (k, segment), None
            if mark is not None:
                batch_no = mark
            if payload is not None:
                out.append((k, batch_no, segment, payload))
        columns = list(zip(*out)) if out else [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())],
            ["object_key", "batch_no", "piece", "payload"],
        )


def store_bodies(rendered: DataFrame, path: str, cap: int = BULK_CAP, segment: int = SEGMENT) -> DataFrame:
    """Write the bodies of rendered documents below ``path`` -> the documents that no body can hold.

    Payloads move once, to the task of their segment, where they meet the record that opens each
    body; bodies follow one another in a task's one file. What is too large comes back as rejects
    (object_key, record_idx, n_bytes, reject_reason).
    """
    spark = rendered.sparkSession
    spark.dataSource.register(BodySink)
    part = F.floor(F.col("record_idx") / segment).alias("segment")
    packed = pack_batches(rendered.select("object_key", "record_idx", "n_bytes"), cap, segment).select("*", part)
    # Where a body opens, and which one is open where a segment starts.
    opens = packed.groupBy("object_key", "segment", "batch_no").agg(F.min("record_idx").alias("record_idx"))
    payloads = rendered.filter(F.col("n_bytes") <= cap).select("object_key", part, "record_idx", "payload")
    keys = ["object_key", "segment"]
    together = payloads.unionByName(opens, allowMissingColumns=True).repartition(*keys)
    ordered = together.sortWithinPartitions(*keys, "record_idx", F.col("payload").isNotNull())
    carried = ordered.select(*keys, "batch_no", "payload").mapInArrow(
        _carry, "object_key STRING, batch_no BIGINT, piece BIGINT, payload STRING"
    )
    carried.write.format("bulk_bodies").option("path", path).mode("append").save()
    return rendered.filter(F.col("n_bytes") > cap).select("object_key", "record_idx", "n_bytes", F.lit("oversize").alias("reject_reason"))


def body_index(spark: SparkSession, path: str) -> DataFrame:
    """Where the committed bodies are: (object_key, batch_no, piece, file, offset, length)."""
    path = path.rstrip("/")
    parts = spark.read.schema("part STRING").json(f"{path}/committed.json")
    names = [r.part for r in parts.collect()]  # one per task of the writing job
    if not names:
        return spark.createDataFrame([], INDEX_SCHEMA)
    return spark.read.schema(INDEX_SCHEMA).parquet(*[f"{path}/index/{name}.parquet" for name in names])


def _fetch(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _system(path)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{root}/bodies/{row['file']}") as stream:
                    stream.seek(row["offset"])
                    data = stream.read(row["length"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[c]], t) for c, t in (("object_key", pa.string()), ("batch_no", pa.int64()), ("piece", pa.int64()))]
                    + [pa.array([data], pa.binary())],
                    ["object_key", "batch_no", "piece", "body"],
                )

    return run


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """The pieces of the committed bodies as (object_key, batch_no, piece, body); a body is its pieces in order."""
    return body_index(spark, path).mapInArrow(_fetch(path), "object_key STRING, batch_no BIGINT, piece BIGINT, body BINARY")
