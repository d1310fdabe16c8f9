"""Incremental populate as a stream: files that turn up are appended once.

The stream carries file names only; each micro-batch is one bounded window that goes through
the same scan and commit as a batch run. Offsets are at least once; a batch that is delivered
again creates nothing, because its ids are in the index and its objects are done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webcorpus.plans.files import qualify
from webcorpus.plans.populate import ingest, pending_states, window_of
from webcorpus.plans.store import Index

FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def populate_stream(
    index: Index,
    source: str,
    objects: DataFrame,
    checkpoint: str,
    max_files: int = 1024,
    framing: str = "standard",
    whole: bool = False,
    base: str = "",
    **trigger,
) -> StreamingQuery:
    """Start the stream. ``objects`` (object_key, object_index, path) numbers the files, with paths below
    ``base`` or full ones, as ``populate`` takes them. A file that it does not list stops the stream
    before the batch is committed, so no file is passed over unread. The default trigger takes what is there and stops."""
    spark = index.spark
    found = (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*" if whole else "*.gz")
        .option("maxFilesPerTrigger", max_files)
        .load(source)
        .select("path")  # the content column is pruned: no file is opened here
    )

    # The same full form as the stream reports for its files.
    below, root = qualify(spark, base, ["x", "/"]) if base else ("x", qualify(spark, base, ["/"])[0])
    path = F.col("path")
    full = F.when(path.startswith("/"), F.concat(F.lit(root.rstrip("/")), path)).when(
        path.contains(":/"), F.regexp_replace(path, "^file:/+", "file:/")
    ).otherwise(
        F.concat(F.lit(below[:-1]), path)
    )
    listed = objects.select("object_key", "object_index", full.alias("path"))

    def append(batch: DataFrame, _: int) -> None:
        known = batch.join(listed, "path")
        stray = batch.join(listed, "path", "left_anti").first()
        if stray is not None:
            raise ValueError(f"file is not in the listing: {stray.path}")
        rows = pending_states(index, known).collect()  # at most max_files
        if rows:
            ingest(index, window_of(index, rows), None, framing, whole)
            index.clean()

    return (
        found.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
