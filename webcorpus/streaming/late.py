"""Incremental populate where files and their listing both come as streams, in any order.

A file that no listing has named yet is held in keyed state until a row names it, and a listed file
until it turns up; the state of a pair is dropped when it is given on. So the state holds what still
waits, and nothing is passed over unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from webcorpus.plans.files import qualify
from webcorpus.plans.populate import populate
from webcorpus.plans.store import Index
from webcorpus.session import scratch_path
from webcorpus.streaming.stream import FILE_SCHEMA

MET = "object_key STRING, object_index BIGINT, path STRING"
_STATE = "there BOOLEAN, object_key STRING, object_index BIGINT"


def _meet(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One path's file and listing row, whichever comes first."""
    there, object_key, index = state.get if state.exists else (False, None, None)
    for frame in frames:
        listed = frame[frame["object_key"].notna()]
        there = there or len(listed) < len(frame)
        if len(listed):  # the least of several, so that a repeated batch gives the same
            row = listed.sort_values(["object_index", "object_key"]).iloc[0]
            if object_key is None or (int(row["object_index"]), row["object_key"]) < (index, object_key):
                object_key, index = row["object_key"], int(row["object_index"])
    if there and object_key is not None:
        if state.exists:
            state.remove()
        yield pd.DataFrame({"object_key": [object_key], "object_index": [index], "path": [key[0]]})
    else:
        state.update((bool(there), object_key, index))


def full_path(spark: SparkSession, path: Column, base: str = "") -> Column:
    """A listed path, below ``base`` or full, in the form in which the stream reports its files."""
    below, root = qualify(spark, base, ["x", "/"]) if base else ("x", qualify(spark, base, ["/"])[0])
    return F.when(path.startswith("/"), F.concat(F.lit(root.rstrip("/")), path)).when(
        path.contains(":/"), F.regexp_replace(path, "^file:/+", "file:/")
    ).otherwise(F.concat(F.lit(below[:-1]), path))


def populate_listed_stream(
    index: Index, source: str, listing: DataFrame, checkpoint: str, max_files: int = 1024, framing: str = "standard", base: str = "", **trigger
) -> StreamingQuery:
    """Start the stream. ``listing`` is a stream of (object_key, object_index, path); its rows may come
    before or after their files below ``source``. What meets in a micro-batch is appended as by
    ``populate``, in windows; a batch that is delivered again creates nothing. The default trigger
    takes what is there and stops."""
    spark = index.spark
    found = (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.gz").option("maxFilesPerTrigger", max_files).load(source)
    )
    files = found.select("path", F.lit(None).cast("string").alias("object_key"), F.lit(None).cast("bigint").alias("object_index"))
    listed = listing.select(full_path(spark, F.col("path"), base).alias("path"), "object_key", F.col("object_index").cast("bigint").alias("object_index"))
    met = files.unionByName(listed.filter("object_key IS NOT NULL")).groupBy("path").applyInPandasWithState(
        _meet, MET, _STATE, "append", GroupStateTimeout.NoTimeout
    )

    def append(batch: DataFrame, _: int) -> None:
        # Written once: the state is not asked again for every window.
        path = scratch_path(spark, "met")
        batch.write.parquet(path)
        populate(index, spark.read.schema(MET).parquet(path), framing=framing)

    return (
        met.writeStream.foreachBatch(append).outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
