"""Per-object progress: what a run adds, what it adds up to, and document counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTS = ["created", "already_exists", "failed", "rejected"]
SCHEMA = """
    index_uuid STRING, object_key STRING, next_record_idx BIGINT, done BOOLEAN,
    created BIGINT, already_exists BIGINT, failed BIGINT, rejected BIGINT, run_id BIGINT
"""


def object_progress(records: DataFrame, cut: int | None = None) -> DataFrame:
    """Record outcomes -> one progress row per object.

    ``records``: object_key, record_idx, pos, outcome (created, already_exists, failed or
    rejected), parse_error. Up to the cut position everything counts as consumed. An object is
    done when no record lies beyond that and none failed to parse.
    """
    used = F.lit(True) if cut is None else F.col("pos") <= cut
    broken = F.col("parse_error").isNotNull()
    state = records.groupBy("object_key").agg(
        F.max(F.when(used & ~broken, F.col("record_idx"))).alias("next_record_idx"),
        F.bool_and(used & ~broken).alias("done"),
        *[F.count_if(used & (F.col("outcome") == c)).alias(c) for c in COUNTS],
        F.bool_or(used).alias("_touched"),
    )
    return state.filter("_touched").drop("_touched").withColumn(
        "next_record_idx", F.coalesce("next_record_idx", F.lit(0).cast("bigint"))
    )


def commit_progress(progress: DataFrame, delta: DataFrame) -> DataFrame:
    """Progress after a run: positions only grow, done stays done, counts add up."""
    keys = ["index_uuid", "object_key"]
    return (
        progress.unionByName(delta)
        .groupBy(*keys)
        .agg(
            F.max("next_record_idx").alias("next_record_idx"),
            F.bool_or("done").alias("done"),
            *[F.sum(c).alias(c) for c in COUNTS],
            F.max("run_id").alias("run_id"),
        )
    )


def document_counts(progress: DataFrame) -> DataFrame:
    """Per index: the sum of the offsets, and the documents really created."""
    return progress.groupBy("index_uuid").agg(
        F.sum("next_record_idx").alias("document_count"), F.sum("created").alias("created")
    )
