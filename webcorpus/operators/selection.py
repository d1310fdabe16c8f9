"""Which objects to read, which records to resume at, which documents are new."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.operators.ordering import nth_smallest, position


def with_position(df: DataFrame) -> DataFrame:
    return df.withColumn("pos", position(F.col("object_index"), F.col("record_idx")))


def with_progress(objects: DataFrame, progress: DataFrame) -> DataFrame:
    """Each object with its state; an object never touched starts at record 0, not done."""
    state = progress.select("object_key", "next_record_idx", "done")
    return (
        objects.join(state, "object_key", "left")
        .withColumn("next_record_idx", F.coalesce("next_record_idx", F.lit(0).cast("bigint")))
        .withColumn("done", F.coalesce("done", F.lit(False)))
    )


def pending_objects(objects: DataFrame, progress: DataFrame) -> DataFrame:
    """Objects not yet finished. Applied before the scan is built, so finished files are not read."""
    return objects.join(progress.filter("done").select("object_key"), "object_key", "left_anti")


def resume_from(records: DataFrame, progress: DataFrame) -> DataFrame:
    """Drop the records of each object up to and including its recorded position."""
    state = progress.select("object_key", "next_record_idx")
    return (
        records.join(state, "object_key", "left")
        .filter(F.col("record_idx") > F.coalesce("next_record_idx", F.lit(0)))
        .drop("next_record_idx")
    )


def first_by_id(ids: DataFrame) -> DataFrame:
    """``(doc_id, pos)`` -> the first position of every id.

    A plain minimum of a long: it combines before the shuffle, so one id that holds a third of
    the rows still sends one row per input partition.
    """
    return ids.groupBy("doc_id").agg(F.min("pos").alias("pos"))


def new_documents(ids: DataFrame, index: DataFrame) -> DataFrame:
    """First positions of the ids that the index does not hold."""
    return first_by_id(ids).join(index.select("doc_id"), "doc_id", "left_anti")


def limit_new(new: DataFrame, n: int | None) -> tuple[DataFrame, int | None]:
    """The first n new documents in visit order, and the position of the last of them (None when
    the budget is not used up). A filter on the cut position, not a sort."""
    cut = None if n is None else nth_smallest(new, "pos", n) if n > 0 else -1
    return (new if cut is None else new.filter(F.col("pos") <= cut)), cut


def outcomes(ids: DataFrame, new: DataFrame) -> DataFrame:
    """Every submitted document with ``created`` or ``already_exists``.

    Joined on the position, which is unique, not on the id, which may be hot.
    """
    won = new.select("pos", F.lit(True).alias("_won"))
    created = F.col("_won").isNotNull()
    return (
        ids.join(won, "pos", "left")
        .withColumn("outcome", F.when(created, F.lit("created")).otherwise(F.lit("already_exists")))
        .withColumn("status", F.when(created, F.lit(201)).otherwise(F.lit(409)))
        .drop("_won")
    )


def create_documents(docs: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents to append (first of their id, not in the index yet), and every document's
    outcome. Only ids and positions go through the dedup; content is joined on the position."""
    ids = docs.select("doc_id", "pos")
    new = new_documents(ids, index)
    return docs.join(new.select("pos"), "pos", "left_semi"), outcomes(ids, new)
