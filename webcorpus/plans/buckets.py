"""The ids of an index in hash buckets, so that a run looks its own ids up without moving them.

The ids are a bucketed table of external Parquet folders, one per run. Spark knows how its files are
dealt, so a join by id reads each bucket where the run's ids were sent and shuffles the run's side
only. The catalogue entry is made anew in every session from what the index says; only committed
runs are its partitions, so what an interrupted run left is never read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.plans import files

# Fixed for an index's life: buckets for each of its shards.
BUCKETS_PER_SHARD = 16


class IdTable:
    def __init__(self, spark: SparkSession, path: str, shards: int):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = max(1, shards) * BUCKETS_PER_SHARD
        self.name = f"webcorpus_ids_{hashlib.md5(self.path.encode()).hexdigest()}"
        self.known: set[int] = set()
        place = self.path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (doc_id STRING, pos BIGINT, run_id BIGINT) USING parquet "
            f"PARTITIONED BY (run_id) CLUSTERED BY (doc_id) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )

    def _show(self, runs: list[int]) -> None:
        """Make exactly the committed runs the table's partitions."""
        there = {int(row.partition.partition("=")[2]) for row in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()}
        for verb, chosen in (("DROP IF EXISTS", there - set(runs)), ("ADD IF NOT EXISTS", set(runs) - there)):
            if chosen:
                glue = ", " if verb.startswith("DROP") else " "
                parts = glue.join(f"PARTITION (run_id={r})" for r in sorted(chosen))
                self.spark.sql(f"ALTER TABLE {self.name} {verb} {parts}")

    def read(self, runs: list[int]) -> DataFrame:
        """(doc_id, pos, run_id) of the committed runs."""
        self._show(runs)
        return self.spark.table(self.name)

    def append(self, ids: DataFrame, run: int, compression: str) -> None:
        """Write a run's ids, in place of what an interrupted run of this number left."""
        self._show([r for r in self._partitions() if r != run])
        files.remove(self.spark, f"{self.path}/run_id={run}")
        dealt = ids.select("doc_id", "pos", F.lit(run).cast("bigint").alias("run_id")).repartition(self.buckets, "doc_id")
        dealt.write.option("compression", compression).insertInto(self.name)

    def _partitions(self) -> list[int]:
        return [int(row.partition.partition("=")[2]) for row in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()]

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def absent(first: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows (doc_id, pos) whose id the bucketed table lacks.

    The stored ids stream past a hash table of the run's own, bucket by bucket: neither shuffled nor
    sorted. What they have in common is part of the run, and dealt alike.
    """
    held = stored.select("doc_id").join(first.select("doc_id").hint("shuffle_hash"), "doc_id", "left_semi")
    return first.join(held, "doc_id", "left_anti")
