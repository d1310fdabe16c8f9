"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import written


def _stars(links: DataFrame) -> bool:
    """Whether every node that has a link has but one, and to a node that has none."""
    ends = links.select(F.col("u").alias("id"), "v").unionByName(links.select(F.col("v").alias("id"), F.lit(None).cast("bigint").alias("v")))
    seen = ends.groupBy("id").agg(F.min("v").alias("least"), F.max("v").alias("most"), F.max(F.isnull("v")).alias("root"))
    return seen.filter("least < most OR least IS NOT NULL AND root").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of the links (a, b): component is the least id it reaches.

    Every node points to the least node it knows; a large and a small star step per round keep
    the number of links from growing and halve the distances, so rounds grow with the logarithm
    of the longest path. Minima combine before the shuffle, and the join behind it has one row per
    node on one side, so that the links of a hot node can be split. Rounds end when all links are
    stars; no row leaves the executors but the one that may say that they are not. NULL ends are left out; an empty table gives none.
    """
    now = written(
        edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    done = False
    while not done:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Repeated links wait for the next round: there are never more than before.
        now = written(small.unionByName(lower.select("u", F.col("m").alias("v"))), "links")
        done = _stars(now)
    now = now.distinct()
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
