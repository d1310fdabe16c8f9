"""Listing: crawl prefixes, path manifests, numbered objects, served manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webcorpus.functions.keys import ALIASES, COLLECTIONS, decode_object_key, object_key
from webcorpus.operators.ordering import SHUFFLE_SEED, seeded_order

# The crawls of 2024 in listing order.
CRAWLS_2024 = (
    "crawl-data/CC-MAIN-2024-10",
    "crawl-data/CC-MAIN-2024-18",
    "crawl-data/CC-MAIN-2024-22",
    "crawl-data/CC-MAIN-2024-26",
    "crawl-data/CC-MAIN-2024-30",
    "crawl-data/CC-MAIN-2024-33",
    "crawl-data/CC-MAIN-2024-38",
    "crawl-data/CC-MAIN-2024-42",
    "crawl-data/CC-MAIN-2024-46",
    "crawl-data/CC-MAIN-2024-51",
)

# Where the public archives live; a path is the same under both.
BASES = {"s3": "s3a://commoncrawl/", "https": "https://data.commoncrawl.org/"}


def crawls(spark: SparkSession, prefixes=CRAWLS_2024) -> DataFrame:
    return spark.createDataFrame(list(enumerate(prefixes)), "crawl_seq INT, prefix STRING")


def read_path_manifest(
    spark: SparkSession, base: str, kind: str, prefixes=CRAWLS_2024, name: str = "{kind}.paths.gz"
) -> DataFrame:
    """``<prefix>/<kind>.paths.gz`` of every crawl -> ``(crawl_seq, line_no, path)``.

    ``kind`` is ``warc`` or ``wet``. A manifest is one gzip file and so one task, whose row ids
    rise in line order.
    """
    files = [f"{base.rstrip('/')}/{prefix}/{name.format(kind=kind)}" for prefix in prefixes]
    file = F.col("_metadata.file_path")
    seq = F.coalesce(
        *[F.when(file.contains(f"/{prefix}/"), F.lit(i)) for i, prefix in enumerate(prefixes)]
    )
    lines = (
        spark.read.option("lineSep", "\n").text(files)
        .select(seq.alias("crawl_seq"), F.monotonically_increasing_id().alias("_id"), F.rtrim("value", F.lit("\r")).alias("path"))
    )
    first = lines.groupBy("crawl_seq").agg(F.min("_id").alias("_first"))
    return lines.join(F.broadcast(first), "crawl_seq").select(  # one row per crawl prefix
        "crawl_seq", (F.col("_id") - F.col("_first")).alias("line_no"), "path"
    )


def number_listing(manifest: DataFrame) -> DataFrame:
    """Concatenate the crawls in order and number the paths from 0.

    Line numbers are dense inside a crawl, so a row's number is its line number plus the sizes
    of the earlier crawls: no sort.
    """
    sizes = manifest.groupBy("crawl_seq").agg((F.max("line_no") + 1).alias("_size"))
    before = Window.orderBy("crawl_seq").rowsBetween(Window.unboundedPreceding, -1)
    # One row per crawl.
    base = sizes.select("crawl_seq", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    return manifest.join(F.broadcast(base), "crawl_seq").select(
        (F.col("_base") + F.col("line_no")).alias("position"), "path"
    )


def _code(collection: str) -> int:
    for names in (COLLECTIONS, ALIASES):
        for code, name in names.items():
            if name == collection:
                return code
    raise ValueError(f"unknown collection: {collection}")


def list_objects(manifest: DataFrame, collection: str, seed: int = SHUFFLE_SEED, method: str = "swap") -> DataFrame:
    """Manifest -> ``(object_key, collection, object_index, path)``; shuffled collections are
    put in seeded order before they are numbered. The key depends on collection and position
    only, never on where the bytes come from."""
    code = _code(collection)
    numbered = number_listing(manifest)
    if COLLECTIONS[code].endswith("-shuffled"):
        numbered = seeded_order(numbered, seed, method).drop("listed")
    return numbered.select(
        object_key(F.lit(code), F.col("position")).alias("object_key"),
        F.lit(COLLECTIONS[code]).alias("collection"),
        F.col("position").alias("object_index"),
        "path",
    )


# Fixed format: the status is a tagged union.
SERVED_SCHEMA = """
    db_key STRING, s3_key STRING, status STRUCT<
        Dirty: STRUCT<content_length: BIGINT>,
        Downloading: STRUCT<time_start: TIMESTAMP, content_length: BIGINT>,
        Completed: STRUCT<
            time_start: TIMESTAMP, time_end: TIMESTAMP, content_length: BIGINT, sha256: STRING,
            data_location: STRUCT<FilePath: STRING, S3Key: STRING>>>
"""


def checked_entries(served: DataFrame) -> DataFrame:
    """Entries with their key in lower case, its place in the order, and why the key is none, if so."""
    key = F.lower("db_key")
    decoded = F.when(key.isNull(), F.struct(F.lit(None).cast("string").alias("collection"), F.lit(None).cast("int").alias("code"), F.lit(None).cast("bigint").alias("object_index"), F.lit("missing_key").alias("error"))).otherwise(decode_object_key(key))
    return served.withColumn("_key", decoded).select(
        "*", key.alias("object_key"), F.col("_key.object_index").alias("object_index"), F.col("_key.error").alias("error")
    ).drop("_key")


def rejected_entries(served: DataFrame) -> DataFrame:
    """Entries whose key is none, with the reason: (db_key, path, error)."""
    return checked_entries(served).filter("error IS NOT NULL").select("db_key", F.col("s3_key").alias("path"), "error")


def completed_objects(served: DataFrame, strict: bool = True) -> DataFrame:
    """Entries that have finished downloading, as objects; key order is visit order. An entry with a
    malformed key has no place in the order: it stops the read, whatever columns are read, or is left
    to ``rejected_entries`` where the read isn't strict."""
    entries = checked_entries(served.filter("status.Completed IS NOT NULL"))
    fine = F.col("error").isNull()
    if strict:
        told = F.concat(F.lit("served manifest holds a malformed key: "), F.coalesce("db_key", F.lit("NULL")))
        fine = F.when(fine, True).otherwise(F.raise_error(told))
    return entries.filter(fine).select("object_key", "object_index", F.col("s3_key").alias("path"))


def read_served_manifest(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """JSON array files of ``(db_key, s3_key, status)`` -> completed objects. A file that is no
    whole JSON stops the read."""
    return completed_objects(spark.read.schema(SERVED_SCHEMA).json(path, multiLine=True, mode="FAILFAST"), strict)
