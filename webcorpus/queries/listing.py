"""Listing and order: manifests, object keys, numbering, seeded order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.fixtures import table
from webcorpus.functions import keys
from webcorpus.operators import ordering
from webcorpus.queries import sql
from webcorpus.session import scratch_path
from webcorpus.sources import manifest, served

CRAWLS = [f"crawl={i}" for i in range(10)]


def _manifest(spark: SparkSession, sf: str, kind: str = "warc") -> DataFrame:
    """Path manifests written from the pages, ten crawls, and read back."""
    base = scratch_path(spark, "manifest")
    p = F.col("page_id")
    lines = table(spark, sf, "pages").select(
        (p % 10).alias("crawl"), "page_id", F.format_string("crawl-data/segments/%d/%08d.warc.gz", p % 10, p).alias("value")
    )
    (
        lines.repartition("crawl").sortWithinPartitions("crawl", "page_id").select("crawl", "value")
        .write.partitionBy("crawl").option("compression", "gzip").text(base)
    )
    return manifest.read_path_manifest(spark, base, kind, CRAWLS, "*.gz")


def manifest_listing(spark: SparkSession, sf: str) -> DataFrame:
    """A2, A3, B9, F1, G1, H1"""
    return manifest.list_objects(_manifest(spark, sf), "cc-warc2024")


_LISTED = """
listed AS (
    SELECT row_number() OVER (ORDER BY page_id % 10, page_id) - 1 AS i,
        printf('crawl-data/segments/%d/%08d.warc.gz', page_id % 10, page_id) AS path
    FROM pages
)"""

MANIFEST_LISTING = f"""
WITH {_LISTED}
SELECT printf('0101%08x', i) AS object_key, 'cc-warc2024' AS collection, i AS object_index, path FROM listed
"""


def crawl_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Lines per crawl prefix"""
    prefixes = manifest.crawls(spark)
    return (
        _manifest(spark, sf).join(prefixes, "crawl_seq")
        .groupBy("prefix").agg(F.count("*").alias("objects"), F.max("line_no").alias("last_line"))
    )


_PREFIXES = ", ".join(f"({i}, '{p}')" for i, p in enumerate(manifest.CRAWLS_2024))
CRAWL_SIZES = f"""
SELECT prefix, count(*) AS objects, count(*) - 1 AS last_line
FROM pages JOIN (VALUES {_PREFIXES}) c(seq, prefix) ON seq = page_id % 10 GROUP BY prefix
"""


def shuffled_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The seeded swap shuffle"""
    return manifest.list_objects(_manifest(spark, sf), "cc-warc-2024-shuffled")


# The shuffle as it is defined, one swap per step over the whole list.
SHUFFLED_LISTING = f"""
WITH RECURSIVE {_LISTED},
size AS (SELECT count(*) AS n FROM listed),
target AS (
    SELECT i, (i + {sql.mix64(ordering.SHUFFLE_SEED, "i")} % (n - i)::UHUGEINT)::BIGINT AS j FROM listed, size
),
swapped(step, items) AS (
    SELECT 0::BIGINT, list(i ORDER BY i) FROM listed
    UNION ALL
    SELECT step + 1, list_transform(items, lambda x, k:
        CASE WHEN k = i + 1 THEN items[j + 1] WHEN k = j + 1 THEN items[i + 1] ELSE x END)
    FROM swapped JOIN target ON i = step
),
final AS (SELECT unnest(items) AS source, generate_subscripts(items, 1) - 1 AS position
    FROM swapped, size WHERE step = n)
SELECT printf('0102%08x', position) AS object_key, 'cc-warc2024-shuffled' AS collection,
    position AS object_index, path
FROM final JOIN listed ON i = source
"""


def seeded_order_md5(spark: SparkSession, sf: str) -> DataFrame:
    """G2"""
    numbered = ordering.dense_index(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])
    return ordering.seeded_order(numbered, method="md5")


SEEDED_ORDER_MD5 = f"""
WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS listed FROM orders)
SELECT o_orderkey, listed, row_number() OVER (ORDER BY md5('{ordering.SHUFFLE_SEED}:' || listed), listed) - 1 AS position
FROM n
"""


def mix64_order(spark: SparkSession, sf: str) -> DataFrame:
    """The hash itself, and the order by it"""
    numbered = ordering.dense_index(table(spark, sf, "pages").select("page_id"), ["page_id"])
    return ordering.seeded_order(numbered, method="mix64").withColumn(
        "hash", keys.mix64(ordering.SHUFFLE_SEED, F.col("listed")).cast("string")
    )


MIX64_ORDER = f"""
WITH n AS (SELECT page_id, row_number() OVER (ORDER BY page_id) - 1 AS listed FROM pages),
h AS (SELECT *, {sql.mix64(ordering.SHUFFLE_SEED, "listed")} AS hash FROM n)
SELECT page_id, listed, row_number() OVER (ORDER BY hash, listed) - 1 AS position, hash::VARCHAR AS hash FROM h
"""


def dense_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """positions in an order with ties on the first key"""
    events = table(spark, sf, "events").select("event_type", "event_id")
    return ordering.dense_index(events, ["event_type", "event_id"])


DENSE_NUMBERS = """
SELECT event_type, event_id, row_number() OVER (ORDER BY event_type, event_id) - 1 AS position FROM events
"""


def running_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Characters before each document in listing order"""
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return ordering.running_total(docs, "doc_id", "n_chars", "before", block=256)


RUNNING_SIZES = """
SELECT doc_id, n_chars, coalesce(sum(n_chars) OVER (
    ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
FROM documents
"""


def object_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys built from order numbers, some damaged, and read back"""
    k = F.col("o_orderkey")
    good = keys.object_key(k % 4 + 1, k)
    key = (
        F.when(k % 10 == 0, F.concat(F.lit("02"), F.substring(good, 3, 10)))
        .when(k % 10 == 1, F.concat(F.lit("0109"), F.substring(good, 5, 8)))
        .when(k % 10 == 2, F.substring(good, 1, 10))
        .when(k % 10 == 3, F.concat(F.lit("zz"), F.substring(good, 3, 10)))
        .when(k % 10 == 4, F.upper(good))
        .otherwise(good)
    )
    return table(spark, sf, "orders").select("o_orderkey", key.alias("object_key")).select(
        "*", keys.decode_object_key(F.col("object_key")).alias("d")
    ).select("o_orderkey", "object_key", "d.*")


_CODE_NAMES = ", ".join(f"({c}, '{n}')" for c, n in keys.COLLECTIONS.items())
OBJECT_KEYS = f"""
WITH k AS (
    SELECT o_orderkey, o_orderkey % 10 AS r, printf('%02x%08x', o_orderkey % 4 + 1, o_orderkey) AS tail FROM orders
)
SELECT o_orderkey,
    CASE r WHEN 0 THEN '02' || tail WHEN 1 THEN '0109' || substr(tail, 3) WHEN 2 THEN substr('01' || tail, 1, 10)
        WHEN 3 THEN 'zz' || tail WHEN 4 THEN upper('01' || tail) ELSE '01' || tail END AS object_key,
    CASE WHEN r >= 4 THEN name END AS collection,
    CASE WHEN r >= 4 THEN code END AS code,
    CASE WHEN r >= 4 THEN o_orderkey END AS object_index,
    CASE r WHEN 0 THEN 'invalid_section' WHEN 1 THEN 'unknown_collection' WHEN 2 THEN 'invalid_length'
        WHEN 3 THEN 'not_hex' END AS error
FROM k JOIN (VALUES {_CODE_NAMES}) c(code, name) ON code = o_orderkey % 4 + 1
"""


def served_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """A4: a served listing written as JSON and read back"""
    base = scratch_path(spark, "served")
    e = F.col("event_id")
    null = F.lit(None)
    dirty = F.struct(e.alias("content_length"))
    loading = F.struct(F.lit("2024-02-20T00:00:00Z").alias("time_start"), e.alias("content_length"))
    complete = F.struct(
        F.lit("2024-02-20T00:00:00Z").alias("time_start"), F.lit("2024-02-20T00:01:00Z").alias("time_end"),
        e.alias("content_length"), F.sha2(e.cast("string"), 256).alias("sha256"),
        F.struct(F.concat(F.lit("/data/"), e.cast("string")).alias("FilePath")).alias("data_location"),
    )
    kind = F.col("event_type")
    status = F.struct(
        F.when(kind == "error", dirty).alias("Dirty"),
        F.when(kind.isin("click", "view"), loading).alias("Downloading"),
        F.when(kind.isin("signup", "purchase"), complete).alias("Completed"),
    )
    key = keys.object_key(F.lit(keys.collections(spark).first().code + 2), e)
    rows = table(spark, sf, "events").select(
        "event_id", key.alias("db_key"), F.concat(F.lit("crawl-data/"), e.cast("string")).alias("s3_key"), status.alias("status")
    )
    # One JSON array per file, a thousand entries each by construction.
    arrays = (
        rows.withColumn("part", F.floor(e / 1000)).groupBy("part")
        .agg(F.to_json(F.collect_list(F.struct("db_key", "s3_key", "status"))).alias("value"))
    )
    arrays.write.partitionBy("part").text(base)
    return manifest.read_served_manifest(spark, base)


SERVED_MANIFEST = """
SELECT printf('0103%08x', event_id) AS object_key, event_id AS object_index, 'crawl-data/' || event_id AS path
FROM events WHERE event_type IN ('signup', 'purchase')
"""

def served_keys(spark: SparkSession, sf: str) -> DataFrame:
    """A4: listings cut at the commas between their entries by many tasks; wrong keys are error rows"""
    base = scratch_path(spark, "served-keys")
    e = F.col("event_id")
    good = keys.object_key(F.lit(3), e)
    key = (
        F.when(e % 10 == 0, F.concat(F.lit("zz"), F.substring(good, 3, 10))).when(e % 10 == 1, F.concat(F.lit("0109"), F.substring(good, 5, 8)))
        .when(e % 10 == 2, F.lit("ffff00000000")).when(e % 10 == 3, F.upper(good)).otherwise(good)
    )
    status = F.struct(F.struct(e.alias("content_length")).alias("Dirty"))
    path = F.concat(F.lit('odd "path", [{'), F.repeat(F.lit("\\"), (e % 4).cast("int")), e.cast("string"))
    rows = table(spark, sf, "events").select("event_id", key.alias("db_key"), path.alias("s3_key"), status.alias("status"))
    arrays = (
        rows.withColumn("part", F.floor(e / 1000)).groupBy("part")
        .agg(F.to_json(F.collect_list(F.struct("db_key", "s3_key", "status"))).alias("value"))
    )
    arrays.write.partitionBy("part").text(base)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(base).select("path")
    paths = [r.path for r in found.collect()]  # one per thousand entries
    return served.read_served_entries(spark, paths, size=16_384).select(
        "object_key", "object_index", "path", F.col("status.Dirty.content_length").alias("content_length"), "error"
    )


SERVED_KEYS = r"""
WITH e AS (
    SELECT event_id, event_id % 10 AS r, CASE event_id % 10 WHEN 0 THEN 'not_hex' WHEN 1 THEN 'unknown_collection' WHEN 2 THEN 'invalid_section' END AS error
    FROM events
)
SELECT CASE WHEN error IS NULL THEN printf('0103%08x', event_id) END AS object_key, CASE WHEN error IS NULL THEN event_id END AS object_index,
    'odd "path", [{' || repeat(chr(92), (event_id % 4)::INT) || event_id AS path, event_id AS content_length, error
FROM e
"""

QUERIES = {
    "manifest_listing": (manifest_listing, MANIFEST_LISTING),
    "crawl_sizes": (crawl_sizes, CRAWL_SIZES),
    "shuffled_listing": (shuffled_listing, SHUFFLED_LISTING),
    "seeded_order_md5": (seeded_order_md5, SEEDED_ORDER_MD5),
    "mix64_order": (mix64_order, MIX64_ORDER),
    "dense_numbers": (dense_numbers, DENSE_NUMBERS),
    "running_sizes": (running_sizes, RUNNING_SIZES),
    "object_keys": (object_keys, OBJECT_KEYS),
    "served_manifest": (served_manifest, SERVED_MANIFEST),
    "served_keys": (served_keys, SERVED_KEYS),
}
