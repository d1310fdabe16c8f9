"""Catalogue and progress tables: customers as indexes, orders as their objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.fixtures import table
from webcorpus.functions.keys import object_key, valid_index_uuid
from webcorpus.operators import catalogue as cat
from webcorpus.operators.progress import COUNTS, commit_progress, document_counts


def _uuid(key):
    return F.substring(F.md5(key.cast("string").cast("binary")), 1, 22)


def _pick(names, i):
    return F.element_at(F.array(*[F.lit(n) for n in names]), (i + 1).cast("int"))


def _catalogue(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        _uuid(k).alias("uuid"), F.col("c_name").alias("index_name"),
        _pick(["cc-warc2024", "cc-wet2024"], k % 2).alias("collection"), _pick(["cc-warc", "cc-wet"], k % 2).alias("mapping"),
        k.cast("string").alias("folder"), F.lit(1).alias("number_of_shards"), F.lit(0).alias("number_of_replicas"),
        F.lit("default").alias("codec"), F.lit(False).alias("enable_source"),
    )


def _progress(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        _uuid(F.col("o_custkey")).alias("index_uuid"), object_key(F.lit(3), k).alias("object_key"),
        (k % 1000).alias("next_record_idx"), (k % 3 == 0).alias("done"), (k % 1000 - k % 1000 % 7).alias("created"),
        (k % 1000 % 7).alias("already_exists"), F.lit(0).cast("bigint").alias("failed"), F.lit(0).cast("bigint").alias("rejected"),
        F.lit(1).cast("bigint").alias("run_id"),
    )


_ID = "substr(md5(c_custkey::VARCHAR), 1, 22)"
_CAT = f"""
cat AS (
    SELECT c_custkey AS k, {_ID} AS uuid, c_name AS index_name,
        CASE c_custkey % 2 WHEN 0 THEN 'cc-warc2024' ELSE 'cc-wet2024' END AS collection,
        CASE c_custkey % 2 WHEN 0 THEN 'cc-warc' ELSE 'cc-wet' END AS mapping
    FROM customer
), prog AS (
    SELECT o_custkey AS k, substr(md5(o_custkey::VARCHAR), 1, 22) AS index_uuid, printf('0103%08x', o_orderkey) AS object_key,
        o_orderkey % 1000 AS next_record_idx, o_orderkey % 3 = 0 AS done,
        o_orderkey % 1000 - o_orderkey % 1000 % 7 AS created
    FROM orders
)"""


def index_counts(spark: SparkSession, sf: str) -> DataFrame:
    """E1, over the progress alone"""
    return document_counts(_progress(spark, sf))


INDEX_COUNTS = f"""
WITH {_CAT}
SELECT index_uuid, sum(next_record_idx)::BIGINT AS document_count, sum(created)::BIGINT AS created FROM prog GROUP BY index_uuid
"""


def _busy(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").filter("c_custkey % 10 = 3").select(_uuid(F.col("c_custkey")).alias("uuid"))


def list_table(spark: SparkSession, sf: str) -> DataFrame:
    """Tab-separated lines"""
    return cat.list_indices(_catalogue(spark, sf), _progress(spark, sf), "table", _busy(spark, sf))


def list_json(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines"""
    return cat.list_indices(_catalogue(spark, sf), _progress(spark, sf), "json", _busy(spark, sf))


_LISTED = f"""
{_CAT}, listed AS (
    SELECT cat.*, CASE mapping WHEN 'cc-warc' THEN 'CcWarc' ELSE 'CcWet' END AS label, k % 10 = 3 AS busy,
        coalesce((SELECT sum(next_record_idx) FROM prog WHERE prog.k = cat.k), 0)::BIGINT AS n
    FROM cat
)"""
LIST_TABLE = f"""
WITH {_LISTED}
SELECT concat_ws(chr(9), uuid, index_name, collection, label, CASE WHEN busy THEN 'busy' ELSE n::VARCHAR END) AS line
FROM listed ORDER BY uuid
"""
LIST_JSON = f"""
WITH {_LISTED}
SELECT '{{"busy":' || busy || ',"collection":"' || collection || '","document_count":' ||
    CASE WHEN busy THEN 'null' ELSE n::VARCHAR END || ',"index_name":"' || index_name || '","mapping":"' || label ||
    '","uuid":"' || uuid || '"}}' AS line
FROM listed ORDER BY uuid
"""


def resolve_index(spark: SparkSession, sf: str) -> DataFrame:
    """Every order names its index by name, by uuid, wrongly, or not at all"""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    requests = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(k % 5 == 0, F.format_string("Customer#%09d", c)).when(k % 5 == 1, F.lit("nobody")).alias("index_name"),
        F.when(k % 5 == 2, _uuid(c)).when(k % 5 == 3, F.lit("x" * 22)).alias("uuid"),
    )
    return cat.resolve_index(requests, _catalogue(spark, sf))


RESOLVE_INDEX = f"""
WITH {_CAT}
SELECT o_orderkey,
    CASE o_orderkey % 5 WHEN 0 THEN cat.index_name WHEN 1 THEN 'nobody' WHEN 2 THEN cat.index_name END AS index_name,
    CASE o_orderkey % 5 WHEN 0 THEN cat.uuid WHEN 2 THEN cat.uuid WHEN 3 THEN repeat('x', 22) END AS uuid,
    CASE o_orderkey % 5 WHEN 1 THEN 'no such index' WHEN 3 THEN 'no such index' WHEN 4 THEN 'target must be set' END AS error
FROM orders JOIN cat ON k = o_custkey
"""


def index_info(spark: SparkSession, sf: str) -> DataFrame:
    """Look-ups by customer number, some unknown or malformed"""
    k = F.col("c_custkey")
    asked = table(spark, sf, "customer").select(
        F.when(k % 3 == 0, _uuid(k)).when(k % 3 == 1, _uuid(-k)).otherwise(F.lpad(k.cast("string"), 21, "é")).alias("uuid")
    )
    return cat.index_info(_catalogue(spark, sf), asked).select(
        "uuid", "index_name", "collection", "mapping", "error", valid_index_uuid(F.col("uuid")).alias("valid")
    )


INDEX_INFO = f"""
WITH {_CAT}, asked AS (
    SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN {_ID} WHEN 1 THEN substr(md5((-c_custkey)::VARCHAR), 1, 22)
        ELSE lpad(c_custkey::VARCHAR, 21, 'é') END AS uuid
    FROM customer
)
SELECT asked.uuid, index_name, collection, mapping, CASE WHEN cat.uuid IS NULL THEN 'no such index' END AS error,
    strlen(asked.uuid) = 22 AS valid
FROM asked LEFT JOIN cat ON cat.uuid = asked.uuid
"""


def register_index(spark: SparkSession, sf: str) -> DataFrame:
    """Even customers are registered, then a third of all asks to be"""
    catalogue = _catalogue(spark, sf)
    held = catalogue.filter("folder % 2 = 0")
    k = F.col("folder").cast("bigint")
    asked = catalogue.filter(k % 3 == 0).withColumn("uuid", F.when(k % 9 == 0, F.lit("short")).otherwise(F.col("uuid")))
    after, errors = cat.register(held, asked)
    return after.select("uuid", F.lit(None).cast("string").alias("error")).unionByName(errors)


REGISTER_INDEX = f"""
WITH {_CAT}
SELECT uuid, NULL::VARCHAR AS error FROM cat WHERE k % 2 = 0
UNION ALL SELECT uuid, NULL FROM cat WHERE k % 2 = 1 AND k % 3 = 0 AND k % 9 <> 0
UNION ALL SELECT CASE WHEN k % 9 = 0 THEN 'short' ELSE uuid END,
    CASE WHEN k % 9 = 0 THEN 'invalid uuid length' ELSE 'another index has the uuid' END
FROM cat WHERE k % 3 = 0 AND (k % 9 = 0 OR k % 2 = 0)
"""


def rekey_index(spark: SparkSession, sf: str) -> DataFrame:
    """Records and their progress move together"""
    k = F.col("c_custkey")
    moves = table(spark, sf, "customer").filter(k % 2 == 0).select(
        F.when(k % 12 == 2, _uuid(-k)).otherwise(_uuid(k)).alias("from_uuid"),
        F.when(k % 12 == 4, F.lit("short")).when(k % 12 == 6, _uuid(k)).when(k % 12 == 8, _uuid(k + 1))
        .otherwise(F.concat(F.lit("n"), F.substring(_uuid(k), 2, 21))).alias("to_uuid"),
    )
    catalogue, progress, errors = cat.rekey(_catalogue(spark, sf), _progress(spark, sf), moves)
    counts = document_counts(progress).withColumnRenamed("index_uuid", "uuid")
    rows = catalogue.select("uuid", "index_name").join(counts.select("uuid", "document_count"), "uuid", "left")
    return rows.withColumn("error", F.lit(None).cast("string")).unionByName(
        errors.select(F.col("from_uuid").alias("uuid"), "error"), allowMissingColumns=True
    )


# c_custkey runs from 0 without gaps, so customer k + 1 is missing only for the last one.
REKEY_INDEX = f"""
WITH {_CAT}, last AS (SELECT max(c_custkey) AS m FROM customer)
SELECT CASE WHEN k % 12 IN (0, 10) THEN 'n' || substr(uuid, 2)
    WHEN k % 12 = 8 AND k = m THEN substr(md5((k + 1)::VARCHAR), 1, 22) ELSE uuid END AS uuid, index_name,
    (SELECT sum(next_record_idx)::BIGINT FROM prog WHERE prog.k = cat.k) AS document_count, NULL::VARCHAR AS error
FROM cat, last
UNION ALL
SELECT CASE WHEN k % 12 = 2 THEN substr(md5((-k)::VARCHAR), 1, 22) ELSE uuid END, NULL, NULL,
    CASE k % 12 WHEN 2 THEN 'no such index' WHEN 4 THEN 'invalid uuid length' ELSE 'another index has the uuid' END
FROM cat, last WHERE k % 12 IN (2, 4) OR (k % 12 = 8 AND k < m)
"""


def delete_index(spark: SparkSession, sf: str) -> DataFrame:
    """Asked twice for some, for unknown ones too"""
    k = F.col("c_custkey")
    customers = table(spark, sf, "customer")
    gone = customers.filter(k % 3 == 0).select(_uuid(k).alias("uuid")).unionByName(
        customers.filter(k % 6 == 0).select(_uuid(k).alias("uuid"))
    ).unionByName(customers.filter((k % 50 == 7)).select(_uuid(-k).alias("uuid")))
    catalogue, progress, errors = cat.delete(_catalogue(spark, sf), _progress(spark, sf), gone)
    left = document_counts(progress).select(F.col("index_uuid").alias("uuid"), "document_count")
    return catalogue.select("uuid").join(left, "uuid", "full").withColumn("error", F.lit(None).cast("string")).unionByName(
        errors.select("uuid", "error"), allowMissingColumns=True
    )


DELETE_INDEX = f"""
WITH {_CAT}
SELECT uuid, (SELECT sum(next_record_idx)::BIGINT FROM prog WHERE prog.k = cat.k) AS document_count, NULL::VARCHAR AS error
FROM cat WHERE k % 3 <> 0
UNION ALL
SELECT substr(md5((-k)::VARCHAR), 1, 22), NULL, 'no such index' FROM cat WHERE k % 50 = 7
"""


def progress_commit(spark: SparkSession, sf: str) -> DataFrame:
    """I4: a second run touches half of the objects"""
    old = _progress(spark, sf)
    n = F.col("next_record_idx")
    delta = old.filter(F.conv(F.substring("object_key", 5, 8), 16, 10).cast("bigint") % 2 == 0).select(
        "index_uuid", "object_key", (n + 5).alias("next_record_idx"), (n % 2 == 0).alias("done"),
        F.lit(4).cast("bigint").alias("created"), F.lit(0).cast("bigint").alias("already_exists"),
        F.lit(0).cast("bigint").alias("failed"), F.lit(1).cast("bigint").alias("rejected"), F.lit(2).cast("bigint").alias("run_id"),
    )
    return commit_progress(old, delta).select("index_uuid", "object_key", "next_record_idx", "done", *COUNTS, "run_id")


PROGRESS_COMMIT = """
WITH o AS (SELECT *, o_orderkey % 1000 AS n, o_orderkey % 2 = 0 AS touched FROM orders)
SELECT substr(md5(o_custkey::VARCHAR), 1, 22) AS index_uuid, printf('0103%08x', o_orderkey) AS object_key,
    n + CASE WHEN touched THEN 5 ELSE 0 END AS next_record_idx,
    o_orderkey % 3 = 0 OR (touched AND n % 2 = 0) AS done,
    n - n % 7 + CASE WHEN touched THEN 4 ELSE 0 END AS created, n % 7 AS already_exists, 0::BIGINT AS failed,
    CASE WHEN touched THEN 1 ELSE 0 END::BIGINT AS rejected, CASE WHEN touched THEN 2 ELSE 1 END::BIGINT AS run_id
FROM o
"""

QUERIES = {
    "document_counts": (index_counts, INDEX_COUNTS),
    "list_table": (list_table, LIST_TABLE),
    "list_json": (list_json, LIST_JSON),
    "resolve_index": (resolve_index, RESOLVE_INDEX),
    "index_info": (index_info, INDEX_INFO),
    "register_index": (register_index, REGISTER_INDEX),
    "rekey_index": (rekey_index, REKEY_INDEX),
    "delete_index": (delete_index, DELETE_INDEX),
    "progress_commit": (progress_commit, PROGRESS_COMMIT),
}
