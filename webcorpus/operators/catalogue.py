"""Catalogue of indexes as table operators: register, look up, rekey, delete, list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.functions.keys import valid_index_uuid
from webcorpus.operators.mappings import LABELS
from webcorpus.operators.progress import document_counts

SCHEMA = """
    uuid STRING, index_name STRING, collection STRING, mapping STRING, folder STRING,
    number_of_shards INT, number_of_replicas INT, codec STRING, enable_source BOOLEAN
"""


def resolve_index(requests: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Requests naming an index by ``index_name`` or ``uuid`` -> both, or an error."""
    names = catalogue.select(F.col("index_name").alias("_name"), F.col("uuid").alias("_by_name"))
    ids = catalogue.select(F.col("uuid").alias("_uuid"), F.col("index_name").alias("_by_uuid"))
    found = (
        requests.join(names, F.col("index_name") == F.col("_name"), "left")
        .join(ids, F.col("uuid") == F.col("_uuid"), "left")
    )
    carried = [c for c in requests.columns if c not in ("index_name", "uuid")]
    name, uuid = F.coalesce("index_name", "_by_uuid"), F.coalesce("uuid", "_by_name")
    return found.select(
        *carried,
        name.alias("index_name"),
        uuid.alias("uuid"),
        F.when(F.col("index_name").isNull() & F.col("uuid").isNull(), F.lit("target must be set"))
        .when(name.isNull() | uuid.isNull(), F.lit("no such index"))
        .alias("error"),
    )


def index_info(catalogue: DataFrame, uuids: DataFrame) -> DataFrame:
    """Records by uuid; an unknown uuid gives an error row."""
    marked = catalogue.withColumn("_found", F.lit(True))
    return (
        uuids.select("uuid").join(marked, "uuid", "left")
        .withColumn("error", F.when(F.col("_found").isNull(), F.lit("no such index")))
        .drop("_found")
    )


def register(catalogue: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add indexes; a malformed uuid, one in use, or one given twice is refused."""
    used = catalogue.select("uuid", F.lit(True).alias("_used"))
    # Counted by id first: a uuid given many times is one row per partition by the shuffle.
    times = rows.groupBy("uuid").agg(F.count("*").alias("_times"))
    checked = (
        rows.join(used, "uuid", "left").join(times, "uuid", "left")
        .withColumn(
            "error",
            F.when(~valid_index_uuid(F.col("uuid")), F.lit("invalid uuid length"))
            .when(F.col("_used").isNotNull() | (F.col("_times") > 1), F.lit("another index has the uuid")),
        )
        .drop("_used", "_times")
    )
    good = checked.filter("error IS NULL").select(*catalogue.columns)
    return catalogue.unionByName(good), checked.filter("error IS NOT NULL").select("uuid", "error")


def rekey(
    catalogue: DataFrame, progress: DataFrame, moves: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Move records and their progress to new uuids. ``moves``: ``from_uuid``, ``to_uuid``. The
    same uuid is a no-op; an unknown source, a used or malformed target, and a source or target
    that comes more than once are errors and move nothing."""
    times = lambda column, name: moves.groupBy(column).agg(F.count("*").alias(name))
    source = catalogue.select(F.col("uuid").alias("from_uuid"), F.lit(True).alias("_known"))
    target = catalogue.select(F.col("uuid").alias("to_uuid"), F.lit(True).alias("_used"))
    same = F.col("from_uuid") == F.col("to_uuid")
    checked = (
        moves.join(source, "from_uuid", "left").join(target, "to_uuid", "left")
        .join(times("from_uuid", "_sources"), "from_uuid", "left").join(times("to_uuid", "_targets"), "to_uuid", "left")
        .select(
            "from_uuid",
            "to_uuid",
            F.when(~valid_index_uuid(F.col("to_uuid")), F.lit("invalid uuid length"))
            .when(F.col("_known").isNull(), F.lit("no such index"))
            .when(~same & F.col("_used").isNotNull(), F.lit("another index has the uuid"))
            .when((F.col("_sources") > 1) | (F.col("_targets") > 1), F.lit("move is ambiguous"))
            .alias("error"),
        )
    )
    valid = checked.filter(F.col("error").isNull() & ~same)

    def move(df: DataFrame, column: str) -> DataFrame:
        pairs = valid.select(F.col("from_uuid").alias(column), F.col("to_uuid").alias("_to"))
        moved = df.join(pairs, column, "left")
        return moved.withColumn(column, F.coalesce("_to", column)).select(*df.columns)

    return (
        move(catalogue, "uuid"),
        move(progress, "index_uuid"),
        checked.filter("error IS NOT NULL"),
    )


def delete(
    catalogue: DataFrame, progress: DataFrame, uuids: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Drop records and their progress; an unknown uuid is an error."""
    gone = uuids.select("uuid").distinct()
    errors = gone.join(catalogue, "uuid", "left_anti").withColumn("error", F.lit("no such index"))
    kept = progress.join(gone.withColumnRenamed("uuid", "index_uuid"), "index_uuid", "left_anti")
    return catalogue.join(gone, "uuid", "left_anti"), kept, errors


def index_counts(catalogue: DataFrame, progress: DataFrame, busy: DataFrame | None = None) -> DataFrame:
    """Every index with its counts; 0 for a fresh one, NULL for one in use by another command."""
    counts = document_counts(progress).withColumnRenamed("index_uuid", "uuid")
    listed = catalogue.join(counts, "uuid", "left")
    for name in ("document_count", "created"):
        listed = listed.withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))
    if busy is None:
        return listed.withColumn("busy", F.lit(False))
    marked = listed.join(busy.select("uuid", F.lit(True).alias("busy")), "uuid", "left")
    return marked.withColumn("busy", F.coalesce("busy", F.lit(False))).withColumn(
        "document_count", F.when(~F.col("busy"), F.col("document_count"))
    )


def list_indices(
    catalogue: DataFrame, progress: DataFrame, fmt: str | None = None, busy: DataFrame | None = None
) -> DataFrame:
    """The listing in uuid order: columns, or one ``line`` per index as ``table`` text or ``json``."""
    rows = index_counts(catalogue, progress, busy)
    label = F.coalesce(
        F.try_element_at(F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv]), F.col("mapping")),
        F.col("mapping"),
    )
    if fmt == "table":
        count = F.coalesce(F.col("document_count").cast("string"), F.lit("busy"))
        line = F.concat_ws("\t", "uuid", "index_name", "collection", label, count)
    elif fmt == "json":
        fields = ["busy", "collection", "document_count", "index_name", label.alias("mapping"), "uuid"]
        line = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    else:
        return rows.orderBy("uuid")
    return rows.select("uuid", line.alias("line")).orderBy("uuid").select("line")
