"""A corpus cleaned and packed in five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.llm import chosen_path, decontaminate, language, packing, secrets
from webcorpus.llm.common import prepare, table, written
from webcorpus.session import ship_package

CERTAIN = 0.4  # least score of a language that is kept
ROW = "__row"  # the number of a row within a stage


def _ready(spark: SparkSession) -> None:
    ship_package(spark)
    prepare(spark)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a letter, and uncertain ones, go."""
    _ready(spark)
    learn = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2
    found = language.detect(docs, learn=F.coalesce(learn, F.lit(False)))
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= CERTAIN)).select(*docs.columns)


def _keyed(docs: DataFrame, label: str) -> DataFrame:
    """The rows with a unique number each, written so that it stays."""
    return written(docs.withColumn(ROW, F.monotonically_increasing_id()), label)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: one with the least doc_id. Rows that share a doc_id
    but not their text are told apart. Rows without a doc_id are kept."""
    _ready(spark)
    rows = _keyed(docs, "dedup-rows")
    named = rows.filter("doc_id IS NOT NULL")
    found = chosen_path.near_duplicates(named.select(F.col(ROW).alias("doc_id"), "text"), k=5, above=100, below=80)
    groups = found.select(F.col("doc_id").alias(ROW), "component_id").join(named.select(ROW, "doc_id"), ROW)
    kept = groups.groupBy("component_id").agg(F.min(F.struct("doc_id", ROW)).alias("least")).select(f"least.{ROW}")
    named = named.join(kept, ROW, "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns)
    return named.unionByName(rows.filter("doc_id IS NULL").select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item, with or without a doc_id."""
    _ready(spark)
    rows = _keyed(docs, "leak-rows")
    texts = rows.select(F.col(ROW).alias("doc_id"), "text")
    leaks = decontaminate.find_leaks(texts, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(ROW)).distinct()
    return rows.join(leaks, ROW, "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark and n_chars counted anew."""
    _ready(spark)
    clean = secrets.redact_secrets(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    _ready(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secret_scan),
    ("packing", best_fit_packing),
]

# Learned models and set similarity aren't SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents table on."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
