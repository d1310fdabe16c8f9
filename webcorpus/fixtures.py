"""Archives, manifests and replies derived from the driver tables by formula.

Every value follows from the row's id, so a query's expected result can be stated in SQL
without parsing anything. The archives are written by Spark as text with compression: each
record is one row, and the line separator is the record terminator.
"""

from __future__ import annotations

import gzip
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.functions.keys import object_key
from webcorpus.functions.parsers import render_rfc3339
from webcorpus.session import scratch_path

# Records per archive: a hundredth of the table, at least so many, at most a few thousand.
PAGES_PER_OBJECT = 25
DOCUMENTS_PER_OBJECT = 100
LARGEST_OBJECT = 5000
WARC_CODE, WET_CODE = 1, 3
BASE_SECONDS = 1708387200  # 2024-02-20T00:00:00Z

INFO_CONTENT = "isPartOf: own archive\r\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_object(df: DataFrame, least: int) -> int:
    return max(least, min(LARGEST_OBJECT, -(-df.count() // 100)))


def uuid_of(text: Column) -> Column:
    """MD5 of the text, hyphenated."""
    h = F.md5(text.cast("string").cast("binary"))
    return F.concat_ws("-", *[F.substring(h, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def urn(text: Column) -> Column:
    return F.concat(F.lit("<urn:uuid:"), uuid_of(text), F.lit(">"))


def header(name: str, value: Column) -> Column:
    """One header line; NULL leaves the header out."""
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))


def record(headers: dict[str, Column], content: Column) -> Column:
    lines = [header(name, value) for name, value in headers.items()]
    size = header("Content-Length", F.octet_length(content).cast("string"))
    return F.concat(F.lit("WARC/1.0\r\n"), *lines, size, F.lit("\r\n"), content)


def instant(seconds: Column, offset_hours: int = 0) -> Column:
    """Wall-clock text of a time so many seconds after the base, moved by whole hours."""
    return F.left(render_rfc3339(F.timestamp_seconds(F.lit(BASE_SECONDS + offset_hours * 3600) + seconds)), F.lit(19))


def info_record(kind: str, objects: DataFrame) -> DataFrame:
    """The first record of each object."""
    name = F.concat(F.lit(f"{kind}-"), F.lpad(F.col("object_index").cast("string"), 9, "0"), F.lit(".gz"))
    headers = {
        "WARC-Type": F.lit("warcinfo"),
        "WARC-Date": F.lit("2024-02-20T00:00:00Z"),
        "WARC-Filename": name,
        "WARC-Record-ID": urn(F.concat(F.lit(f"{kind}:"), F.col("object_index").cast("string"))),
        "Content-Type": F.lit("application/warc-fields"),
    }
    return objects.select(
        "object_index", F.lit(0).cast("bigint").alias("record_idx"), record(headers, F.lit(INFO_CONTENT)).alias("value")
    )


def placed(df: DataFrame, id_col: str, per_object: int) -> DataFrame:
    ident = F.col(id_col)
    return df.withColumn("object_index", F.floor(ident / per_object).cast("bigint")).withColumn(
        "record_idx", (ident % per_object + 1).cast("bigint")
    )


def warc_rows(pages: DataFrame) -> DataFrame:
    """Pages as response, request and metadata records, with planted corner cases."""
    size = per_object(pages, PAGES_PER_OBJECT)
    p = F.col("page_id")
    response = p % 3 == 0
    some = lambda cond, value: F.when(cond, value)
    text = lambda fmt: F.format_string(fmt, p)
    date = (
        F.when(p % 5 == 0, F.concat(instant(p, 2), F.lit("+02:00")))
        .when(p % 7 == 0, F.concat(instant(p), F.lit(".250Z")))
        .otherwise(F.concat(instant(p), F.lit("Z")))
    )
    uri = (
        F.when(p % 17 == 0, F.lit("not a url"))
        .when(p % 11 == 3, text("HTTP://EXAMPLE.com:80/a/../p%d"))
        .when(p % 13 == 5, text("http://example.com/p %d/é"))
        .otherwise(F.col("url"))
    )
    ip = (
        F.when(p % 19 == 0, F.lit("not-an-ip"))
        .when(p % 4 == 0, F.format_string("2606:2800:0:0:0:0:00%s:1", F.lower(F.hex(p % 16 + 1))))
        .otherwise(F.format_string("10.%d.%d.1", (p / 256).cast("bigint") % 256, p % 256))
    )
    # A payload that holds a whole record of its own, version line included.
    nested = F.concat(F.col("html"), F.lit("\r\n\r\nWARC/1.0\r\nContent-Length: 2\r\n\r\nxx\r\n\r\n"), F.col("html"))
    headers = {
        "WARC-Type": F.when(response, F.lit("response")).when(p % 3 == 1, F.lit("request")).otherwise(F.lit("metadata")),
        "WARC-Date": date,
        "WARC-Record-ID": some(p % 23 != 0, urn(p)),
        "WARC-Target-URI": some(~((p % 3 == 2) & (p % 2 == 0)), uri),
        "WARC-IP-Address": some(response, ip),
        "WARC-Concurrent-To": some(p % 3 != 0, urn(p - p % 3)),
        "WARC-Warcinfo-ID": some(response, urn(F.concat(F.lit("warc:"), F.col("object_index").cast("string")))),
        "WARC-Block-Digest": some(response, F.concat(F.lit("sha1:"), F.upper(F.sha1(F.col("html").cast("binary"))))),
        "WARC-Payload-Digest": some(p % 6 == 0, F.concat(F.lit("md5:"), F.md5(F.col("html").cast("binary")))),
        "WARC-Identified-Payload-Type": some(response, F.lit("text/html")),
        "WARC-Protocol": some(p % 9 == 0, F.lit("h2")),
        "WARC-Cipher-Suite": some(p % 12 == 0, F.lit("TLS_AES_128_GCM_SHA256")),
        "WARC-Truncated": some(p % 15 == 0, F.lit("length")),
        "Content-Type": F.when(p % 3 == 2, F.lit("application/warc-fields")).otherwise(F.lit("application/http")),
    }
    body = F.when(p % 13 == 0, nested).otherwise(F.col("html"))
    rows = placed(pages, "page_id", size).select("object_index", "record_idx", record(headers, body).alias("value"))
    first = placed(pages.filter(p % size == 0), "page_id", size)
    return rows.unionByName(info_record("warc", first))


def wet_rows(documents: DataFrame) -> DataFrame:
    """Documents as extracted-text records; the id is the MD5 of the text, so repeats collide."""
    size = per_object(documents, DOCUMENTS_PER_OBJECT)
    d = F.col("doc_id")
    languages = F.when(d % 3 == 0, F.col("lang")).when(d % 3 == 1, F.concat("lang", F.lit(" , eng")))
    headers = {
        "WARC-Type": F.lit("conversion"),
        "WARC-Target-URI": F.format_string("http://source.example.com/%d", d),
        "WARC-Date": F.concat(instant(d), F.lit("Z")),
        "WARC-Record-ID": urn(F.col("text")),
        "WARC-Refers-To": urn(d + 1),
        "WARC-Block-Digest": F.concat(F.lit("sha1:"), F.upper(F.sha1(F.col("text").cast("binary")))),
        "WARC-Identified-Content-Language": languages,
        "Content-Type": F.lit("text/plain"),
    }
    rows = placed(documents, "doc_id", size).select("object_index", "record_idx", record(headers, F.col("text")).alias("value"))
    first = placed(documents.filter(d % size == 0), "doc_id", size)
    return rows.unionByName(info_record("wet", first))


def write_archives(rows: DataFrame, path: str) -> None:
    """One gzip archive per object, streamed by the text writer in record order."""
    # A stated width, so that small tables are not written by one task.
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # By a hash of its own: rows that come from a join on the index would not be dealt again, and the
    # join may turn out to leave an object's rows in several tasks, so in several files. Compressed fast:
    # at the usual level that took more time than scanning and storing what is written.
    (
        rows.repartition(width, F.xxhash64("object_index")).sortWithinPartitions("object_index", "record_idx")
        .select("object_index", "value")
        .write.partitionBy("object_index").option("lineSep", "\r\n\r\n").option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED").text(path)
    )


def _write_members(folder: str):
    """Rows (object_index, value) in record order -> one file per object, each record a gzip member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, name = None, None

        def close() -> str:
            stream.close()
            os.replace(f"{folder}/.{name}.{token}", f"{folder}/{name}")  # a repeated task gives the same file
            return name

        token, done = uuid.uuid4().hex, []
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            for index, value in zip(batch.column("object_index").to_pylist(), batch.column("value")):
                if name != f"{index:06d}.gz":
                    if stream is not None:
                        done.append(close())
                    name = f"{index:06d}.gz"
                    stream = open(f"{folder}/.{name}.{token}", "wb")
                stream.write(gzip.compress(value.as_py().encode() + b"\r\n\r\n", mtime=0))
        if stream is not None:
            done.append(close())
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], ["name"])

    return run


def write_member_archives(rows: DataFrame, path: str) -> list[str]:
    """One archive per object as they are published, a member per record, below a folder that the
    executors share -> the files' names."""
    dealt = rows.repartition("object_index").sortWithinPartitions("object_index", "record_idx")
    folder = path.removeprefix("file://").removeprefix("file:")
    written = dealt.select("object_index", "value").mapInArrow(_write_members(folder), "name STRING")
    return sorted(row.name for row in written.collect())


def with_keys(df: DataFrame, code: int) -> DataFrame:
    """Object key and index of rows that carry the path of a written archive: no join needed."""
    index = F.regexp_extract("path", "object_index=([0-9]+)", 1).cast("bigint")
    return df.select(object_key(F.lit(code), index).alias("object_key"), index.alias("object_index"), "*")


def list_written(spark: SparkSession, path: str, code: int) -> DataFrame:
    """The archives under a folder as objects."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz")
        .load(path).select("path")
    )
    return with_keys(found, code)


_written: dict[tuple[str, str, str], str] = {}


def archives(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Folder with the WARC or WET archives of a scale, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _written:
        path = scratch_path(spark, f"archives-{kind}")
        rows = warc_rows(table(spark, sf_dir, "pages")) if kind == "warc" else wet_rows(table(spark, sf_dir, "documents"))
        write_archives(rows, path)
        _written[key] = path
    return _written[key]
