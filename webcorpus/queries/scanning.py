"""Archive scan and mappings over archives written from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus import fixtures
from webcorpus.fixtures import table
from webcorpus.functions.headers import decode_content, missing_headers
from webcorpus.functions.parsers import render_rfc3339
from webcorpus.operators import mappings as maps
from webcorpus.operators.progress import object_progress
from webcorpus.operators.selection import with_position
from webcorpus.queries import sql
from webcorpus.session import scratch_path
from webcorpus.sources import archive, ranges


def _scan(spark: SparkSession, sf: str, kind: str, **options) -> DataFrame:
    code = {"warc": fixtures.WARC_CODE, "wet": fixtures.WET_CODE}[kind]
    path = fixtures.archives(spark, sf, kind)
    return fixtures.with_keys(archive.read_archives(spark, path, **options), code).drop("path")


def _warc(spark: SparkSession, sf: str) -> DataFrame:
    return maps.map_warc(archive.to_pairs(_scan(spark, sf, "warc")))


def _wet(spark: SparkSession, sf: str) -> DataFrame:
    return maps.map_wet(archive.to_pairs(_scan(spark, sf, "wet")))


def record_types(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: accepted documents and bytes per record type (A5-A8, B, C3, C5)"""
    accepted, _ = maps.split_rejects(_warc(spark, sf))
    return accepted.groupBy(F.col("doc.warc_type").alias("warc_type")).agg(
        F.count("*").alias("documents"), F.sum("doc.content_length").alias("bytes")
    )


RECORD_TYPES = f"""
WITH {sql.PAGES}
SELECT warc_type, count(*) AS documents, sum(strlen(body))::BIGINT AS bytes
FROM warc WHERE reject_reason IS NULL GROUP BY warc_type
"""


def record_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Every record with its place and exact bytes"""
    return _scan(spark, sf, "warc").filter("record_idx > 0").select(
        "object_key", "object_index", "record_idx", "content_bytes", "parse_error",
        F.md5("content").alias("content_md5"),
        F.col("headers")["WARC-Type"].alias("warc_type"),
    )


RECORD_SCAN = f"""
WITH {sql.PAGES}
SELECT object_key, object_index, record_idx, strlen(body) AS content_bytes, NULL::VARCHAR AS parse_error,
    md5(body) AS content_md5, warc_type FROM warc
"""


def payload_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Objects as whole payloads, inflated member by member; shifted framing"""
    path = fixtures.archives(spark, sf, "wet")
    rows = archive.split_payloads(archive.read_objects(spark, path), framing="reference")
    return fixtures.with_keys(rows, fixtures.WET_CODE).filter("record_idx > 0").select(
        "object_key", "record_idx", "content_bytes", F.hex(F.substring("content", 1, 2)).alias("head"),
        F.md5(F.expr("substring(content, 3)")).alias("body_md5"),
    )


# The blank line's two bytes come first, so the last two bytes of the text are lost.
PAYLOAD_SCAN = f"""
WITH {sql.DOCUMENTS}
SELECT object_key, record_idx, strlen(text) AS content_bytes, '0D0A' AS head,
    md5(unhex(substr(hex(encode(text)), 1, 2 * strlen(text) - 4))) AS body_md5
FROM wet
"""


def header_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A7 without content: header names per record"""
    rows = _scan(spark, sf, "wet", with_content=False).filter("record_idx > 0")
    headers = F.col("headers")
    names = F.array_join(missing_headers(headers, ["WARC-Identified-Content-Language", "WARC-Truncated"]), ",")
    return rows.select("object_key", "record_idx", "content_bytes", names.alias("missing"), F.size(headers).alias("headers"))


HEADER_SCAN = f"""
WITH {sql.DOCUMENTS}
SELECT object_key, record_idx, strlen(text) AS content_bytes,
    CASE WHEN d % 3 = 2 THEN 'WARC-Identified-Content-Language,WARC-Truncated' ELSE 'WARC-Truncated' END AS missing,
    CASE WHEN d % 3 = 2 THEN 9 ELSE 10 END AS headers
FROM wet
"""


def header_attach(spark: SparkSession, sf: str) -> DataFrame:
    """Stored records joined to their object's first record"""
    path = scratch_path(spark, "records")
    _scan(spark, sf, "warc").drop("content").write.parquet(path)
    stored = spark.read.parquet(path).withColumn("content", F.col("info_content"))
    rows = archive.attach_header_record(stored)
    info = F.col("info_headers")
    return rows.select(
        "object_key", "record_idx", info["WARC-Filename"].alias("filename"), info["WARC-Type"].alias("header_record_type")
    )


HEADER_ATTACH = f"""
WITH {sql.PAGES}
SELECT object_key, record_idx, printf('warc-%09d.gz', object_index) AS filename, 'warcinfo' AS header_record_type FROM warc
"""


def decode_latin1(spark: SparkSession, sf: str) -> DataFrame:
    """B2: one character per byte"""
    text = decode_content(F.col("text").cast("binary"))
    return fixtures.table(spark, sf, "documents").select(
        "doc_id", F.length(text).alias("chars"), F.octet_length(text).alias("bytes"), F.md5(F.encode(text, "ISO-8859-1")).alias("back")
    )


DECODE_LATIN1 = """
SELECT doc_id, strlen(text) AS chars,
    strlen(text) + length(list_filter(regexp_extract_all(hex(encode(text)), '..'), lambda b: b >= '80')) AS bytes,
    md5(text) AS back
FROM documents
"""


def map_warc(spark: SparkSession, sf: str) -> DataFrame:
    """C3, B3-B7, C8"""
    accepted, _ = maps.split_rejects(_warc(spark, sf))
    flat = maps.with_keyword_fields(accepted)
    plain = [
        "content_length", "content_type", "version", "record_id", "warc_type", "block_digest", "cipher_suite",
        "concurrent_to", "identified_payload_type", "ip_address", "payload_digest", "protocol", "target_uri",
        "truncated", "warcinfo_id",
    ]
    return flat.select(
        "object_key", "record_idx", "doc_id",
        *[F.col(f"doc.{name}").alias(name) for name in plain],
        render_rfc3339(F.col("doc.date")).alias("date"),
        F.length("doc.content").alias("content_chars"),
        "target_uri_keyword",
        F.col("doc.warc_info.filename").alias("info_filename"),
        F.col("doc.warc_info.record_id").alias("info_record_id"),
        F.col("doc.warc_info.content").alias("info_content"),
        render_rfc3339(F.col("doc.warc_info.date")).alias("info_date"),
    )


MAP_WARC = f"""
WITH {sql.PAGES}
SELECT object_key, record_idx, record_id AS doc_id, strlen(body) AS content_length,
    CASE WHEN p % 3 = 2 THEN 'application/warc-fields' ELSE 'application/http' END AS content_type,
    'WARC/1.0' AS version, record_id, warc_type,
    CASE WHEN response THEN 'sha1:' || upper(sha1(html)) END AS block_digest,
    CASE WHEN p % 12 = 0 THEN 'TLS_AES_128_GCM_SHA256' END AS cipher_suite,
    concurrent_to,
    CASE WHEN response THEN 'text/html' END AS identified_payload_type,
    ip_address,
    CASE WHEN p % 6 = 0 THEN 'md5:' || md5(html) END AS payload_digest,
    CASE WHEN p % 9 = 0 THEN 'h2' END AS protocol,
    target_uri,
    CASE WHEN p % 15 = 0 THEN 'length' END AS truncated,
    warcinfo_id, date, strlen(body) AS content_chars, target_uri AS target_uri_keyword,
    printf('warc-%09d.gz', object_index) AS info_filename,
    {sql.uuid("'warc:' || object_index")} AS info_record_id,
    E'isPartOf: own archive\\r\\n' AS info_content,
    '2024-02-20T00:00:00Z' AS info_date
FROM warc WHERE reject_reason IS NULL
"""


def map_wet(spark: SparkSession, sf: str) -> DataFrame:
    """C2, B8"""
    accepted, _ = maps.split_rejects(_wet(spark, sf))
    return accepted.select(
        "object_key", "record_idx", "doc_id",
        F.col("doc.content_length").alias("content_length"),
        F.col("doc.block_digest").alias("block_digest"),
        render_rfc3339(F.col("doc.date")).alias("date"),
        F.array_join("doc.identified_content_language", "|").alias("languages"),
        F.size("doc.identified_content_language").alias("n_languages"),
        F.col("doc.refers_to").alias("refers_to"),
        F.col("doc.target_uri").alias("target_uri"),
        F.col("doc.warc_type").alias("warc_type"),
        F.md5(F.encode("doc.content", "ISO-8859-1")).alias("content_md5"),
    )


MAP_WET = f"""
WITH {sql.DOCUMENTS}
SELECT object_key, record_idx, record_id AS doc_id, strlen(text) AS content_length,
    'sha1:' || upper(sha1(text)) AS block_digest, {sql.instant("d")} AS date,
    CASE d % 3 WHEN 0 THEN lang WHEN 1 THEN lang || '|eng' ELSE '' END AS languages,
    CASE d % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS n_languages,
    {sql.uuid("d + 1")} AS refers_to, printf('http://source.example.com/%d', d) AS target_uri,
    'conversion' AS warc_type, md5(text) AS content_md5
FROM wet
"""


def map_raw(spark: SparkSession, sf: str) -> DataFrame:
    """The pair as JSON, id with its brackets"""
    mapped = maps.map_raw(archive.to_pairs(_scan(spark, sf, "warc")))
    accepted, _ = maps.split_rejects(mapped)
    field = lambda path: F.get_json_object("doc", f"$.{path}")
    return accepted.select(
        "object_key", "record_idx", "doc_id",
        F.md5(F.encode(field("entry.Content"), "ISO-8859-1")).alias("content_md5"),
        F.get_json_object("doc", "$.entry['WARC-Type']").alias("warc_type"),
        F.get_json_object("doc", "$.warc_info['WARC-Filename']").alias("filename"),
        F.substring("doc", 1, 21).alias("head"),
    )


MAP_RAW = f"""
WITH {sql.PAGES}
SELECT object_key, record_idx, '<urn:uuid:' || record_id || '>' AS doc_id, md5(body) AS content_md5, warc_type,
    printf('warc-%09d.gz', object_index) AS filename, '{{"entry":{{"Content":"' AS head
FROM warc WHERE p % 23 <> 0
"""


def rejects(spark: SparkSession, sf: str) -> DataFrame:
    """C4, C5"""
    _, bad = maps.split_rejects(_warc(spark, sf))
    return bad.groupBy("reject_reason").agg(F.count("*").alias("records"), F.min("record_idx").alias("first_idx"))


REJECTS = f"""
WITH {sql.PAGES}
SELECT reject_reason, count(*) AS records, min(record_idx) AS first_idx FROM warc
WHERE reject_reason IS NOT NULL GROUP BY reject_reason
"""


def field_fill(spark: SparkSession, sf: str) -> DataFrame:
    """How many documents have each declared field, with its kind"""
    chosen = maps.mapping("cc-wet")
    accepted, _ = maps.split_rejects(maps.conform(chosen.transform(archive.to_pairs(_scan(spark, sf, "wet"))), chosen.schema))
    fields = maps.field_rows(spark, chosen.name)
    names = [row.field for row in fields.collect()]  # the fixed declaration
    filled = accepted.agg(*[F.count(F.col(f"doc.{n}")).alias(n.replace(".", "__")) for n in names])
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.col(n.replace(".", "__")).alias("filled")) for n in names])
    return filled.select(F.inline(pairs)).join(fields, "field")


_WET_FIELDS = [
    ("content", "text", None), ("content_length", "long", None), ("content_type", "keyword", None),
    ("version", "keyword", None), ("block_digest", "keyword", None), ("date", "date", None),
    ("identified_content_language", "keyword", None), ("record_id", "keyword", None),
    ("refers_to", "keyword", None), ("target_uri", "text", 256), ("warc_type", "keyword", None),
    ("warc_info.content", "text", None), ("warc_info.content_length", "long", None),
    ("warc_info.content_type", "keyword", None), ("warc_info.version", "keyword", None),
    ("warc_info.date", "date", None), ("warc_info.filename", "text", 256),
    ("warc_info.record_id", "keyword", None), ("warc_info.warc_type", "keyword", None),
]
_VALUES = ", ".join(f"('{f}', '{k}', {'NULL' if n is None else n}::INT)" for f, k, n in _WET_FIELDS)
FIELD_FILL = f"""
SELECT field, n AS filled, kind, ignore_above
FROM (VALUES {_VALUES}) v(field, kind, ignore_above), (SELECT count(*) AS n FROM documents)
"""


def source_switch(spark: SparkSession, sf: str) -> DataFrame:
    """The document's JSON kept or left out"""
    accepted, _ = maps.split_rejects(_wet(spark, sf))
    kept = maps.with_source(accepted, True)
    dropped = maps.with_source(kept, False)
    return kept.select(
        "object_key", "record_idx",
        F.get_json_object("_source", "$.record_id").alias("record_id"),
        F.get_json_object("_source", "$.date").alias("date"),
        F.lit("_source" in dropped.columns).alias("still_there"),
    )


SOURCE_SWITCH = f"""
WITH {sql.DOCUMENTS}
SELECT object_key, record_idx, record_id, {sql.instant("d")} AS date, false AS still_there FROM wet
"""


def split_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Archives of one member per record, each read by many tasks, with the records' own numbers"""
    path = scratch_path(spark, "members")
    names = fixtures.write_member_archives(fixtures.warc_rows(table(spark, sf, "pages")), path)
    records = ranges.read_split(spark, [f"{path}/{name}" for name in names], size=8192)
    index = F.regexp_extract("path", "([0-9]+)[.]gz$", 1).cast("bigint")
    return records.filter("record_idx > 0").select(
        index.alias("object_index"), "record_idx", "content_bytes", "parse_error", F.md5("content").alias("content_md5"),
        F.col("headers")["WARC-Type"].alias("warc_type"), F.col("info_headers")["WARC-Type"].alias("info_type"),
    )


SPLIT_SCAN = f"""
WITH {sql.PAGES}
SELECT object_index, record_idx, strlen(body) AS content_bytes, NULL::VARCHAR AS parse_error, md5(body) AS content_md5, warc_type,
    'warcinfo' AS info_type
FROM warc
"""


def object_states(spark: SparkSession, sf: str) -> DataFrame:
    """E5: progress per object when a run stops in the middle"""
    rows = with_position(_warc(spark, sf)).select(
        "object_key", "object_index", "record_idx", "pos",
        F.when(F.col("reject_reason").isNull(), "created").otherwise("rejected").alias("outcome"),
        F.lit(None).cast("string").alias("parse_error"),
    )
    return object_progress(rows, cut=(1 << 31) + 10)


OBJECT_STATES = f"""
WITH {sql.PAGES}
SELECT object_key, max(record_idx) FILTER (used) AS next_record_idx, bool_and(used) AS done,
    count(*) FILTER (used AND reject_reason IS NULL) AS created, 0::BIGINT AS already_exists, 0::BIGINT AS failed,
    count(*) FILTER (used AND reject_reason IS NOT NULL) AS rejected
FROM (SELECT *, object_index < 1 OR (object_index = 1 AND record_idx <= 10) AS used FROM warc)
GROUP BY object_key HAVING bool_or(used)
"""

QUERIES = {
    "record_types": (record_types, RECORD_TYPES),
    "record_scan": (record_scan, RECORD_SCAN),
    "payload_scan": (payload_scan, PAYLOAD_SCAN),
    "header_scan": (header_scan, HEADER_SCAN),
    "header_attach": (header_attach, HEADER_ATTACH),
    "decode_latin1": (decode_latin1, DECODE_LATIN1),
    "map_warc": (map_warc, MAP_WARC),
    "map_wet": (map_wet, MAP_WET),
    "map_raw": (map_raw, MAP_RAW),
    "rejects": (rejects, REJECTS),
    "field_fill": (field_fill, FIELD_FILL),
    "source_switch": (source_switch, SOURCE_SWITCH),
    "split_scan": (split_scan, SPLIT_SCAN),
    "object_progress": (object_states, OBJECT_STATES),
}
