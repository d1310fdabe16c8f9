"""Scalar parsers over values built from the tables, good and malformed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.fixtures import table, urn
from webcorpus.functions import headers, keys, parsers
from webcorpus.operators import mappings as maps
from webcorpus.queries import sql


def _parsed(df: DataFrame, key: str, value: Column, parse: Callable[[Column], Column], out: str) -> DataFrame:
    """Build the text column first, then parse it, as two steps."""
    return df.select(key, value.alias("value")).select(key, parse(F.col("value")).alias(out))


def parse_urns(spark: SparkSession, sf: str) -> DataFrame:
    """B3"""
    k = F.col("o_orderkey")
    good = urn(k)
    value = (
        F.when(k % 7 == 1, F.upper(good))
        .when(k % 7 == 2, F.concat(F.lit("<urn:uuid:"), F.upper(F.substring(good, 11, 36)), F.lit(">")))
        .when(k % 7 == 3, F.concat(good, F.lit(" ")))
        .when(k % 7 == 4, F.substring(good, 2, 45))
        .when(k % 7 == 5, F.regexp_replace(good, "-", "_"))
        .when(k % 7 == 6, F.lit(""))
        .otherwise(good)
    )
    return _parsed(table(spark, sf, "orders"), "o_orderkey", value, parsers.parse_urn_uuid, "uuid")


PARSE_URNS = f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (0, 2) THEN {sql.uuid("o_orderkey")} END AS uuid FROM orders
"""


def parse_lengths(spark: SparkSession, sf: str) -> DataFrame:
    """B7"""
    k = F.col("o_orderkey")
    text = k.cast("string")
    value = (
        F.when(k % 7 == 1, F.concat(F.lit("+"), text)).when(k % 7 == 2, F.concat(F.lit(" "), text))
        .when(k % 7 == 3, F.concat(F.lit("-"), text)).when(k % 7 == 4, F.concat(text, F.lit(".0")))
        .when(k % 7 == 5, F.lpad(text, 15, "0")).when(k % 7 == 6, F.lit("99999999999999999999999")).otherwise(text)
    )
    return _parsed(table(spark, sf, "orders"), "o_orderkey", value, parsers.parse_length, "length")


PARSE_LENGTHS = """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (0, 1, 5) THEN o_orderkey END AS length FROM orders
"""


def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Offsets, fractions, missing zones and impossible days"""
    k = F.col("event_id")
    wall = F.col("wall")
    value = (
        F.when(k % 8 == 0, F.concat(wall, F.lit("Z")))
        .when(k % 8 == 1, F.concat(wall, F.lit("+05:30")))
        .when(k % 8 == 2, F.concat(wall, F.lit(".5-23:59")))
        .when(k % 8 == 3, F.concat(F.lower(wall), F.lit(".000250999z")))
        .when(k % 8 == 4, wall)
        .when(k % 8 == 5, F.concat(wall, F.lit("+24:00")))
        .when(k % 8 == 6, F.lit("2023-02-29T00:00:00Z"))
        .otherwise(F.concat(F.left(wall, F.lit(17)), F.lit("60Z")))
    )
    # Wall-clock text of the event time, whatever zone the session is in.
    seconds = F.left(parsers.render_rfc3339(F.col("ts").cast("timestamp")), F.lit(19))
    events = table(spark, sf, "events").withColumn("wall", seconds)
    dates = _parsed(events, "event_id", value, parsers.parse_rfc3339, "ts")
    return dates.select("event_id", parsers.render_rfc3339(F.col("ts")).alias("date"))


PARSE_DATES = """
WITH e AS (SELECT event_id, event_id % 8 AS r, date_trunc('second', ts) AS s FROM events)
SELECT event_id, CASE r
    WHEN 0 THEN strftime(s, '%Y-%m-%dT%H:%M:%SZ')
    WHEN 1 THEN strftime(s - INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%SZ')
    WHEN 2 THEN strftime(s + INTERVAL 1439 MINUTE, '%Y-%m-%dT%H:%M:%S.500Z')
    WHEN 3 THEN strftime(s, '%Y-%m-%dT%H:%M:%S.000250Z')
    WHEN 7 THEN strftime(date_trunc('minute', s) + INTERVAL 1 MINUTE, '%Y-%m-%dT%H:%M:%SZ')
    END AS date
FROM e
"""


def parse_ips(spark: SparkSession, sf: str) -> DataFrame:
    """B5"""
    k = F.col("o_orderkey")
    a, b = k % 256, (k / 256).cast("bigint") % 256
    fmt = F.format_string
    value = (
        F.when(k % 10 == 0, fmt("10.%d.%d.1", b, a))
        .when(k % 10 == 1, fmt("010.%d.%d.1", b, a))
        .when(k % 10 == 2, fmt("10.%d.%d.256", b, a))
        .when(k % 10 == 3, fmt("2001:0DB8:0:0:%X:0:0:1", a + 1))
        .when(k % 10 == 4, fmt("0:0:0:0:0:FFFF:10.%d.%d.1", b, a))
        .when(k % 10 == 5, fmt("%x:%x::1::", a, b))
        .when(k % 10 == 6, fmt("1:2:3:4:5:6:7:%04x", a))
        .when(k % 10 == 7, fmt("::%x:0:0:0", a + 1))
        .when(k % 10 == 8, fmt("fe80::%x%%eth0", a))
        .otherwise(fmt("1:0:%x:0:0:0:5:6", b + 1))
    )
    return _parsed(table(spark, sf, "orders"), "o_orderkey", value, parsers.parse_ip, "ip")


PARSE_IPS = """
WITH k AS (SELECT o_orderkey, o_orderkey % 10 AS r, o_orderkey % 256 AS a, (o_orderkey // 256) % 256 AS b FROM orders)
SELECT o_orderkey, CASE r
    WHEN 0 THEN printf('10.%d.%d.1', b, a)
    WHEN 3 THEN printf('2001:db8::%x:0:0:1', a + 1)
    WHEN 4 THEN printf('::ffff:10.%d.%d.1', b, a)
    WHEN 6 THEN printf('1:2:3:4:5:6:7:%x', a)
    WHEN 7 THEN printf('::%x:0:0:0', a + 1)
    WHEN 9 THEN printf('1:0:%x::5:6', b + 1)
    END AS ip
FROM k
"""


def normalise_urls(spark: SparkSession, sf: str) -> DataFrame:
    """B4"""
    p = F.col("page_id")
    fmt = F.format_string
    value = (
        F.when(p % 9 == 1, fmt("HTTPS://User@Example.COM:443/%d", p))
        .when(p % 9 == 2, fmt("http://example.com:8080/a/./b/%%2e%%2E/%d", p))
        .when(p % 9 == 3, fmt("http://bücher.example/ä b?q=é'%d", p))
        .when(p % 9 == 4, fmt("//example.com/%d", p))
        .when(p % 9 == 5, fmt("http:\\\\example.com\\x\\%d", p))
        .when(p % 9 == 6, fmt("mailto:a%d@example.com", p))
        .when(p % 9 == 7, fmt("http://0x7f.%d/", p % 256))
        .when(p % 9 == 8, fmt("http://exa mple.com/%d", p))
        .otherwise(F.col("url"))
    )
    return _parsed(table(spark, sf, "pages"), "page_id", value, parsers.normalise_url, "url")


NORMALISE_URLS = """
SELECT page_id, CASE page_id % 9
    WHEN 0 THEN url
    WHEN 1 THEN printf('https://User@example.com/%d', page_id)
    WHEN 2 THEN printf('http://example.com:8080/a/%d', page_id)
    WHEN 3 THEN printf('http://xn--bcher-kva.example/%%C3%%A4%%20b?q=%%C3%%A9%%27%d', page_id)
    WHEN 5 THEN printf('http://example.com/x/%d', page_id)
    WHEN 6 THEN printf('mailto:a%d@example.com', page_id)
    WHEN 7 THEN printf('http://127.0.0.%d/', page_id % 256)
    END AS url
FROM pages
"""


def language_lists(spark: SparkSession, sf: str) -> DataFrame:
    """B8"""
    d = F.col("doc_id")
    value = (
        F.when(d % 4 == 0, F.col("lang")).when(d % 4 == 1, F.concat(F.lit(" "), "lang", F.lit(" ,\teng,")))
        .when(d % 4 == 2, F.lit(""))
    )
    langs = parsers.language_list(value)
    return table(spark, sf, "documents").select("doc_id", F.size(langs).alias("n"), F.array_join(langs, "|").alias("languages"))


LANGUAGE_LISTS = """
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 0 END AS n,
    CASE doc_id % 4 WHEN 0 THEN lang WHEN 1 THEN lang || '|eng|' ELSE '' END AS languages
FROM documents
"""


def header_maps(spark: SparkSession, sf: str) -> DataFrame:
    """B1: repeats, stray blanks, colons inside values, case"""
    k = F.col("c_custkey").cast("string")
    block = F.concat(
        F.lit("Name:  "), "c_name", F.lit(" \r\nkey:"), k, F.lit("\r\nKey: a:b:"), k, F.lit("\nkey :\t"), "c_mktsegment", F.lit("\r\n")
    )
    m = headers.header_map(block)
    return table(spark, sf, "customer").select(
        "c_custkey", m["Name"].alias("name"), m["key"].alias("lower_key"), m["Key"].alias("upper_key"),
        m["Version"].alias("version"), F.size(m).alias("n"),
    )


HEADER_MAPS = """
SELECT c_custkey, c_name AS name, c_mktsegment AS lower_key, 'a:b:' || c_custkey AS upper_key, 'WARC/1.0' AS version, 4 AS n
FROM customer
"""


def keyword_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Texts over the limit have no keyword copy"""
    return table(spark, sf, "documents").select("doc_id", parsers.keyword_field(F.col("text")).alias("keyword"))


KEYWORD_FIELDS = "SELECT doc_id, CASE WHEN length(text) <= 256 THEN text END AS keyword FROM documents"


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    pick = lambda names, i: F.element_at(F.array(*[F.lit(n) for n in names]), (i + 1).cast("int"))
    names = [*keys.COLLECTIONS.values(), *keys.ALIASES.values(), "cc-text2024"]
    return table(spark, sf, "customer").select(
        "c_custkey", pick(["raw", "cc-wet", "cc-warc", "cc-text"], k % 4).alias("mapping"), pick(names, k % 9).alias("collection")
    )


def admissible(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer asks for a mapping and a collection, in either spelling"""
    checked = maps.check_admissible(_requests(spark, sf))
    return checked.withColumn("code", keys.collection_code(F.col("collection"))).withColumn(
        "name", keys.collection_name(F.col("code"))
    )


_NAMES = ", ".join(
    [f"({i}, '{name}', {i % 4 + 1}, '{list(keys.COLLECTIONS.values())[i % 4]}')" for i, name in enumerate([*keys.COLLECTIONS.values(), *keys.ALIASES.values()])]
    + ["(8, 'cc-text2024', NULL, NULL)"]
)
ADMISSIBLE = f"""
SELECT c_custkey, m.mapping, c.collection, code, name,
    CASE WHEN code IS NULL THEN 'unknown collection' WHEN m.mapping = 'cc-text' THEN 'unknown mapping'
        WHEN m.mapping = 'cc-wet' AND code < 3 OR m.mapping = 'cc-warc' AND code > 2
        THEN 'collection is outside the mapping' END AS error
FROM customer
JOIN (VALUES (0, 'raw'), (1, 'cc-wet'), (2, 'cc-warc'), (3, 'cc-text')) m(i, mapping) ON m.i = c_custkey % 4
JOIN (VALUES {_NAMES}) c(i, collection, code, name) ON c.i = c_custkey % 9
"""

QUERIES = {
    "parse_urns": (parse_urns, PARSE_URNS),
    "parse_lengths": (parse_lengths, PARSE_LENGTHS),
    "parse_dates": (parse_dates, PARSE_DATES),
    "parse_ips": (parse_ips, PARSE_IPS),
    "normalise_urls": (normalise_urls, NORMALISE_URLS),
    "language_lists": (language_lists, LANGUAGE_LISTS),
    "header_maps": (header_maps, HEADER_MAPS),
    "keyword_fields": (keyword_fields, KEYWORD_FIELDS),
    "admissible": (admissible, ADMISSIBLE),
}
