"""Mappings: which collections they take, how a record becomes a document, which fields it has."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from webcorpus.functions.headers import decode_content, missing_headers
from webcorpus.functions.keys import collection_code
from webcorpus.functions.parsers import (
    keyword_field,
    language_list,
    normalise_url,
    parse_ip,
    parse_length,
    parse_rfc3339,
    parse_urn_uuid,
    render_rfc3339,
)

# The headers each record kind must and may carry, and the document field of each.
WET_REQUIRED = [
    "Content-Length", "Content-Type", "Version", "WARC-Block-Digest", "WARC-Date",
    "WARC-Record-ID", "WARC-Refers-To", "WARC-Target-URI", "WARC-Type",
]
WARC_REQUIRED = ["Content-Length", "Content-Type", "Version", "WARC-Date", "WARC-Record-ID", "WARC-Type"]
INFO_REQUIRED = [
    "Content-Length", "Content-Type", "Version", "WARC-Date", "WARC-Filename", "WARC-Record-ID",
    "WARC-Type",
]
KEYWORD_LIMIT = 256

# Columns a mapping carries along when the input has them.
KEYS = ["object_key", "object_index", "record_idx", "resume_offset", "resume_idx"]


def _field(name: str, kind: str, of: DataType | None = None) -> StructField:
    """A document field with its index kind; ``text+keyword`` has a bounded keyword copy."""
    meta = {"kind": kind.split("+")[0]}
    if kind == "text+keyword":
        meta["ignore_above"] = KEYWORD_LIMIT
    types = {"long": LongType(), "date": TimestampType()}
    return StructField(name, of or types.get(kind, StringType()), True, meta)


INFO_SCHEMA = StructType(
    [
        _field("content", "text"),
        _field("content_length", "long"),
        _field("content_type", "keyword"),
        _field("version", "keyword"),
        _field("date", "date"),
        _field("filename", "text+keyword"),
        _field("record_id", "keyword"),
        _field("warc_type", "keyword"),
    ]
)

WET_SCHEMA = StructType(
    [
        _field("content", "text"),
        _field("content_length", "long"),
        _field("content_type", "keyword"),
        _field("version", "keyword"),
        _field("block_digest", "keyword"),
        _field("date", "date"),
        _field("identified_content_language", "keyword", ArrayType(StringType())),
        _field("record_id", "keyword"),
        _field("refers_to", "keyword"),
        _field("target_uri", "text+keyword"),
        _field("warc_type", "keyword"),
        _field("warc_info", "object", INFO_SCHEMA),
    ]
)

WARC_SCHEMA = StructType(
    [
        _field("content", "text"),
        _field("content_length", "long"),
        _field("content_type", "keyword"),
        _field("version", "keyword"),
        _field("date", "date"),
        _field("record_id", "keyword"),
        _field("warc_type", "keyword"),
        _field("block_digest", "keyword"),
        _field("cipher_suite", "keyword"),
        _field("concurrent_to", "keyword"),
        _field("identified_payload_type", "keyword"),
        _field("ip_address", "ip"),
        _field("payload_digest", "keyword"),
        _field("protocol", "keyword"),
        _field("target_uri", "text+keyword"),
        _field("truncated", "keyword"),
        _field("warcinfo_id", "keyword"),
        _field("warc_info", "object", INFO_SCHEMA),
    ]
)

# Raw documents have no declared fields: the whole pair is one JSON text.
RAW_SCHEMA = StructType()


@dataclass(frozen=True)
class _Parsed:
    """One parsed header: the reject reason it can give and how to parse it."""

    field: str
    header: str
    parse: Callable[[Column], Column]
    source: str = "headers"


# In the order in which a bad value is reported.
_INFO_PARSED = [
    _Parsed("info_content_length", "Content-Length", parse_length, "info_headers"),
    _Parsed("info_date", "WARC-Date", parse_rfc3339, "info_headers"),
    _Parsed("info_record_id", "WARC-Record-ID", parse_urn_uuid, "info_headers"),
]
_WARC_PARSED = [
    _Parsed("target_uri", "WARC-Target-URI", normalise_url),
    _Parsed("ip_address", "WARC-IP-Address", parse_ip),
    _Parsed("content_length", "Content-Length", parse_length),
    _Parsed("date", "WARC-Date", parse_rfc3339),
    _Parsed("record_id", "WARC-Record-ID", parse_urn_uuid),
    _Parsed("concurrent_to", "WARC-Concurrent-To", parse_urn_uuid),
    _Parsed("warcinfo_id", "WARC-Warcinfo-ID", parse_urn_uuid),
    *_INFO_PARSED,
]
_WET_PARSED = [
    _Parsed("target_uri", "WARC-Target-URI", normalise_url),
    _Parsed("content_length", "Content-Length", parse_length),
    _Parsed("date", "WARC-Date", parse_rfc3339),
    _Parsed("record_id", "WARC-Record-ID", parse_urn_uuid),
    _Parsed("refers_to", "WARC-Refers-To", parse_urn_uuid),
    *_INFO_PARSED,
]

# Fields taken over as they are.
_WARC_PLAIN = {
    "content_type": "Content-Type",
    "version": "Version",
    "warc_type": "WARC-Type",
    "block_digest": "WARC-Block-Digest",
    "cipher_suite": "WARC-Cipher-Suite",
    "identified_payload_type": "WARC-Identified-Payload-Type",
    "payload_digest": "WARC-Payload-Digest",
    "protocol": "WARC-Protocol",
    "truncated": "WARC-Truncated",
}
_WET_PLAIN = {
    "content_type": "Content-Type",
    "version": "Version",
    "block_digest": "WARC-Block-Digest",
    "warc_type": "WARC-Type",
}
_INFO_PLAIN = {
    "content_type": "Content-Type",
    "version": "Version",
    "filename": "WARC-Filename",
    "warc_type": "WARC-Type",
}


def _missing_reason(of: str, label: str, present: list[Column], required: list[str]) -> Column:
    """``missing <label>: a,b``, or NULL when every header is there."""
    # The usual case only tests values at hand; the list is built for bad records.
    complete = reduce(lambda a, b: a & b, [value.isNotNull() for value in present])
    gone = F.array_join(missing_headers(F.col(of), required), ",")
    return F.when(F.col(of).isNull(), F.lit(f"missing {label}")).when(
        ~complete, F.concat(F.lit(f"missing {label}: "), gone)
    )


def _typed(
    pairs: DataFrame,
    required: list[str],
    parsed: list[_Parsed],
    plain: dict[str, str],
    schema: StructType,
    lists: dict[str, str],
    charset: str,
) -> DataFrame:
    """Three projections: look the headers up, parse them, build reason and document."""
    keys = [k for k in KEYS if k in pairs.columns]
    carried = [*keys, "content", "info_content", "parse_error", "headers", "info_headers"]
    wanted = {("headers", h) for h in [*required, *plain.values(), *lists.values()]}
    wanted |= {("info_headers", h) for h in [*INFO_REQUIRED, *_INFO_PLAIN.values()]}
    wanted |= {(p.source, p.header) for p in parsed}
    name = {pair: f"_{pair[0][0]}_{pair[1]}" for pair in wanted}

    def at(header: str, source: str = "headers") -> Column:
        return F.col(f"`{name[source, header]}`")

    found = pairs.select(
        *carried, *[F.try_element_at(F.col(of), F.lit(h)).alias(name[of, h]) for of, h in sorted(wanted)]
    )
    values = found.select(
        "*", *[p.parse(at(p.header, p.source)).alias(f"_{p.field}") for p in parsed]
    )
    bad = [
        F.when(at(p.header, p.source).isNotNull() & F.col(f"_{p.field}").isNull(), F.lit(f"bad {p.field}"))
        for p in parsed
    ]
    reason = F.coalesce(
        F.concat(F.lit("parse: "), F.col("parse_error")),
        _missing_reason("headers", "header", [at(h) for h in required], required),
        _missing_reason("info_headers", "info header", [at(h, "info_headers") for h in INFO_REQUIRED], INFO_REQUIRED),
        *bad,
    )
    columns: dict[str, Column] = {
        "content": decode_content(F.col("content"), charset),
        **{field: at(header) for field, header in plain.items()},
        **{field: language_list(at(header)) for field, header in lists.items()},
        **{p.field: F.col(f"_{p.field}") for p in parsed if p.source == "headers"},
    }
    info: dict[str, Column] = {
        "content": decode_content(F.col("info_content"), charset),
        **{field: at(header, "info_headers") for field, header in _INFO_PLAIN.items()},
        **{p.field.removeprefix("info_"): F.col(f"_{p.field}") for p in _INFO_PARSED},
    }
    columns["warc_info"] = F.struct(*[info[f.name].alias(f.name, metadata=f.metadata) for f in INFO_SCHEMA])
    doc = F.struct(*[columns[f.name].alias(f.name, metadata=f.metadata) for f in schema])
    ok = F.col("reject_reason").isNull()
    return values.withColumn("reject_reason", reason).select(
        *keys, F.when(ok, F.col("_record_id")).alias("doc_id"), F.when(ok, doc).alias("doc"), "reject_reason"
    )


def map_warc(pairs: DataFrame, charset: str = "ISO-8859-1") -> DataFrame:
    """Request, response and metadata records -> typed documents; absent optional headers are
    NULL, malformed ones reject the record."""
    return _typed(pairs, WARC_REQUIRED, _WARC_PARSED, _WARC_PLAIN, WARC_SCHEMA, {}, charset)


def map_wet(pairs: DataFrame, charset: str = "ISO-8859-1") -> DataFrame:
    """Extracted-text records -> typed documents."""
    lists = {"identified_content_language": "WARC-Identified-Content-Language"}
    return _typed(pairs, WET_REQUIRED, _WET_PARSED, _WET_PLAIN, WET_SCHEMA, lists, charset)


def _record_json(headers: str, content: str, charset: str) -> Column:
    """All headers plus the content as one map in key order."""
    body = F.struct(F.lit("Content").alias("key"), decode_content(F.col(content), charset).alias("value"))
    others = F.filter(F.map_entries(headers), lambda e: e["key"] != "Content")
    return F.map_from_entries(F.array_sort(F.concat(others, F.array(body))))


def map_raw(pairs: DataFrame, charset: str = "ISO-8859-1") -> DataFrame:
    """The pair unchanged as JSON; the id is the record id header as it stands."""
    keys = [k for k in KEYS if k in pairs.columns]
    reason = F.coalesce(
        F.concat(F.lit("parse: "), F.col("parse_error")),
        _missing_reason("headers", "header", [F.col("_id")], ["WARC-Record-ID"]),
    )
    doc = F.to_json(
        F.struct(
            _record_json("headers", "content", charset).alias("entry"),
            _record_json("info_headers", "info_content", charset).alias("warc_info"),
        )
    )
    found = pairs.withColumn("_id", F.try_element_at("headers", F.lit("WARC-Record-ID")))
    return found.withColumn("reject_reason", reason).select(
        *keys,
        F.when(F.col("reject_reason").isNull(), F.col("_id")).alias("doc_id"),
        F.when(F.col("reject_reason").isNull(), doc).alias("doc"),
        "reject_reason",
    )


@dataclass(frozen=True)
class Mapping:
    """A mapping, built in or the user's own: ``transform`` turns ``to_pairs`` rows into
    ``(keys, doc_id, doc, reject_reason)`` rows."""

    name: str
    collections: frozenset[str]
    schema: StructType
    transform: Callable[[DataFrame], DataFrame]

    def allows(self, collection: str) -> bool:
        return collection in self.collections


# Mapping names, the collections each takes, and their listing labels.
_WARC_COLLECTIONS = frozenset({"cc-warc2024", "cc-warc2024-shuffled"})
_WET_COLLECTIONS = frozenset({"cc-wet2024", "cc-wet2024-shuffled"})
MAPPINGS = {
    "raw": Mapping("raw", _WARC_COLLECTIONS | _WET_COLLECTIONS, RAW_SCHEMA, map_raw),
    "cc-wet": Mapping("cc-wet", _WET_COLLECTIONS, WET_SCHEMA, map_wet),
    "cc-warc": Mapping("cc-warc", _WARC_COLLECTIONS, WARC_SCHEMA, map_warc),
}
LABELS = {"raw": "Raw", "cc-wet": "CcWet", "cc-warc": "CcWarc"}


def mapping(name: str) -> Mapping:
    if name not in MAPPINGS:
        raise ValueError(f"unknown mapping: {name}")
    return MAPPINGS[name]


def mapping_schema(name: str) -> StructType:
    return mapping(name).schema


def field_rows(spark: SparkSession, name: str) -> DataFrame:
    """The field declaration as rows ``(field, kind, ignore_above)``."""
    rows = []

    def walk(schema: StructType, prefix: str) -> None:
        for f in schema:
            if isinstance(f.dataType, StructType):
                walk(f.dataType, f"{prefix}{f.name}.")
            else:
                rows.append((prefix + f.name, f.metadata["kind"], f.metadata.get("ignore_above")))

    walk(mapping(name).schema, "")
    return spark.createDataFrame(rows, "field STRING, kind STRING, ignore_above INT")


def conform(mapped: DataFrame, schema: StructType) -> DataFrame:
    """Check and cast the document column against a declaration; its metadata comes along."""
    if not schema.fields or mapped.schema["doc"].dataType == schema:
        return mapped
    fields = [StructField(f.name, schema if f.name == "doc" else f.dataType, True) for f in mapped.schema]
    # ``to`` checks names, types and order but keeps no metadata inside structs; the cast does.
    return mapped.to(StructType(fields)).withColumn("doc", F.col("doc").cast(schema))


def admissibility(spark: SparkSession) -> DataFrame:
    rows = [(m.name, c) for m in MAPPINGS.values() for c in sorted(m.collections)]
    return spark.createDataFrame(rows, "mapping STRING, collection STRING")


def check_admissible(requests: DataFrame) -> DataFrame:
    """``(mapping, collection)`` rows, either collection spelling -> the rows with ``error``."""
    code = collection_code(F.col("collection"))
    by_code = {m.name: [c for c in m.collections] for m in MAPPINGS.values()}
    allowed = F.lit(False)
    for name, names in by_code.items():
        codes = F.array(*[collection_code(F.lit(n)) for n in sorted(names)])
        allowed = allowed | ((F.col("mapping") == name) & F.array_contains(codes, code))
    error = (
        F.when(code.isNull(), F.lit("unknown collection"))
        .when(~F.col("mapping").isin(list(MAPPINGS)), F.lit("unknown mapping"))
        .when(~allowed, F.lit("collection is outside the mapping"))
    )
    return requests.withColumn("error", error)


def split_rejects(mapped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted documents, and the rejects with their reason."""
    keys = [k for k in KEYS if k in mapped.columns]
    accepted = mapped.filter("reject_reason IS NULL").drop("reject_reason")
    return accepted, mapped.filter("reject_reason IS NOT NULL").select(*keys, "reject_reason")


def doc_json(df: DataFrame, column: str = "doc") -> Column:
    """The document as JSON: keys in alphabetical order, NULLs kept, times as RFC 3339."""

    def render(value: Column, of: DataType) -> Column:
        if isinstance(of, StructType):
            inner = sorted(of.fields, key=lambda f: f.name)
            built = F.struct(*[render(value[f.name], f.dataType).alias(f.name) for f in inner])
            return F.when(value.isNotNull(), built)
        return render_rfc3339(value) if isinstance(of, TimestampType) else value

    of = df.schema[column].dataType
    if isinstance(of, StringType):  # already JSON
        return F.col(column)
    return F.to_json(render(F.col(column), of), {"ignoreNullFields": "false"})


def with_source(df: DataFrame, enabled: bool = False) -> DataFrame:
    """Keep the document's JSON in ``_source``, or leave it out."""
    return df.withColumn("_source", doc_json(df)) if enabled else df.drop("_source")


def with_keyword_fields(df: DataFrame) -> DataFrame:
    """Add the bounded keyword copies that the declarations name."""
    return df.withColumn("target_uri_keyword", keyword_field(F.col("doc.target_uri"), KEYWORD_LIMIT)).withColumn(
        "filename_keyword", keyword_field(F.col("doc.warc_info.filename"), KEYWORD_LIMIT)
    )
