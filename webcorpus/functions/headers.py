"""Record headers and content: header map and byte decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webcorpus.functions.text import let, trim_ws

VERSION = "WARC/1.0"


def header_entries(block: Column) -> Column:
    """Header block -> array of ``(key, value)`` in file order, synthetic version entry first."""
    lines = F.filter(
        F.transform(F.split(block, "\n"), lambda line: F.rtrim(line, F.lit("\r"))),
        lambda line: line != "",
    )
    pairs = F.transform(
        lines,
        lambda line: F.struct(
            trim_ws(F.substring_index(line, ":", 1)).alias("key"),
            trim_ws(line.substr(F.instr(line, F.lit(":")) + 1, F.length(line))).alias("value"),
        ),
    )
    version = F.array(F.struct(F.lit("Version").alias("key"), F.lit(VERSION).alias("value")))
    return F.concat(version, pairs)


def last_wins(entries: Column) -> Column:
    """Drop every entry whose key comes again later."""
    return F.filter(
        entries,
        lambda e, i: ~F.exists(
            F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]
        ),
    )


def header_map(block: Column) -> Column:
    """Header block -> MAP. Split at the first colon, both sides trimmed, the last repeat wins.

    For header blocks kept as text; the archive scan hands over maps already. Repeats are removed
    here, so ``spark.sql.mapKeyDedupPolicy`` does not matter; the quadratic removal runs only for
    blocks that do repeat a header.
    """

    def build(entries: Column) -> Column:
        keys = F.transform(entries, lambda e: e["key"])
        repeated = F.size(F.array_distinct(keys)) < F.size(keys)
        return F.map_from_entries(F.when(repeated, last_wins(entries)).otherwise(entries))

    return let(header_entries(block), build)


def decode_content(content: Column, charset: str = "ISO-8859-1") -> Column:
    """Bytes -> text. The default maps each byte to the code point of the same value."""
    return F.decode(content, charset)


def missing_headers(headers: Column, required: list[str]) -> Column:
    """The required header names that the map lacks, in the order given."""
    return F.array_except(F.array(*[F.lit(name) for name in required]), F.map_keys(headers))
