"""Object keys, collection names, index ids and the position hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.functions.text import let

# Collection codes and names.
COLLECTIONS = {
    1: "cc-warc2024",
    2: "cc-warc2024-shuffled",
    3: "cc-wet2024",
    4: "cc-wet2024-shuffled",
}

# The second accepted spelling of each name.
ALIASES = {
    1: "cc-warc-2024",
    2: "cc-warc-2024-shuffled",
    3: "cc-wet-2024",
    4: "cc-wet-2024-shuffled",
}

# The section tag that opens every object key, and the hash multipliers.
SECTION_COLLECTION = 1
MIX_MULTIPLIER_1 = 0x9E6C63D0676A9A99
MIX_MULTIPLIER_2 = 0x9E6D62D06F6A9A9B


def collections(spark: SparkSession) -> DataFrame:
    rows = [(c, n, "warc" if "warc" in n else "wet", "shuffled" in n) for c, n in COLLECTIONS.items()]
    return spark.createDataFrame(rows, "code INT, name STRING, kind STRING, shuffled BOOLEAN")


def _lookup(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def collection_code(name: Column) -> Column:
    """Name, in either spelling -> code; NULL when unknown."""
    return F.try_element_at(
        _lookup({n: c for names in (COLLECTIONS, ALIASES) for c, n in names.items()}), name
    )


def collection_name(code: Column) -> Column:
    return F.try_element_at(_lookup(COLLECTIONS), code.cast("int"))


def object_key(code: Column, index: Column) -> Column:
    """Section tag, collection code and big-endian position as 12 lower-case hex digits."""
    return F.lower(
        F.concat(
            F.lit(f"{SECTION_COLLECTION:02x}"),
            F.lpad(F.hex(code.cast("bigint")), 2, "0"),
            F.lpad(F.hex(index.cast("bigint")), 8, "0"),
        )
    )


def decode_object_key(key: Column) -> Column:
    """Key text -> STRUCT(collection, code, object_index, error); error is NULL for a valid key."""

    def number(start: int, length: int) -> Column:
        return F.conv(F.substring(key, start, length), 16, 10).cast("bigint")

    hexed = key.rlike(r"^([0-9a-fA-F]{2})*\z")
    error = (
        F.when(~hexed, F.lit("not_hex"))
        .when(F.length(key) != 12, F.lit("invalid_length"))
        .when(number(1, 2) != SECTION_COLLECTION, F.lit("invalid_section"))
        .when(collection_name(number(3, 2)).isNull(), F.lit("unknown_collection"))
    )
    ok = error.isNull()
    return F.struct(
        F.when(ok, collection_name(number(3, 2))).alias("collection"),
        F.when(ok, number(3, 2).cast("int")).alias("code"),
        F.when(ok, number(5, 8)).alias("object_index"),
        error.alias("error"),
    )


def valid_index_uuid(col: Column) -> Column:
    return F.coalesce(F.octet_length(col) == 22, F.lit(False))


def _signed(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >= 1 << 63 else value).cast("bigint")


def _multiply(value: Column, constant: int) -> Column:
    """Product modulo 2^64 in 16-bit limbs: a plain BIGINT product raises on overflow."""
    c = [(constant >> 16 * i) & 0xFFFF for i in range(4)]

    def limbs(v: Column) -> Column:
        a = [F.shiftrightunsigned(v, 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
        sums = [sum((a[i] * F.lit(c[k - i]) for i in range(1, k + 1)), a[0] * F.lit(c[k])) for k in range(4)]
        return F.array(*sums)

    def carry(s: Column) -> Column:
        total, out = s[0], F.lit(0).cast("bigint")
        for k in range(4):
            out = out.bitwiseOR(F.shiftleft(total.bitwiseAND(F.lit(0xFFFF)), 16 * k))
            if k < 3:
                total = s[k + 1] + F.shiftright(total, 16)
        return out

    return let(let(value, limbs), carry)


def _fold(v: Column, a: Column, b: Column) -> Column:
    return v.bitwiseXOR(a.bitwiseXOR(b))


def mix64_signed(seed: int, index: Column) -> Column:
    """The position hash as the BIGINT with the same 64 bits."""

    def rotate(v: Column, n: int) -> Column:
        return F.shiftrightunsigned(v, n).bitwiseOR(F.shiftleft(v, 64 - n))

    def shift(v: Column) -> Column:
        return _fold(v, F.shiftrightunsigned(v, 23), F.shiftrightunsigned(v, 51))

    start = index.cast("bigint").bitwiseXOR(_signed(seed))
    step = let(start, lambda v: _fold(v, rotate(v, 25), rotate(v, 47)))
    for multiplier in (MIX_MULTIPLIER_1, MIX_MULTIPLIER_2):
        step = let(_multiply(step, multiplier), shift)
    return step


def mix64(seed: int, index: Column) -> Column:
    """Seeded 64-bit hash of a position, unsigned, as DECIMAL(20,0)."""
    wide = lambda v: v.cast("decimal(20,0)")
    return let(
        mix64_signed(seed, index),
        lambda v: F.when(v < 0, (wide(v) + F.lit(str(1 << 64)).cast("decimal(20,0)")).cast("decimal(20,0)")).otherwise(wide(v)),
    )
