"""Strict scalar parsers. Each gives NULL for a malformed value and never raises."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from webcorpus.functions.text import let, trim_ws
from webcorpus.functions.whatwg import normalise

_HEX = "[0-9a-fA-F]"
_URN = rf"^<urn:uuid:({_HEX}{{8}}(?:-{_HEX}{{4}}){{3}}-{_HEX}{{12}})>\z"


def parse_urn_uuid(col: Column) -> Column:
    """``<urn:uuid:...>`` -> lower-case hyphenated UUID."""
    return F.when(col.rlike(_URN), F.lower(F.substring(col, 11, 36)))


def parse_length(col: Column) -> Column:
    """Decimal digits, one leading plus allowed -> BIGINT."""
    return F.when(col.rlike(r"^\+?[0-9]+\z"), col.try_cast("bigint"))


_RFC3339 = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?"
    r"([Zz]|[+-]([01][0-9]|2[0-3]):[0-5][0-9])\z"
)


# What nearly all archives hold; needs no arithmetic.
_ZULU_SECONDS = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-5][0-9]Z\z"


def parse_rfc3339(col: Column) -> Column:
    """Date-time with a mandatory offset -> TIMESTAMP (an instant, whatever the session zone).

    A second of 60 is read as the first instant of the next minute; digits past the
    microsecond are cut.
    """
    return F.when(col.rlike(_ZULU_SECONDS), F.try_to_timestamp(col)).when(
        col.rlike(_RFC3339), _parse_general(col)
    )


def _parse_general(col: Column) -> Column:
    zulu = F.upper(F.right(col, F.lit(1))) == "Z"
    offset = F.when(zulu, F.lit("+00:00")).otherwise(F.right(col, F.lit(6)))
    minutes = F.substring(offset, 2, 2).try_cast("int") * 60 + F.substring(offset, 5, 2).try_cast("int")
    minutes = F.when(F.left(offset, F.lit(1)) == "-", -minutes).otherwise(minutes)
    leap = F.substring(col, 18, 2) == "60"
    fraction = F.rpad(F.regexp_extract(col, r"^.{19}\.([0-9]{1,6})", 1), 6, "0")
    local = F.try_to_timestamp(
        F.concat(
            F.substring(col, 1, 10),
            F.lit("T"),
            F.substring(col, 12, 6),
            F.when(leap, F.lit("59")).otherwise(F.substring(col, 18, 2)),
            F.lit("."),
            fraction,
            F.lit("Z"),
        )
    )
    shift = F.when(leap, F.lit(1)).otherwise(F.lit(0)) - minutes * 60
    return F.timestamp_micros(F.unix_micros(local) + shift.cast("bigint") * 1_000_000)


def render_rfc3339(ts: Column) -> Column:
    """TIMESTAMP -> UTC text with ``Z``; a fraction of 0, 3 or 6 digits, as few as are exact."""

    def text(micros: Column) -> Column:
        day = F.floor(micros / F.lit(86_400_000_000)).cast("int")
        rest = F.pmod(micros, F.lit(86_400_000_000))
        seconds = F.floor(rest / 1_000_000).cast("bigint")
        sub = F.pmod(rest, F.lit(1_000_000))

        def two(value: Column) -> Column:
            return F.lpad(value.cast("string"), 2, "0")

        fraction = (
            F.when(sub == 0, F.lit(""))
            .when(sub % 1000 == 0, F.concat(F.lit("."), F.lpad(F.floor(sub / 1000).cast("string"), 3, "0")))
            .otherwise(F.concat(F.lit("."), F.lpad(sub.cast("string"), 6, "0")))
        )
        return F.concat(
            F.date_from_unix_date(day).cast("string"),
            F.lit("T"),
            two(F.floor(seconds / 3600)),
            F.lit(":"),
            two(F.pmod(F.floor(seconds / 60), F.lit(60))),
            F.lit(":"),
            two(F.pmod(seconds, F.lit(60))),
            fraction,
            F.lit("Z"),
        )

    return F.when(ts.isNotNull(), let(F.unix_micros(ts), text))


_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_IPV4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"


def parse_ip(col: Column) -> Column:
    """IPv4 or IPv6 text -> canonical text (RFC 5952 for IPv6)."""
    return F.when(col.rlike(rf"^{_IPV4}\z"), col).when(
        col.rlike(r"^[0-9a-fA-F:.]{2,45}\z") & col.contains(":"), _parse_ipv6(F.lower(col))
    )


def _parse_ipv6(col: Column) -> Column:
    def hex16(hi: Column, lo: Column) -> Column:
        return F.lower(F.hex(hi.cast("bigint") * 256 + lo.cast("bigint")))

    # A trailing dotted IPv4 part stands for the last two groups.
    tail = F.regexp_extract(col, rf":({_IPV4})\z", 1)
    tail_parts = F.split(tail, r"\.")
    hexed = F.when(
        tail != "",
        F.concat(
            F.left(col, F.length(col) - F.length(tail)),
            hex16(tail_parts[0], F.get(tail_parts, F.lit(1))),
            F.lit(":"),
            hex16(F.get(tail_parts, F.lit(2)), F.get(tail_parts, F.lit(3))),
        ),
    ).otherwise(col)

    def groups_of(text: Column) -> Column:
        return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ":"))

    def expand(text: Column) -> Column:
        halves = F.split(text, "::")
        left, right = groups_of(halves[0]), groups_of(F.coalesce(F.get(halves, F.lit(1)), F.lit("")))
        known = F.size(left) + F.size(right)
        compressed = F.size(halves) == 2
        valid = (F.size(halves) <= 2) & F.when(compressed, known <= 7).otherwise(known == 8)
        return F.when(
            valid, F.concat(left, F.array_repeat(F.lit("0"), F.greatest(8 - known, F.lit(0))), right)
        )

    def canonical(groups: Column) -> Column:
        short = F.transform(groups, lambda g: F.regexp_replace(g, "^0+(?=.)", ""))
        return let(F.array_join(short, ":"), compress)

    def compress(joined: Column) -> Column:
        result = joined
        for run in range(2, 9):  # the longest run is tested last, so it wins
            pattern = rf"(?:^|:)0(?::0){{{run - 1}}}(?=:|\z):?"
            result = F.when(joined.rlike(pattern), F.regexp_replace(joined, rf"^(.*?){pattern}", "$1::")).otherwise(result)
        mapped = joined.rlike(r"^(0:){5}ffff:")
        last = F.split(joined, ":")

        def octets(group: Column) -> Column:
            value = F.conv(group, 16, 10).cast("int")
            return F.concat_ws(".", F.shiftright(value, 8), value.bitwiseAND(F.lit(255)))

        dotted = F.concat(F.lit("::ffff:"), octets(F.get(last, F.lit(6))), F.lit("."), octets(F.get(last, F.lit(7))))
        return F.when(mapped, dotted).otherwise(result)

    groups_ok = lambda groups: F.forall(groups, lambda g: g.rlike(r"^[0-9a-f]{1,4}\z"))
    return let(
        let(hexed, expand),
        lambda groups: F.when(groups.isNotNull() & groups_ok(groups), canonical(groups)),
    )


# http(s), lower-case plain host not ending in a number, path and query that need no escaping
# and hold no dot segment: the normal form is the text itself. Everything else takes the
# slower way, so this pattern may be narrow but never too wide.
_PLAIN_HOST = r"^https?://(?!(?:[^/?#]*\.)?xn--)(?:[a-z0-9_-]+\.)*[a-z][a-z0-9-]*"
_PLAIN_REST = (
    r"(?!.*/(?:\.|%2[eE]){1,2}(?:[/?#]|\z))"
    r"/[A-Za-z0-9\-._~!$&'()*+,;=:@%/|\[\]]*"
    r"(?:\?[A-Za-z0-9\-._~!$&()*+,;=:@%/?|\[\]{}^`\\]*)?"
    r"(?:#[A-Za-z0-9\-._~!$&'()*+,;=:@%/?|\[\]{}^\\#]*)?\z"
)


@F.pandas_udf(StringType())
def _normalise_other(urls: pd.Series) -> pd.Series:
    return urls.map(lambda url: None if url is None else normalise(url))


# Keeps filters on parsed values above the projection that parses, so nothing is parsed twice.
_normalise_other = _normalise_other.asNondeterministic()


def normalise_url(col: Column) -> Column:
    """Absolute URL -> normal form by the WHATWG rules, NULL for anything else.

    Only values outside the plain http(s) form reach Python; all others are sent as NULL.
    """
    plain = col.rlike(_PLAIN_HOST + _PLAIN_REST)
    bare = col.rlike(_PLAIN_HOST + r"\z")
    other = _normalise_other(F.when(~plain & ~bare, col))
    return F.when(plain, col).when(bare, F.concat(col, F.lit("/"))).otherwise(other)


def language_list(col: Column) -> Column:
    """Comma list -> trimmed ARRAY; an absent header gives the empty array, not NULL."""
    return F.coalesce(
        F.transform(F.split(col, ",", -1), trim_ws), F.array().cast("array<string>")
    )


def keyword_field(col: Column, limit: int = 256) -> Column:
    """The bounded keyword copy of a text field: NULL when the text is longer than the limit."""
    return F.when(F.length(col) <= limit, col)
