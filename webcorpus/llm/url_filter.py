"""URL filter lists over time: which entries were active when each capture was fetched.

List entries are dated additions and removals. The last one of a day decides, and each change of
state opens a validity interval that lasts to the next change. Captures meet the intervals by an
as-of join on the pattern: every host and parent domain of a host on the days it was fetched, and
every exact address. Hosts are reduced to their distinct (host, day) pairs first, so that a host
with a third of all captures is a few rows per day in the join, and the verdict of a pair goes
back to its captures in one join. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """The lower-case host of an http(s) address, without user, port and a final dot; NULL for others."""
    host = F.regexp_extract(F.lower(url), r"^https?://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.nullif(F.rtrim(host, F.lit(".")), F.lit(""))


def address_of(url: Column) -> Column:
    """Host and path, without scheme, a leading www., query, fragment and final slashes."""
    path = F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1)
    return F.concat(F.regexp_replace(host_of(url), r"^www\.", ""), F.rtrim(path, F.lit("/")))


def domains_of(host: Column) -> Column:
    """The host and its parent domains, longest first."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """(list_name, kind, pattern, verdict, valid_from, valid_to) of entries (list_name, kind,
    pattern, verdict, action, dated): valid from the day of an addition up to, not including, the
    day of the removal or of a change of verdict; valid_to is NULL where it still holds.

    kind is `domain` or `address`, verdict `block` or `allow`, action `add` or `remove`. Of several
    entries for a pattern on one day, a removal yields to an addition and allow to block. Rows with
    a NULL or an unknown kind, verdict or action are left out.
    """
    clean = entries.filter(
        F.col("list_name").isNotNull() & F.col("pattern").isNotNull() & F.col("dated").isNotNull()
        & F.col("kind").isin("domain", "address") & F.col("verdict").isin("block", "allow") & F.col("action").isin("add", "remove")
    )
    state = F.when(F.col("action") == "remove", 0).when(F.col("verdict") == "allow", 1).otherwise(2)
    # One row per pattern and day bounds what a hot pattern brings to the window.
    daily = clean.groupBy("list_name", "kind", F.lower("pattern").alias("pattern"), F.col("dated").cast("date").alias("day")).agg(
        F.max(state).alias("state")
    )
    by = Window.partitionBy("list_name", "kind", "pattern").orderBy("day")
    changes = daily.withColumn("before", F.coalesce(F.lag("state").over(by), F.lit(0))).filter("state <> before")
    closed = changes.withColumn("valid_to", F.lead("day").over(by)).filter("state > 0")
    return closed.select(
        "list_name", "kind", "pattern", F.when(F.col("state") == 1, "allow").otherwise("block").alias("verdict"),
        F.col("day").alias("valid_from"), "valid_to",
    )


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """captures with verdict, list_name and pattern of the entry that decides; columns of these
    names in captures are replaced.

    captures has url and fetched (a date or time, UTC days). An exact address decides before any
    domain, a longer domain before a shorter one, block before allow, then the first list by name.
    Captures without an active entry have verdict `pass` and NULL list and pattern; so do captures
    with NULL or unreadable url or NULL fetched. Repeated captures keep their rows.
    """
    named = ("verdict", "list_name", "pattern")
    captures = captures.select(*[c for c in captures.columns if c not in named])
    valid = intervals(entries)
    holds = (F.col("_day") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("_day") < F.col("valid_to")))
    rank = F.struct(F.col("_length"), (F.col("verdict") == "block").cast("int").alias("_block"))

    def decided(asked: DataFrame, kind: str, keys: list[str]) -> DataFrame:
        met = asked.join(valid.filter(F.col("kind") == kind).drop("kind"), "pattern").filter(holds)
        top = met.withColumn("_rank", rank).groupBy(*keys).agg(
            F.max(F.struct("_rank", "pattern")).alias("_top"),
            F.min_by("list_name", F.struct(-F.col("_length"), F.col("verdict") != "block", "list_name")).alias("list_name"),
        )
        return top.select(
            *keys, F.struct(
                F.when(F.col("_top._rank._block") == 1, "block").otherwise("allow").alias("verdict"),
                F.col("list_name"), F.col("_top.pattern").alias("pattern"),
            ).alias(f"_by_{kind}"),
        )

    placed = captures.withColumn("_day", F.col("fetched").cast("date")).withColumn("_host", host_of(F.col("url"))).withColumn(
        "_address", F.lower(address_of(F.col("url")))
    )
    days = placed.filter("_host IS NOT NULL AND _day IS NOT NULL")
    hosts = days.select("_host", "_day").distinct().withColumn("pattern", F.explode(domains_of(F.col("_host"))))
    by_domain = decided(hosts.withColumn("_length", F.length("pattern")), "domain", ["_host", "_day"])
    addresses = days.select("_address", "_day").distinct().withColumn("pattern", F.col("_address"))
    by_address = decided(addresses.withColumn("_length", F.lit(0)), "address", ["_address", "_day"])
    out = placed.join(by_domain, ["_host", "_day"], "left").join(by_address, ["_address", "_day"], "left")
    out = out.withColumn("_found", F.coalesce("_by_address", "_by_domain"))
    return out.select(
        *captures.columns, F.coalesce("_found.verdict", F.lit("pass")).alias("verdict"),
        F.col("_found.list_name").alias("list_name"), F.col("_found.pattern").alias("pattern"),
    )
