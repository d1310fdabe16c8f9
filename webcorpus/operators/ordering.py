"""Dense numbering, running totals, seeded order and selection by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webcorpus.functions.keys import mix64, mix64_signed
from webcorpus.session import checkpoint_dir

# Fixed value: the seed of the shuffled collections.
SHUFFLE_SEED = 0x420000FEFECA

# Object index (32 bits) and record ordinal share one BIGINT, so positions compare, aggregate
# and join as plain longs.
RECORD_BITS = 31


def position(object_index: Column, record_idx: Column) -> Column:
    return F.shiftleft(object_index.cast("bigint"), RECORD_BITS).bitwiseOR(record_idx.cast("bigint"))


def object_index_of(pos: Column) -> Column:
    return F.shiftright(pos, RECORD_BITS)


def record_idx_of(pos: Column) -> Column:
    return pos.bitwiseAND(F.lit((1 << RECORD_BITS) - 1))


def running_total(df: DataFrame, order: str, value: str, out: str, block: int = 4096) -> DataFrame:
    """Exclusive running sum of ``value`` by the distinct, non-negative BIGINT ``order``.

    Two levels: within blocks of the order column, then over the blocks, so no single task sees
    more than one block or one row per block.
    """
    blocks = df.withColumn("_block", F.floor(F.col(order) / block))
    totals = blocks.groupBy("_block").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = blocks.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        local.join(base, "_block")
        .withColumn(out, (F.col("_base") + F.col("_local")).cast("bigint"))
        .drop("_block", "_base", "_local")
    )


def dense_index(df: DataFrame, order: list, out: str = "position") -> DataFrame:
    """Number all rows 0.. in the given order, without gathering them in one task.

    Range-partitioned sort, row numbers inside each partition, plus the row counts of the
    earlier partitions. The sorted rows are checkpointed because both uses must see the same
    partition bounds.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    low_bits = F.lit((1 << 33) - 1)
    placed = (
        df.repartitionByRange(*cols)
        .sortWithinPartitions(*cols)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33))
        .withColumn("_row", F.col("_id").bitwiseAND(low_bits))
        .drop("_id")
        .checkpoint()
    )
    counts = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sort.
    base = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    return (
        placed.join(F.broadcast(base), "_part")
        .withColumn(out, F.col("_base") + F.col("_row"))
        .drop("_part", "_row", "_base")
    )


def swap_order(spark: SparkSession, n: int, seed: int = SHUFFLE_SEED) -> DataFrame:
    """The seeded swap shuffle of n rows as ``(position, source)``: row ``source`` of the listing
    is visited at ``position``.

    Step i of the shuffle swaps positions i and ``t(i) = i + hash(i) mod (n - i)``. Position i is
    final after its own step, so the result follows from who wrote a position last:
    ``root(p)``, the row found at p when step p begins, is ``root(q)`` for the latest q < p with
    t(q) = p, or p itself. Position i then receives ``root(q)`` for the latest q < i with
    t(q) = t(i), or else row t(i). The roots come from pointer doubling, so the loop runs
    log2(longest chain) times, about five for a million rows.
    """
    checkpoint_dir(spark)
    left = F.lit(n) - F.col("i")
    steps = spark.range(n).select(F.col("id").alias("i"))
    steps = steps.withColumn("t", F.col("i") + (mix64(seed, F.col("i")) % left).cast("bigint"))
    latest = Window.partitionBy("t").orderBy("i")
    steps = steps.withColumn("q", F.lag("i").over(latest)).checkpoint()

    links = (
        steps.filter("t <> i").groupBy(F.col("t").alias("p")).agg(F.max("i").alias("to")).checkpoint()
    )
    while True:
        onward = links.select(F.col("p").alias("to"), F.col("to").alias("next"))
        links = (
            links.join(onward, "to", "left")
            .select("p", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved"))
            .checkpoint()
        )
        if links.filter("moved").isEmpty():
            break
        links = links.drop("moved")
    roots = links.select(F.col("p").alias("from"), F.col("to").alias("root"))

    start = F.when(F.col("t") == F.col("i"), F.col("i")).otherwise(F.col("q"))
    return (
        steps.withColumn("from", start)
        .join(roots, "from", "left")
        .select(
            F.col("i").alias("position"),
            F.coalesce("root", "from", "t").alias("source"),
        )
    )


def seeded_order(df: DataFrame, seed: int = SHUFFLE_SEED, method: str = "swap", index: str = "position") -> DataFrame:
    """Renumber a densely numbered table in seeded order; the old number is kept as ``listed``.

    ``swap`` is the order of the shuffled collections. ``mix64`` sorts by the position hash and
    ``md5`` by an MD5 of seed and position; ties fall back on the position.
    """
    listed = df.withColumnRenamed(index, "listed")
    if method == "swap":
        moved = swap_order(df.sparkSession, df.count(), seed)
        return listed.join(moved.withColumnRenamed("source", "listed"), "listed").withColumnRenamed("position", index)
    key = {
        # Adding the sign bit turns the signed order of the long into the unsigned order.
        "mix64": lambda c: mix64_signed(seed, c).bitwiseXOR(F.lit(-(1 << 63))),
        "md5": lambda c: F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")).cast("binary")),
    }[method]
    keyed = listed.withColumn("_key", key(F.col("listed")))
    return dense_index(keyed, ["_key", "listed"], index).drop("_key")


def nth_smallest(df: DataFrame, column: str, n: int, fan_out: int = 1 << 14) -> int | None:
    """The n-th smallest (from 1) of a BIGINT column with possible repeats; None beyond the end.

    Counting passes: each one splits the interval that holds the answer into ``fan_out`` parts
    and brings back at most that many counts. Nothing is sorted and nothing moves but counts.
    """
    low, high, rows = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if n < 1 or rows < n:
        return None
    while low < high:
        width = -(-(high - low + 1) // fan_out)
        part = F.expr(f"(`{column}` - ({low}L)) div {width}L")
        counts = dict(
            df.filter(F.col(column).between(low, high)).groupBy(part.alias("part")).count().collect()
        )
        for p in sorted(counts):
            if n <= counts[p]:
                low, high = low + p * width, min(high, low + (p + 1) * width - 1)
                break
            n -= counts[p]
    return low
