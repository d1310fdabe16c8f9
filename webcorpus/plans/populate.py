"""Populate: pending objects -> records -> documents -> created once by id -> progress."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.operators.mappings import conform, doc_json
from webcorpus.operators.ordering import RECORD_BITS
from webcorpus.operators.progress import COUNTS, object_progress
from webcorpus.operators.selection import first_by_id, limit_new, outcomes, pending_objects, with_position
from webcorpus.plans import files
from webcorpus.plans.buckets import absent
from webcorpus.plans.store import RUN_PROGRESS, Index
from webcorpus.sources.archive import SPLIT_SCHEMA, read_archives, read_objects, split_payloads, to_pairs
from webcorpus.sources.ranges import Range, read_ranges, readable

# Objects per run: what the driver lists at once, and what a failure can cost.
WINDOW = 4096
FIRST_WINDOW = 8

# Documents a reader may have to leave out, over all runs: so many longs can be broadcast.
LOST_ROWS = 500_000


@dataclass
class Outcome:
    """What a call did."""

    runs: int = 0
    objects: int = 0
    created: int = 0
    already_exists: int = 0
    failed: int = 0
    rejected: int = 0

    def add(self, counts: dict) -> None:
        self.runs += 1
        for name, count in counts.items():
            setattr(self, name, getattr(self, name) + count)


@dataclass(frozen=True)
class Pending:
    """One object of a window: its place in the visit order, its full path, and where it stopped."""

    visit: int
    object_key: str
    object_index: int
    path: str
    next_record_idx: int
    error: str | None
    resume_offset: int
    resume_idx: int


def pending_states(index: Index, objects: DataFrame, retry_failed: bool = False) -> DataFrame:
    """The objects still to be read, with where each stopped. An object that could not be read to its
    end is settled like a finished one, unless asked to be tried again."""
    state = index.states()
    settled = F.col("done") if retry_failed else F.col("done") | F.col("error").isNotNull()
    open_ = pending_objects(objects, state.select("object_key", settled.alias("done")))
    start = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("next_record_idx", "resume_offset", "resume_idx")]
    told = state.select("object_key", "next_record_idx", "error", "resume_offset", "resume_idx")
    return open_.join(told, "object_key", "left").select("object_key", "object_index", "path", "error", *start)


def window_of(index: Index, rows: list, base: str = "") -> list[Pending]:
    """Collected object rows, at most one window of them, in visit order, with full paths. Objects
    that share an index are told apart by their place."""
    rows = sorted(rows, key=lambda r: (r.object_index, r.object_key))
    if len({r.object_key for r in rows}) < len(rows):
        raise ValueError("an object key is listed more than once")
    paths = files.qualify(index.spark, base, [r.path for r in rows])
    return [
        Pending(i, r.object_key, r.object_index, path, r.next_record_idx, r.error, r.resume_offset, r.resume_idx)
        for i, (r, path) in enumerate(zip(rows, paths))
    ]


def _present(index: Index, window: list[Pending]) -> list[Pending]:
    with ThreadPoolExecutor(16) as pool:
        found = pool.map(partial(files.exists, index.spark), [p.path for p in window])
        return [p for p, there in zip(window, found) if there]


def scan_records(index: Index, window: list[Pending], framing: str, whole: bool) -> DataFrame:
    """The window's record rows, labelled with the visit.

    Objects that a Python worker can open are read from where they stopped, one task each; what is
    missing or damaged comes as an error row. On other file systems Spark's readers read them, from
    their start.
    """
    spark = index.spark
    if all(readable(p.path) for p in window):
        parts = [Range(str(p.visit), p.path, p.resume_offset, None, p.resume_idx) for p in window]
        return read_ranges(spark, parts, framing).withColumn("visit", F.col("path").cast("bigint")).drop("path")
    there = _present(index, window)
    gone = [p for p in window if p not in there]
    lost = spark.createDataFrame([(p.visit, 0, "missing_object") for p in gone], "visit BIGINT, record_idx BIGINT, parse_error STRING")
    if there:
        paths = [p.path for p in there]
        records = split_payloads(read_objects(spark, paths), framing) if whole else read_archives(spark, paths, framing)
        named = spark.createDataFrame([(p.path, p.visit) for p in there], "path STRING, visit BIGINT")
        records = records.join(F.broadcast(named), "path").drop("path")  # at most a window
    else:
        records = spark.createDataFrame([], SPLIT_SCHEMA + ", visit BIGINT").drop("path")
    return records.unionByName(lost, allowMissingColumns=True)


def scan_objects(index: Index, window: list[Pending], framing: str = "standard", whole: bool = False) -> DataFrame:
    """The window's objects -> mapped documents with keys, resumed where they stopped."""
    spark = index.spark
    records = scan_records(index, window, framing, whole)
    # One row per object, at most a window: content never moves for this join.
    state = spark.createDataFrame(
        [(p.visit, p.object_key, p.next_record_idx) for p in window],
        "visit BIGINT, object_key STRING, next_record_idx BIGINT",
    )
    records = records.join(F.broadcast(state), "visit").withColumnRenamed("visit", "object_index").filter(
        (F.col("record_idx") > F.col("next_record_idx")) | F.col("parse_error").isNotNull()
    )
    mapped = index.mapping.transform(to_pairs(records.drop("next_record_idx")))
    placed = with_position(conform(mapped, index.mapping.schema))  # by visit, which is never repeated
    listed = spark.createDataFrame([(p.object_key, p.object_index) for p in window], "object_key STRING, object_index BIGINT")
    for column in ("resume_offset", "resume_idx"):  # a reader or a mapping may not carry them
        if column not in placed.columns:
            placed = placed.withColumn(column, F.lit(0).cast("bigint"))
    return placed.drop("object_index").join(F.broadcast(listed), "object_key")


def unreadable(index: Index, window: list[Pending]) -> set[str]:
    """Which of these objects, all without any document, cannot be read at all. Only Spark's readers
    leave that open."""
    if not window or all(readable(p.path) for p in window):
        return set()
    rows = split_payloads(read_objects(index.spark, [p.path for p in window]), with_content=False)
    fine = rows.groupBy("path").agg(F.count("parse_error").alias("errors")).filter("errors = 0")
    readable_paths = {row.path for row in fine.collect()}  # at most a window
    return {p.object_key for p in window if p.path not in readable_paths}


def ingest(
    index: Index, window: list[Pending], budget: int | None = None, framing: str = "standard", whole: bool = False
) -> dict:
    """Append one window's documents as a run and commit its progress -> its counts.

    The scan is written once; every later step reads a few columns of that table.
    """
    spark, runs = index.spark, index.run_list()
    run = max((r.run_id for r in runs), default=0) + 1

    def folder(kind: str, data: str = "") -> str:
        return f"{index.path}/{kind}/run_id={run}{data}"

    def write(df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", index.compression).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def stage(whole: bool) -> DataFrame:
        mapped = scan_objects(index, window, framing, whole)
        if index.info["enable_source"]:
            mapped = mapped.withColumn("_source", doc_json(mapped))
        return write(mapped, folder("docs", "/data=staged"))

    try:
        staged = stage(whole)
    except Exception as error:
        if whole or "FAILED_READ_FILE" not in str(error):
            raise
        # A damaged file: once more with objects read whole, which turns it into a reject row.
        staged = stage(True)
    ids = staged.filter("reject_reason IS NULL").select("doc_id", "pos")
    reason = F.col("reject_reason")
    states = outcomes(
        staged.select("object_key", "record_idx", "doc_id", "pos", "reject_reason", "resume_offset", "resume_idx"),
        absent(first_by_id(ids), index.ids(runs)),
    ).select(
        "object_key", "record_idx", "doc_id", "pos", "resume_offset", "resume_idx",
        F.when(reason.isNull(), F.col("outcome")).otherwise(F.lit("rejected")).alias("outcome"),
        F.when(reason.startswith("parse: "), reason).alias("parse_error"),
    )
    states = write(states, folder("outcomes"))
    _, cut = limit_new(states.filter("outcome = 'created'"), budget)

    # At most one row per object of the window. Reading goes on at the last consumed record's member.
    used = F.lit(True) if cut is None else F.col("pos") <= cut
    resume = F.max_by(F.struct("resume_offset", "resume_idx"), F.when(used & F.col("parse_error").isNull(), F.col("record_idx")))
    ended = states.groupBy("object_key").agg(resume.alias("resume"), F.max(F.when(used, F.col("parse_error"))).alias("error"))
    marked = object_progress(states, cut).join(ended, "object_key").select("*", "resume.*").drop("resume")
    rows = [row.asDict() for row in marked.collect()]
    # An object without any record left is finished too, unless the budget ended before it or the
    # scan gave nothing because its file is damaged.
    seen = {row["object_key"] for row in rows}
    empty = [p for p in window if p.object_key not in seen and (cut is None or p.visit << RECORD_BITS <= cut)]
    bad = unreadable(index, empty)
    for p in empty:
        broken = p.object_key in bad
        rows.append({
            "object_key": p.object_key, "next_record_idx": p.next_record_idx, "done": not broken,
            **dict.fromkeys(COUNTS, 0), "rejected": int(broken), "error": "parse: bad_gzip" if broken else None,
        })
    before = {p.object_key: p for p in window}
    for row in rows:
        p = before[row["object_key"]]
        if p.error is not None:  # counted when it first failed; now it says how it ended this time
            row["rejected"] -= 1
        if row.get("resume_offset") is None or row["resume_idx"] < p.resume_idx:
            row["resume_offset"], row["resume_idx"] = p.resume_offset, p.resume_idx
    totals = {c: sum(row[c] for row in rows) for c in COUNTS}

    # Repeated and existing ids are left out when reading while they are few in all runs together;
    # the content is written once more, without them, when they are not, and when the budget was
    # met. (The cut is the last created document; what follows it waits for the next run.)
    data = "staged"
    within = F.lit(True) if cut is None else F.col("pos") <= cut
    lost = states.filter(within & (F.col("outcome") == "already_exists")).select("pos")
    few = not totals["already_exists"] or sum(r.lost for r in runs) + totals["already_exists"] <= LOST_ROWS
    if cut is not None or not few:
        data = "kept"
        final = staged.filter(within).join(F.broadcast(lost) if few else lost, "pos", "left_anti")
        final.write.mode("overwrite").option("compression", index.compression).parquet(folder("docs", "/data=kept"))

    index.id_table().append(states.filter(within & (F.col("outcome") == "created")), run, index.compression)

    # Written last: from here on the run counts.
    progress = [{**row, "index_uuid": index.uuid, "run_id": run, "data": data, "cut": cut} for row in rows]
    spark.createDataFrame(progress, RUN_PROGRESS).coalesce(1).write.mode("overwrite").parquet(folder("progress"))
    if data == "kept":
        files.remove(spark, folder("docs", "/data=staged"))
    index.take_snapshot()
    return {"objects": len(rows), **totals}


def populate(
    index: Index,
    objects: DataFrame,
    base: str = "",
    n: int | None = None,
    window: int = WINDOW,
    framing: str = "standard",
    whole: bool = False,
    refresh: bool = False,
    retry_failed: bool = False,
) -> Outcome:
    """Add ``n`` new documents (all when None) in visit order, going on where the last run stopped.

    ``objects``: object_key, object_index, path (below ``base`` unless absolute). Objects are
    taken in windows, each one run with its own commit. With a budget the windows start small and follow what is still needed, so
    few objects beyond the budget are read; the result does not depend on the window sizes. ``whole`` reads objects
    as single payloads, for files without a ``.gz`` name, where Spark's readers read them. An object that is
    missing or damaged is rejected at the record where reading ended, keeps its documents, holds up no other object, and
    is left alone by later calls but for ``retry_failed``. Objects that share an index are visited by key.
    """
    done = Outcome()
    last, seen, size = (-1, ""), 0, window if n is None else min(FIRST_WINDOW, window)
    pending = pending_states(index, objects, retry_failed)
    while n is None or done.created < n:
        beyond = (F.col("object_index") > last[0]) | ((F.col("object_index") == last[0]) & (F.col("object_key") > last[1]))
        batch = pending.filter(beyond).orderBy("object_index", "object_key").limit(size).collect()  # at most one window
        if not batch:
            break
        listed = window_of(index, batch, base)
        done.add(ingest(index, listed, None if n is None else n - done.created, framing, whole))
        last = batch[-1].object_index, batch[-1].object_key
        if n is not None:
            # As many objects as the rest of the budget should need, going by what they gave so far.
            seen += len(batch)
            wanted = -(-(n - done.created) * seen // done.created) if done.created else 2 * size
            size = max(FIRST_WINDOW, min(wanted, window))
    index.clean()
    if refresh:
        index.refresh()
    return done
