"""Bulk bodies: rendering, byte-bounded packing, replies and their tally."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.operators.mappings import doc_json

# Fixed value: the largest bulk body.
BULK_CAP = 5 * 1024 * 1024

# Records per packing segment: what one task handles at a time, however large the object.
SEGMENT = 1 << 17


def render_bulk(docs: DataFrame, index_name: str | Column, cap: int = BULK_CAP) -> DataFrame:
    """Documents -> ``payload`` (action line and document line), ``n_bytes``, and the reject
    reason ``oversize`` for a payload that no body can hold."""
    name = F.lit(index_name) if isinstance(index_name, str) else index_name
    action = F.to_json(
        F.struct(F.struct(F.col("doc_id").alias("_id"), name.alias("_index")).alias("create"))
    )
    return (
        docs.withColumn("payload", F.concat(action, F.lit("\n"), doc_json(docs), F.lit("\n")))
        .withColumn("n_bytes", F.octet_length("payload").cast("bigint"))
        .withColumn("reject_reason", F.when(F.col("n_bytes") > cap, F.lit("oversize")))
        .drop("doc")
    )


def _chain(sizes: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a body opened at each record of a run: how many bodies the run opens from there on,
    and how full the last one is at the end. Plus the prefix sums."""
    prefix = np.concatenate(([0], np.cumsum(sizes)))
    n = len(sizes)
    # First record that no longer fits a body opened at i.
    nxt = np.searchsorted(prefix, prefix[:-1] + cap, side="right") - 1
    opened, fill = np.ones(n + 1, np.int64), np.zeros(n + 1, np.int64)
    for i in range(n - 1, -1, -1):
        j = nxt[i]
        if j >= n:
            fill[i] = prefix[n] - prefix[i]
        else:
            opened[i], fill[i] = opened[j] + 1, fill[j]
    return opened, fill, prefix


_SUMMARY = "object_key STRING, segment BIGINT, upto BIGINT, opened BIGINT, fill BIGINT"


def _summarise(cap: int):
    """One segment -> how it acts on the fill level it is entered with, as a step table.

    Entered with fill f, the first new body opens at the first record i with f + prefix > cap;
    the rest follows from i alone. Rows: for f up to ``upto``, ``opened`` bodies open and the
    last is filled to ``fill`` (or, when none opens, grows by ``fill``)."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("record_idx")
        opened, fill, prefix = _chain(table["n_bytes"].to_numpy(), cap)
        # Entry i is met for cap - prefix[i+1] < f <= cap - prefix[i]; the last row is i = n.
        last = int(np.searchsorted(prefix, cap, side="right")) - 1
        entry = np.arange(last, -1, -1)
        upto, n = cap - prefix[entry], len(prefix) - 1
        o = np.where(entry == n, 0, opened[entry])
        f = np.where(entry == n, prefix[n], fill[entry])
        # Neighbouring steps with the same effect merge into one.
        keep = np.ones(len(entry), bool)
        keep[:-1] = (o[:-1] != o[1:]) | (f[:-1] != f[1:])
        size = int(keep.sum())
        return pa.table(
            {
                "object_key": pa.array([key[0].as_py()] * size, pa.string()),
                "segment": pa.array([key[1].as_py()] * size, pa.int64()),
                "upto": pa.array(upto[keep]),
                "opened": pa.array(o[keep]),
                "fill": pa.array(f[keep]),
            }
        )

    return run


_ENTRY = "object_key STRING, segment BIGINT, start_batch BIGINT, start_fill BIGINT"


def _enter(key: tuple, table: pa.Table) -> pa.Table:
    """Step tables of one object's segments -> batch number and fill at each segment's start."""
    table = table.sort_by([("segment", "ascending"), ("upto", "ascending")])
    segment, upto, opened, fill = (table[c].to_numpy() for c in ("segment", "upto", "opened", "fill"))
    starts = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
    batch, level, rows = 0, 0, []
    for a, b in zip(starts, np.append(starts[1:], len(segment))):
        rows.append((key[0].as_py(), int(segment[a]), batch, level))
        step = a + int(np.searchsorted(upto[a:b], level, side="left"))
        batch += int(opened[step])
        level = int(fill[step]) + (level if opened[step] == 0 else 0)
    names = ["object_key", "segment", "start_batch", "start_fill"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _assign(cap: int):
    def run(payloads: pa.Table, entry: pa.Table) -> pa.Table:
        payloads = payloads.sort_by("record_idx")
        sizes = payloads["n_bytes"].to_numpy()
        batch, level = entry["start_batch"][0].as_py(), entry["start_fill"][0].as_py()
        prefix = np.concatenate(([0], np.cumsum(sizes)))
        batches, i, n = np.empty(len(sizes), np.int64), 0, len(sizes)
        while i < n:
            stop = int(np.searchsorted(prefix, prefix[i] + cap - level, side="right")) - 1
            batches[i:stop] = batch
            batch, level, i = batch + 1, 0, stop
        return pa.table(
            {
                "object_key": payloads["object_key"],
                "record_idx": payloads["record_idx"],
                "batch_no": pa.array(batches),
            }
        )

    return run


def pack_batches(payloads: DataFrame, cap: int = BULK_CAP, segment: int = SEGMENT) -> DataFrame:
    """Number the bulk bodies of each object from 0: in record order, a body is closed when the
    next payload would take it over ``cap`` bytes. Payloads over the cap are left out.

    Greedy packing is sequential, but its only state is how full the open body is. Each segment
    of an object is summarised as a step function of that state, the few steps are chained per
    object, and each segment is then packed on its own; no task holds more than one segment's
    sizes, and payloads never move.
    """
    sized = payloads.filter(F.col("n_bytes") <= cap).select(
        "object_key", "record_idx", "n_bytes", F.floor(F.col("record_idx") / segment).alias("segment")
    )
    keyed = sized.repartition("object_key", "segment")
    steps = keyed.groupBy("object_key", "segment").applyInArrow(_summarise(cap), _SUMMARY)
    entries = steps.groupBy("object_key").applyInArrow(_enter, _ENTRY)
    return (
        keyed.groupBy("object_key", "segment")
        .cogroup(entries.groupBy("object_key", "segment"))
        .applyInArrow(_assign(cap), "object_key STRING, record_idx BIGINT, batch_no BIGINT")
    )


def write_bodies(rendered: DataFrame, path: str, cap: int = BULK_CAP, segment: int = SEGMENT) -> None:
    """Write every body as one NDJSON file below ``object_key=<k>/batch_no=<b>``, in record order.

    Payloads move once, by body, so no task gathers more than it was dealt bodies of ``cap`` bytes.
    """
    batches = pack_batches(rendered.select("object_key", "record_idx", "n_bytes"), cap, segment)
    keys = ["object_key", "batch_no"]
    (
        rendered.join(batches, ["object_key", "record_idx"])
        .repartition(*keys)
        .sortWithinPartitions(*keys, "record_idx")
        .select(*keys, F.rtrim("payload", F.lit("\n")).alias("value"))
        .write.partitionBy(*keys).option("lineSep", "\n").text(path)
    )


# Fixed format: the reply to one bulk body.
REPLY_SCHEMA = """
    errors BOOLEAN,
    items ARRAY<STRUCT<create: STRUCT<_id: STRING, _index: STRING, error: STRING, status: INT>>>
"""


def bulk_response_rows(replies: DataFrame, column: str = "reply") -> DataFrame:
    """JSON replies -> one row per item with its outcome.

    Only a reply that reports errors has its items inspected: status 409 with a version conflict
    means the document exists, any other error means it failed.
    """
    carried = [c for c in replies.columns if c != column]
    parsed = replies.select(*carried, F.from_json(column, REPLY_SCHEMA).alias("r"))
    rows = parsed.select(*carried, F.col("r.errors").alias("errors"), F.inline("r.items")).select(
        *carried,
        F.col("create._id").alias("doc_id"),
        F.col("create._index").alias("index_name"),
        F.col("create.status").alias("status"),
        F.col("create.error").alias("error"),
        "errors",
    )
    kind = F.get_json_object("error", "$.type")
    return rows.select(
        *carried,
        "doc_id",
        "index_name",
        "status",
        kind.alias("error_type"),
        F.when(~F.col("errors") | F.col("error").isNull(), F.lit("created"))
        .when((F.col("status") == 409) & (kind == "version_conflict_engine_exception"), F.lit("already_exists"))
        .otherwise(F.lit("failed"))
        .alias("outcome"),
    )


# Replies after which the same document may be sent again.
RETRIED = (429, 502, 503, 504)


def reply_outcomes(batches: DataFrame, replies: DataFrame, column: str = "reply") -> DataFrame:
    """What the replies say about every record that was sent.

    ``batches`` (object_key, record_idx, batch_no, and what else a row carries) are the bodies,
    ``replies`` (object_key, batch_no, reply) the answers; the n-th item answers the n-th record of
    the body. Adds ``outcome`` (created, already_exists or failed), ``error`` and ``retry``. A record
    without an item, as its reply is missing, short or no JSON, has failed and is to be sent again,
    and so has one that failed under a status of RETRIED.
    """
    keys = ["object_key", "batch_no"]
    # A body holds at most BULK_CAP bytes of records.
    sent = batches.withColumn("item", F.row_number().over(Window.partitionBy(*keys).orderBy("record_idx")) - 1)
    parsed = replies.select(*keys, F.from_json(column, REPLY_SCHEMA).alias("r"))
    items = parsed.select(*keys, F.col("r.errors").alias("errors"), F.posexplode("r.items").alias("item", "answer")).select(
        *keys, "item", "errors", F.col("answer.create.status").alias("status"), F.col("answer.create.error").alias("cause")
    )
    kind = F.get_json_object("cause", "$.type")
    fine = ~F.col("errors") | F.col("cause").isNull()
    outcome = (
        F.when(F.col("errors").isNull(), "failed").when(fine, "created")
        .when((F.col("status") == 409) & (kind == "version_conflict_engine_exception"), "already_exists").otherwise("failed")
    )
    again = F.col("errors").isNull() | F.col("status").isin(*RETRIED)
    return (
        sent.join(items, [*keys, "item"], "left").withColumn("outcome", outcome)
        .withColumn("error", F.when(F.col("outcome") == "failed", F.coalesce(kind, F.lit("no_reply"))))
        .withColumn("retry", (F.col("outcome") == "failed") & again)
        .drop("item", "errors", "status", "cause")
    )


def reply_progress(rows: DataFrame, rejected: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Outcomes of ``reply_outcomes`` -> progress per object, and the records to send again.

    Progress counts records up to the object's first one that is to be sent again, so that going on
    from there loses none; later ones that were created already come back as existing. ``rejected``
    (object_key, record_idx) are records that no body held.
    """
    if rejected is not None:
        refused = rejected.select("object_key", "record_idx", F.lit("rejected").alias("outcome"), F.lit(False).alias("retry"))
        rows = rows.unionByName(refused, allowMissingColumns=True)
    again = rows.groupBy("object_key").agg(F.min(F.when(F.col("retry"), F.col("record_idx"))).alias("_again"))
    counted = rows.join(again, "object_key")
    used = F.col("_again").isNull() | (F.col("record_idx") < F.col("_again"))
    progress = counted.groupBy("object_key").agg(
        F.coalesce(F.max(F.when(used, F.col("record_idx"))), F.lit(0).cast("bigint")).alias("next_record_idx"), F.bool_and(used).alias("done"),
        *[F.count_if(used & (F.col("outcome") == c)).alias(c) for c in ("created", "already_exists", "failed", "rejected")],
    )
    return progress, rows.filter("retry")


def tally_outcomes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of created, already existing and failed documents per key."""
    return rows.groupBy(*keys).agg(
        *[F.count_if(F.col("outcome") == o).alias(o) for o in ("created", "already_exists", "failed")]
    )
