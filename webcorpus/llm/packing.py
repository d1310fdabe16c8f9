"""Best-fit packing of documents into sequences of several permitted lengths.

Documents are cut into pieces of at most the largest length; full pieces are sequences already, so
one remainder per document is left to pack. Remainders are dealt into shards by a hash and packed
there by decreasing length: a piece goes to the open bin that it leaves the fullest; where none has
room, a bin opens with the length that costs least per token that it can still expect to hold. At
the end each bin shrinks to the cheapest length that holds its contents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import written

SHARD = 50_000  # remainders packed together


def pack(lengths: list[int], capacities: tuple[int, ...], costs: tuple[float, ...]) -> tuple[list[int], list[int], list[int], list[int]]:
    """The bin and offset of each length, and the capacity and fill of each bin.

    lengths come in decreasing order. costs go with the capacities, both rising.
    """
    room_of: list[int] = []
    opened: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set where a bin has room r
    left = sum(lengths)
    bins, offsets = [], []
    for length in lengths:
        above = rooms >> length
        if above:
            room = length + (above & -above).bit_length() - 1
            held = by_room[room]
            b = held.pop()
            if not held:
                rooms &= ~(1 << room)
        else:
            fits = [i for i, c in enumerate(capacities) if c >= length]
            # All that is left bounds what a bin can hold; of equal prices, the longer bin fits more.
            choice = min(fits, key=lambda i: (costs[i] / min(capacities[i], left), -capacities[i]))
            b, room = len(opened), capacities[choice]
            opened.append(room)
            room_of.append(room)
        left -= length
        bins.append(b)
        offsets.append(opened[b] - room)
        room -= length
        room_of[b] = room
        by_room.setdefault(room, []).append(b)
        rooms |= 1 << room
    fills = [c - r for c, r in zip(opened, room_of)]
    shrunk = [min((cost, c) for c, cost in zip(capacities, costs) if c >= fill)[1] for fill in fills]
    return bins, offsets, shrunk, fills


def _pack_shards(capacities: tuple[int, ...], costs: tuple[float, ...]):
    def done(rows: list[tuple], shard: int, first: int) -> tuple[pa.RecordBatch, int]:
        ids, pieces, starts, lengths = zip(*rows)
        bins, offsets, sizes, fills = pack(list(lengths), capacities, costs)
        number = (np.int64(shard) << 32) + first + np.array(bins, np.int64)
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array(number), pa.array(np.array(sizes)[bins], pa.int64()), pa.array(np.array(fills)[bins], pa.int64()),
                pa.array(offsets, pa.int64()), pa.array(ids, pa.int64()), pa.array(pieces, pa.int64()),
                pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
            ],
            ["bin_id", "capacity", "fill", "offset", "doc_id", "piece", "start", "length"],
        )
        return batch, first + len(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come by shard and falling length; a shard far beyond its size is packed in slices.
        rows: list[tuple] = []
        shard, first = None, 0
        for batch in batches:
            for s, *row in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "piece", "start", "length"))):
                if rows and (s != shard or len(rows) >= 4 * SHARD):
                    out, first = done(rows, shard, first)
                    yield out
                    rows = []
                if s != shard:
                    shard, first = s, 0
                rows.append(tuple(row))
        if rows:
            yield done(rows, shard, first)[0]

    return run


PLACES = "bin_id bigint, capacity bigint, fill bigint, offset bigint, doc_id bigint, piece bigint, start bigint, length bigint"


def pack_documents(
    documents: DataFrame, capacities: tuple[int, ...] = (2048, 4096, 8192), costs: tuple[float, ...] | None = None,
    length: Column | None = None,
) -> DataFrame:
    """Where each piece of each document goes: (bin_id, capacity, fill, offset, doc_id, piece, start, length).

    documents has doc_id and text. A document is its UTF-8 bytes, a token each, and an end token
    (or `length` tokens, where given); [start, start + length) are the tokens of the piece and
    offset is where it stands in its bin. capacities are the permitted lengths and costs what one
    sequence of each costs, its length where not given. A NULL or empty text is its end token.
    Repeated rows are packed each, in bins of their own where they fill them; equal lengths are
    packed by doc_id. Which bin a piece is in depends on how the rows are stored. A NULL doc_id is packed as
    NULL. An empty table gives no rows. Other columns are not read.
    """
    capacities = tuple(sorted(capacities))
    costs = tuple(float(c) for c in (costs or capacities))
    most = capacities[-1]
    size = length if length is not None else F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1
    # The number of a row is fixed as it is written; it tells repeated rows apart.
    sized = documents.select(F.col("doc_id").cast("bigint"), size.cast("bigint").alias("size"))
    sized = written(sized.withColumn("row", F.monotonically_increasing_id()), "sizes")
    full = F.expr(f"(size - 1) div {most}")
    whole = sized.filter(F.col("size") > most).select("doc_id", F.explode(F.sequence(F.lit(0).cast("bigint"), full - 1)).alias("piece"))
    # A full piece is a bin of its own; negative numbers keep its bin_id apart.
    whole = written(whole.withColumn("bin_id", -1 - F.monotonically_increasing_id()), "whole")
    whole = whole.select(
        "bin_id", F.lit(most).cast("bigint").alias("capacity"),
        F.lit(most).cast("bigint").alias("fill"), F.lit(0).cast("bigint").alias("offset"), "doc_id", "piece",
        (F.col("piece") * most).alias("start"), F.lit(most).cast("bigint").alias("length"),
    )
    shards = max(1, -(-sized.count() // SHARD))
    rest = sized.select(
        F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"), "doc_id", full.alias("piece"), (full * most).alias("start"),
        (F.col("size") - full * most).alias("length"),
    )
    dealt = rest.repartition(shards, "shard").sortWithinPartitions("shard", F.desc("length"), "doc_id", "piece")
    return whole.unionByName(dealt.mapInArrow(_pack_shards(capacities, costs), PLACES))
