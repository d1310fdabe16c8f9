"""SimHash near-duplicates by a self-join of binary tries: node pairs are traversed together, their
differing bits add up, and a pair beyond its budget is dropped with all that lies below it.

One trie from the first bit on would allow all errors in its first levels, where no node is small
yet. So there is a trie for each of within + 1 turns of the fingerprint by a block of its bits. For
fingerprints at most ``within`` bits apart there is a turn with none of them in the first block, at
most one in the first two, and so on (if each turn failed, the blocks would hold more errors than
there are): each turn's traversal keeps to that budget and together they find every pair. The nodes
of the first block are tiles, spread by Spark; a tile with too many fingerprints for one task is cut
into the node pairs of its next levels, and so on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import groups, words, written
from webcorpus.llm.components import components

SEED = 42  # of the shingles' XXH64
CHUNK = 1 << 16  # shingles hashed at a time
STRIDE = 8  # levels by which a large tile is cut
TILE = 4096  # fingerprints that a tile may hold at least, before it is cut
LARGEST = 1 << 20  # and at most
SHARE = 1000  # a tile larger than TILE is cut where it has over one of this many rows
SALTS = 32  # parts in which the rows of a large tile meet its entry
FRONTIER = 1 << 21  # node pairs held at a time
HEAVY = 5000  # a fingerprint of more than one in this many documents is joined by broadcast


def fingerprint(text: bytes, k: int = 3) -> int:
    """Each bit is set if it is set in over half of the hashes of the k-word shingles, repeats included."""
    found = words(text)
    if not found:
        return 0
    line = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(len(found) - k + 1, 1)
    ends = ends[-n:]
    votes = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for low in range(0, n, CHUNK):
        bounds = zip(starts[low : min(low + CHUNK, n)].tolist(), ends[low : low + CHUNK].tolist())
        h = np.array([hashed(line[a:b], SEED) for a, b in bounds], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t.as_py() or b"", k) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(made.view(np.int64), pa.int64())], ["doc_id", "fp"]
            )

    return run


def _ends(within: int) -> list[int]:
    """Where the blocks end; block j ends with at most j errors (from 0) seen."""
    return [64 * (j + 1) // (within + 1) for j in range(within + 1)]


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    """Turned left by a number of bits."""
    return x if by == 0 else (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _in_budget(x: np.ndarray, within: int) -> np.ndarray:
    """Whether differing bits keep to the budget at the end of every block."""
    kept = np.ones(len(x), bool)
    for j, end in enumerate(_ends(within)):
        kept &= np.bitwise_count(x >> np.uint64(64 - end)) <= j
    return kept


def traverse(keys: np.ndarray, pairs: np.ndarray, level: int, within: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs of keys within budget.

    keys are sorted inside each node. pairs is an array (5, n) of node pairs at the level: start and
    end of either node among the keys, and the bits in which their prefixes differ; a node paired
    with itself has equal ranges.
    """
    ends = _ends(within)
    stack = [(level, pairs)]
    while stack:
        level, pairs = stack.pop()
        while pairs.shape[1]:
            al, ah, bl, bh, apart = pairs
            leaf = ((ah - al) == 1) & ((bh - bl) == 1)
            ready = leaf & (al != bl)
            if ready.any():
                i, j = al[ready], bl[ready]
                good = _in_budget(keys[i] ^ keys[j], within)
                yield i[good], j[good]
            pairs = pairs[:, ~leaf]
            if pairs.shape[1] > FRONTIER:
                half = pairs.shape[1] // 2
                stack.append((level, pairs[:, half:]))
                pairs = pairs[:, :half]
            if not pairs.shape[1]:
                break
            al, ah, bl, bh, apart = pairs
            budget = next(j for j, end in enumerate(ends) if level < end)
            ones = np.concatenate(([0], np.cumsum((keys >> np.uint64(63 - level)) & np.uint64(1), dtype=np.int64)))
            am, bm = ah - (ones[ah] - ones[al]), bh - (ones[bh] - ones[bl])
            itself = al == bl
            made = [
                np.stack([al, am, bl, bm, apart]),
                np.stack([am, ah, bm, bh, apart]),
                np.stack([al, am, bm, bh, apart + 1]),
                np.stack([am, ah, bl, bm, apart + 1])[:, ~itself],
            ]
            pairs = np.concatenate(made, axis=1)
            pairs = pairs[:, (pairs[0] < pairs[1]) & (pairs[2] < pairs[3]) & (pairs[4] <= budget)]
            level += 1


def forest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The least position that links (a, b) reach from each of n, given the labels of earlier links."""
    label = np.arange(n) if label is None else label
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return label
        a, b, low, high = a[open_], b[open_], np.minimum(la, lb)[open_], np.maximum(la, lb)[open_]
        np.minimum.at(label, high, low)
        while True:
            deeper = label[label]
            if np.array_equal(deeper, label):
                break
            label = deeper


def _join_tiles(within: int):
    """Tiles -> links between their rows, by traversal: from each row to the first that it reaches."""
    starts = [0] + _ends(within)[:-1]

    def solve(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for depth in np.unique(columns["depth"]):
            at = np.flatnonzero(columns["depth"] == depth)
            part = {name: column[at] for name, column in columns.items()}
            keys = part["key"].view(np.uint64)
            pairs = []
            for lo, hi in _runs(part):
                cut = lo + int(np.searchsorted(part["side"][lo:hi], 1))
                apart = int(part["apart"][lo])
                if part["left"][lo] == part["right"][lo]:
                    pairs.append((lo, hi, lo, hi, apart))
                elif lo < cut < hi:
                    pairs.append((lo, cut, cut, hi, apart))
            if not pairs:
                continue
            label = np.arange(len(keys))
            for i, j in traverse(keys, np.array(pairs, np.int64).T, int(depth), within):
                label = forest(len(keys), i, j, label)
            linked = np.flatnonzero(label != np.arange(len(keys)))
            least = part["least"]
            if len(linked):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(least[linked], pa.int64()), pa.array(least[label[linked]], pa.int64())], ["a", "b"]
                )

    names = ["depth", "turn", "left", "right", "apart", "side", "key", "least"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict[str, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {name: batch.column(name).to_numpy() for name in names}
            # Whole tiles only: the last one of a batch may go on in the next.
            last = max(lo for lo, _ in _runs(columns))
            if last == 0 and waiting and _tile(waiting[-1], -1) == _tile(columns, 0):
                waiting.append(columns)
                continue
            waiting.append({name: column[:last] for name, column in columns.items()})
            yield from solve({name: np.concatenate([w[name] for w in waiting]) for name in names})
            waiting = [{name: column[last:] for name, column in columns.items()}]
        if waiting:
            yield from solve({name: np.concatenate([w[name] for w in waiting]) for name in names})

    return run


def _tile(columns: dict[str, np.ndarray], i: int) -> tuple:
    return tuple(columns[name][i] for name in ("depth", "turn", "left", "right"))


def _runs(columns: dict[str, np.ndarray]) -> Iterator[tuple[int, int]]:
    """Start and end of each tile; rows come sorted by it."""
    tile = np.stack([columns[name].astype(np.int64) for name in ("depth", "turn", "left", "right")])
    step = np.concatenate(([0], np.cumsum((tile[:, 1:] != tile[:, :-1]).any(axis=0))))
    yield from groups(step)


def _prefix(key: Column, depth: Column) -> Column:
    return F.call_function("shiftrightunsigned", key, (F.lit(64) - depth).cast("int"))


def _cut(rows: DataFrame, within: int) -> DataFrame:
    """The rows of large tiles in the node pairs of the next levels that keep to the budget."""
    ends = _ends(within)
    stride = F.least(F.lit(STRIDE), F.lit(64) - F.col("depth")).cast("int")
    below = F.col("depth") + stride
    budget = F.lit(within)
    for j in reversed(range(within)):
        budget = F.when(below <= ends[j], j).otherwise(budget)
    rows = rows.withColumn("below", below.cast("int")).withColumn("budget", budget).withColumn(
        "own", _prefix(F.col("key"), F.col("below"))
    )
    flips = F.filter(
        F.sequence(F.lit(0), F.lit((1 << STRIDE) - 1)),
        lambda x: (F.bit_count(x) + F.col("apart") <= F.col("budget"))
        & (F.call_function("shiftright", x, F.col("below") - F.col("depth")) == 0),
    )
    met = rows.withColumn("flip", F.explode(flips)).withColumn("other", F.col("own").bitwiseXOR(F.col("flip").cast("bigint")))
    # The other side's prefix keeps the bits in which the tile's two prefixes differ.
    differ = F.call_function("shiftleft", F.col("left").bitwiseXOR(F.col("right")), F.col("below") - F.col("depth"))
    met = met.withColumn("other", F.col("other").bitwiseXOR(differ))
    itself = F.col("left") == F.col("right")
    swapped = F.when(itself, F.col("own") > F.col("other")).otherwise(F.col("side") == 1)
    return met.select(
        F.col("below").alias("depth"), "turn",
        F.when(swapped, F.col("other")).otherwise(F.col("own")).alias("left"),
        F.when(swapped, F.col("own")).otherwise(F.col("other")).alias("right"),
        (F.col("apart") + F.bit_count("flip")).cast("int").alias("apart"),
        swapped.cast("int").alias("side"), "key", "least",
    )


TILES = ["depth", "turn", "left", "right"]


def hamming_links(prints: DataFrame, within: int = 3) -> DataFrame:
    """Links (a, b) that connect the rows (fp, least) whose fingerprints differ in at most ``within``
    bits; fp is distinct. In a tile, a row is linked with the first it reaches, not with all it meets."""
    ends = _ends(within)
    key = F.col("fp")
    turned = [
        key if start == 0 else F.shiftleft(key, start).bitwiseOR(F.shiftrightunsigned(key, 64 - start))
        for start in [0] + ends[:-1]
    ]
    rows = prints.select("least", F.posexplode(F.array(*turned)).alias("turn", "key"))
    width = F.lit(ends[0]).cast("int")
    rows = rows.select(
        width.alias("depth"), "turn", _prefix(F.col("key"), width).alias("left"), _prefix(F.col("key"), width).alias("right"),
        F.lit(0).alias("apart"), F.lit(0).alias("side"), "key", "least",
    )
    limit = min(LARGEST, max(TILE, (within + 1) * prints.count() // SHARE))
    found, edges = [], None
    while True:
        large = rows.groupBy(*TILES).count().filter((F.col("count") > limit) & (F.col("depth") < 64)).drop("count")
        large = written(large, "large-tiles")
        whole = large.isEmpty()
        if not whole:
            salted = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
            entries = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn(
                "salt", F.col("salt").cast("bigint")
            )
            keys = [*TILES, "salt"]
            found.append(salted.join(entries, keys, "left_anti").drop("salt"))
            rows = written(_cut(salted.join(entries, keys, "left_semi").drop("salt"), within), "cut-tiles")
        else:
            found.append(rows)
            break
    for tiles in found:
        dealt = tiles.repartition(*TILES).sortWithinPartitions(*TILES, "side", "key")
        links = dealt.mapInArrow(_join_tiles(within), "a bigint, b bigint")
        edges = links if edges is None else edges.unionByName(links)
    return edges


def near_duplicates(documents: DataFrame, k: int = 3, within: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of documents (doc_id, text, ...).

    Words are what stands between ASCII blanks, with A-Z in lower case; a text of fewer than k words
    is one shingle. Whole texts count, however long, a bounded number of shingles at a time.
    fingerprint is 16 hex digits. component_id is the least doc_id that links of at most ``within``
    differing bits reach. NULL, empty and blank texts have fingerprint zero, which links like any
    other. Equal fingerprints are one class, however many. A doc_id that comes several times is one
    document: its rows share a component. A row without a doc_id links with nothing and has no
    component. Other columns are not read; an empty table gives no rows.
    """
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    prints = written(texts.mapInArrow(_fingerprints(k), "doc_id bigint, fp bigint"), "fingerprints")
    known = prints.filter("doc_id IS NOT NULL")
    classes = written(known.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "classes")
    links = hamming_links(classes.select("fp", "least"), within)
    several = known.groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low <> high")
    several = (
        known.join(several.select("doc_id"), "doc_id", "left_semi").distinct()
        .join(classes.select("fp", "least"), "fp").select(F.col("doc_id").alias("a"), F.col("least").alias("b"))
    )
    reached = components(links.unionByName(several))
    named = written(
        classes.join(reached, F.col("least") == F.col("id"), "left")
        .select("fp", "n", F.coalesce("component", "least").alias("component_id")),
        "named-classes",
    )
    # Classes of over one in HEAVY documents are fewer than HEAVY, at any size; the others are small
    # against the whole, so that neither join has a hot key.
    heavy = F.col("n") > max(prints.count() // HEAVY, 1)
    first = prints.join(F.broadcast(named.filter(heavy).drop("n")), "fp", "left")
    rest = first.filter("component_id IS NULL").drop("component_id")
    out = first.filter("component_id IS NOT NULL").unionByName(
        rest.join(named.filter(~heavy).drop("n"), "fp", "left").select("fp", "doc_id", "component_id")
    )
    return out.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
