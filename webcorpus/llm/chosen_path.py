"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles. Documents with equal sets form a class, and one of
each class goes on. Independent trees branch the classes: a node picks coordinates of the minwise
sketch at random, and a document goes to the child that its value in the coordinate names, so that
documents stay together with the probability of their similarity. A node picks 1 / threshold
coordinates on average, and at least one. Small nodes compare their members exhaustively, on
sketches of a byte per coordinate; larger nodes branch on. What is still large after that many
levels mostly holds documents that are alike: it is dealt into blocks that share pivots, and then
every member that these comparisons don't join to most of the pivots meets all of the node.

Alike sketches only nominate. They join documents into clusters, and the links inside a cluster
are confirmed on the full sets, each of which moves once per block. A cluster beyond one block
compares its blocks with shared pivots, and then every document outside the cluster's main
component with all of the cluster, which covers all pairs that could still join components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import Union, WordHashes, groups, mix, shingle_set, whole_groups, written
from webcorpus.llm.components import components

WIDTH = 128  # coordinates of a sketch
NODE = 512  # members up to which a node or cluster is compared exhaustively
BLOCK = 256  # members of a block of a larger one
PIVOTS = 64  # members that all blocks of a larger one share
WEIGHT = 2_000_000  # shingles of a block
LEVELS = 3  # branchings before a node counts as alike


def _multipliers() -> np.ndarray:
    seeds = mix(np.arange(1, WIDTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds | np.uint64(1)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The minwise values of a set, 32 bits for each coordinate."""
    factors = _multipliers()
    low = np.full(WIDTH, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 2048):
        part = factors[:, None] * shingles[None, start : start + 2048]
        part ^= part >> np.uint64(32)
        part *= np.uint64(0xD6E8FEB86659FD93)
        np.minimum(low, part.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def _profiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, keys, sketches = [], [], []
            for text in batch.column(1).to_pylist():
                found = shingle_set(hashes.of(text or b""), k)
                sizes.append(len(found))
                keys.append(xxhash.xxh128_digest(found.tobytes()) if len(found) else None)
                sketches.append(sketch(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary())],
                ["doc_id", "n_shingles", "key", "sketch"],
            )

    return run


def trees_for(threshold: float, recall: float) -> int:
    """Trees that find a pair at the threshold with the target probability, though it may have to
    stay together in as many branchings as there are, from the root on, and though its sketches
    may agree in fewer coordinates than its sets do."""
    agree = np.arange(WIDTH + 1)
    ways = np.array([math.comb(WIDTH, int(n)) for n in agree], float)
    chance = ways * threshold**agree * (1 - threshold) ** (WIDTH - agree)
    extra, found = 1 / threshold - 1, np.ones(WIDTH + 1)
    for _ in range(LEVELS + 1):
        one = agree / WIDTH * found
        found = 1 - (1 - one) * (1 - extra * one)
    # What agrees too seldom to be nominated is no matter of trees.
    kept = agree >= least_for(threshold)
    trees = 1
    while (chance * (1 - found) ** trees)[kept].sum() > 1 - recall:
        trees += 1
    return trees


def least_for(threshold: float) -> int:
    """Coordinates in which the sketches of a pair at the threshold agree, but for one pair in 70,000."""
    return math.floor((threshold - 4.2 * math.sqrt(threshold * (1 - threshold) / WIDTH)) * WIDTH)


def _children(nodes: np.ndarray, sketches: np.ndarray, extra: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and child nodes: one coordinate for each node, a second with the probability."""
    first = mix(nodes ^ np.uint64(1))
    second = mix(nodes ^ np.uint64(2))
    also = np.flatnonzero(mix(nodes ^ np.uint64(3)) < np.uint64(int(extra * 2**63) * 2))
    rows = np.concatenate((np.arange(len(nodes)), also))
    one = first % np.uint64(WIDTH)
    # The second differs from the first.
    two = (one + np.uint64(1) + second % np.uint64(WIDTH - 1)) % np.uint64(WIDTH)
    coordinate = np.concatenate((one, two[also])).astype(np.int64)
    value = sketches[rows, coordinate].astype(np.uint64)
    return rows, mix(nodes[rows] + mix(value + (coordinate.astype(np.uint64) << np.uint64(40))))


def _matrix(column: pa.Array, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _branch(threshold: float, trees: int | None):
    """Children of the rows (node, doc_id, sketch); from the roots where trees are given."""
    extra = 1 / threshold - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("doc_id").to_numpy()
            values = _matrix(batch.column("sketch"), np.uint32)
            if trees is None:
                rows, nodes = _children(batch.column("node").to_numpy().view(np.uint64), values, extra)
            else:
                roots = mix(np.arange(1, trees + 1, dtype=np.uint64))
                rows, nodes = _children(np.repeat(roots, len(ids)), np.tile(values, (trees, 1)), extra)
                rows = rows % len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes.view(np.int64)), pa.array(ids[rows])], ["node", "doc_id"]
            )

    return run


def _join_alike(sketches: np.ndarray, first: int, least: int) -> tuple[Union, list[tuple[int, int]]]:
    """Sets of rows that agree often enough, the first so many compared with all behind them, and stars."""
    sets, stars = Union(len(sketches)), []
    for i in range(min(first, len(sketches) - 1)):
        alike = np.flatnonzero(np.count_nonzero(sketches[i + 1 :] == sketches[i], axis=1) >= least)
        stars += [(i, j) for j in (alike + i + 1).tolist() if sets.join(i, j)]
    return sets, stars


def _nominate(least: int):
    """Stars of the members of a group (gid, doc_id, bytes) whose sketches agree often enough; where
    some are asking, only pairs with one of those are compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "gid"):
            rows = rows.combine_chunks()
            gids, ids = rows["gid"].to_numpy(), rows["doc_id"].to_numpy()
            if not len(gids):
                continue
            bytes_ = _matrix(rows["bytes"].chunk(0), np.uint8)
            asks = rows["asks"].to_numpy() if "asks" in rows.column_names else None
            a, b = [], []
            for start, end in groups(gids):
                if end - start < 2:
                    continue
                members, part, first = ids[start:end], bytes_[start:end], end - start
                if asks is not None:
                    order = np.argsort(~asks[start:end], kind="stable")
                    members, part, first = members[order], part[order], int(asks[start:end].sum())
                for i, j in _join_alike(part, first, least)[1]:
                    a.append(members[i])
                    b.append(members[j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _strays(least: int):
    """What _nominate gives for the blocks (gid, node, doc_id, pivot, bytes) of large nodes, with a
    NULL node, and (doc_id, doc_id, node) for those that aren't joined to the largest component of
    the pivots, which is the same in each block of a node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "gid"):
            rows = rows.combine_chunks()
            gids, ids, nodes, pivots = (rows[name].to_numpy() for name in ("gid", "doc_id", "node", "pivot"))
            if not len(gids):
                continue
            bytes_ = _matrix(rows["bytes"].chunk(0), np.uint8)
            out = []
            for start, end in groups(gids):
                order = np.lexsort((ids[start:end], ~pivots[start:end])) + start
                members, leading = ids[order].tolist(), int(pivots[start:end].sum())
                sets, stars = _join_alike(bytes_[order], len(order), least)
                out += [(members[i], members[j], None) for i, j in stars]
                alone = _join_alike(bytes_[order[:leading]], leading, least)[0]
                main = sets.find(int(np.bincount([alone.find(i) for i in range(leading)]).argmax())) if leading else None
                out += [(doc, doc, int(nodes[start])) for i, doc in enumerate(members) if sets.find(i) != main]
            columns = zip(*out) if out else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "node"])

    return run


def _confirm(k: int, above: int, below: int):
    """Links of a group (gid, doc_id, key, text), as stars: above * |A and B| >= below * |A or B|."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for rows in whole_groups(batches, "gid"):
            gids, ids = rows["gid"].to_numpy(), rows["doc_id"].to_numpy()
            a, b = [], []
            for start, end in groups(gids) if len(gids) else ():
                members: dict[tuple[int, bytes], np.ndarray] = {}
                part = rows.slice(start, end - start)
                for doc, key, text in zip(ids[start:end].tolist(), part["key"].to_pylist(), part["text"].to_pylist()):
                    found = shingle_set(hashes.of(text or b""), k)
                    if (doc, key) not in members and xxhash.xxh128_digest(found.tobytes()) == key:
                        members[doc, key] = found
                names, sets = [doc for doc, _ in members], list(members.values())
                if len(names) < 2:
                    continue
                sizes = np.array([len(s) for s in sets])
                _, dense = np.unique(np.concatenate(sets), return_inverse=True)
                starts = np.concatenate(([0], np.cumsum(sizes)))
                marked = np.zeros(dense.max() + 1, np.int64)
                known = Union(len(names))
                for i in range(len(names) - 1):
                    own = dense[starts[i] : starts[i + 1]]
                    marked[own] = 1
                    both = np.add.reduceat(marked[dense[starts[i + 1] :]], starts[i + 1 : -1] - starts[i + 1])
                    marked[own] = 0
                    near = np.flatnonzero(above * both >= below * (sizes[i] + sizes[i + 1 :] - both))
                    for j in (near + i + 1).tolist():
                        if known.join(i, j):
                            a.append(names[i])
                            b.append(names[j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _by_group(df: DataFrame) -> DataFrame:
    return df.repartition("gid").sortWithinPartitions("gid")


def _blocks(members: DataFrame, key: str, size) -> DataFrame:
    """Rows dealt into the blocks of their group: pivots go to every block, others to their own."""
    h = F.xxhash64("doc_id", key)
    n = F.col("blocks")
    pivot = (n > 1) & (F.pmod(h, size) < PIVOTS)
    own = F.array(F.pmod(F.xxhash64(h), n).cast("int"))
    every = F.sequence(F.lit(0), n.cast("int") - 1)
    return members.withColumn("pivot", pivot).withColumn("block", F.explode(F.when(pivot, every).otherwise(own))).withColumn(
        "gid", F.when(n == 1, F.col(key)).otherwise(F.xxhash64(key, "block"))
    )


def near_duplicates(
    documents: DataFrame, k: int = 3, above: int = 100, below: int = 85, recall: float = 0.9999, trees: int | None = None
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of documents (doc_id, text, ...).

    Documents are linked where above * intersection >= below * union of their k-word shingles;
    component_id is the least doc_id that links reach, and kept marks it. Words are what stands
    between ASCII blanks, with A-Z in lower case. A text of fewer than k words is one shingle.

    NULL, empty and blank texts have no shingles and are linked with nothing, not with each other.
    Rows with equal sets are one class, however many there are. A doc_id that comes several times
    is one document with all its texts; its rows share a component. A NULL doc_id links with
    nothing: component_id is NULL and kept is true. Other columns are not read. An empty table gives no rows.
    Pairs come to be compared with at least the stated recall, in nodes of any size, and links are
    confirmed on the full sets.
    """
    threshold = below / above
    trees = trees or trees_for(threshold, recall)
    least = least_for(threshold)
    texts = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("text"))
    profiles = written(
        texts.mapInArrow(_profiles(k), "doc_id bigint, n_shingles bigint, key binary, sketch binary"), "profiles"
    )
    known = profiles.filter("key IS NOT NULL AND doc_id IS NOT NULL")
    classes = written(
        known.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n_shingles")),
        "classes",
    )
    sketches = classes.select(F.col("rep").alias("doc_id"), "sketch")

    # A class's document; two classes of one repeated doc_id may stand in a node under one name.
    branched = "node bigint, doc_id bigint"
    rows = written(sketches.mapInArrow(_branch(threshold, trees), branched), "nodes")
    short = sketches.mapInArrow(_low_bytes, "doc_id bigint, bytes binary")
    nominated = []
    for level in range(LEVELS + 1):
        sizes = rows.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1")
        members = written(rows.join(sizes, "node"), "members")
        last = level == LEVELS
        dealt = members.filter(F.col("size") <= NODE).select(F.col("node").alias("gid"), "doc_id").join(short, "doc_id")
        nominated.append(_by_group(dealt.select("gid", "doc_id", "bytes")).mapInArrow(_nominate(least), "a bigint, b bigint"))
        large = members.filter(F.col("size") > NODE)
        if last or large.isEmpty():
            break
        rows = written(
            large.select("node", "doc_id").join(sketches, "doc_id").select("node", "doc_id", "sketch")
            .mapInArrow(_branch(threshold, None), branched),
            "nodes",
        )
    if last and not large.isEmpty():
        # The blocks of a large node share but a few pivots.
        large = large.select("node", "doc_id", "size", F.ceil(F.col("size") / BLOCK).alias("blocks"))
        dealt = _blocks(large, "node", F.col("size")).join(short, "doc_id").select("gid", "node", "doc_id", "pivot", "bytes")
        tried = written(_by_group(dealt).mapInArrow(_strays(least), "a bigint, b bigint, node bigint"), "tried")
        nominated.append(tried.filter("node IS NULL").select("a", "b"))
        strays = tried.filter("node IS NOT NULL").select("node", F.col("a").alias("doc_id")).distinct()
        if not strays.isEmpty():
            placed = large.drop("size")
            met = _meetings(placed, placed.join(strays, ["node", "doc_id"], "left_semi"), "node", BLOCK)
            met = _by_group(met.join(short, "doc_id").select("gid", "doc_id", "asks", "bytes"))
            nominated.append(met.mapInArrow(_nominate(least), "a bigint, b bigint"))
    edges = nominated[0]
    for more in nominated[1:]:
        edges = edges.unionByName(more)
    clusters = components(edges)

    links = _links(texts, classes, clusters, k, above, below)
    # A doc_id with several texts is one document.
    several = known.groupBy("doc_id").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low <> high")
    several = known.select("doc_id", "key").join(several.select("doc_id"), "doc_id", "left_semi").join(
        classes.select("key", "rep"), "key"
    ).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = components(links.unionByName(several))
    reached = classes.select("key", "rep").join(found, F.col("rep") == F.col("id"), "left").select(
        "key", F.coalesce("component", "rep").alias("component_id")
    )
    out = profiles.select("doc_id", "n_shingles", "key").join(reached, "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _low_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A byte of each coordinate: enough to estimate similarity, a quarter of what branching needs."""
    for batch in batches:
        if batch.num_rows:
            low = _matrix(batch.column("sketch"), np.uint32).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([r.tobytes() for r in low], pa.binary())], ["doc_id", "bytes"])


def _links(texts: DataFrame, classes: DataFrame, clusters: DataFrame, k: int, above: int, below: int) -> DataFrame:
    """Confirmed links (a, b) that join all documents of a cluster that links join."""
    schema = "a bigint, b bigint"
    members = clusters.join(classes.select(F.col("rep").alias("id"), "key", "n_shingles"), "id")
    sizes = members.groupBy("component").agg(F.count("*").alias("size"), F.sum("n_shingles").alias("weight"))
    sizes = sizes.filter("size > 1").withColumn(
        "blocks",
        F.when((F.col("size") <= NODE) & (F.col("weight") <= WEIGHT), 1)
        .otherwise(F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("weight") * 2 / WEIGHT))),
    )
    members = written(
        members.join(sizes, "component")
        .select(F.col("id").alias("doc_id"), "component", "key", "size", "blocks").join(texts, "doc_id"),
        "members",
    )
    first = _by_group(_blocks(members, "component", F.col("size")).select("gid", "doc_id", "key", "text"))
    links = written(first.mapInArrow(_confirm(k, above, below), schema), "confirmed")
    wide = members.filter("blocks > 1")
    if wide.isEmpty():
        return links
    # Whatever is outside a cluster's largest component meets all of the cluster, in chunks.
    stars = components(links)
    inside = stars.withColumnRenamed("component", "inner")
    placed = wide.join(inside, wide.doc_id == inside.id, "left").withColumn("inner", F.coalesce("inner", "doc_id"))
    placed = written(placed.select("doc_id", "component", "key", "blocks", "inner", "text"), "placed")
    met = _meetings(placed, _outside(placed, "component"), "component", PIVOTS)
    second = _by_group(met.select("gid", "doc_id", "key", "text")).mapInArrow(_confirm(k, above, below), schema)
    # What is known to be joined goes on as stars.
    return _as_links(stars).unionByName(second)


def _as_links(stars: DataFrame) -> DataFrame:
    return stars.filter("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b"))


def _outside(placed: DataFrame, group: str) -> DataFrame:
    """The rows (group, doc_id, inner, ...) that aren't in the component, inner, that has most of their group."""
    main = placed.groupBy(group, "inner").agg(F.count("*").alias("n")).groupBy(group).agg(
        F.max(F.struct("n", "inner")).getField("inner").alias("main")
    )
    return placed.join(main, group).filter("inner <> main").drop("main", "inner")


def _meetings(placed: DataFrame, outside: DataFrame, group: str, size: int) -> DataFrame:
    """Rows by gid, in which each row of outside, so many at a time, meets each row of its group, a
    block at a time; asks marks the rows of outside."""
    chunks = outside.groupBy(group).agg(F.ceil(F.count("*") / size).cast("int").alias("chunks"))
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    chunk = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("chunks")).cast("int")
    asking = outside.join(chunks, group).withColumn("chunk", chunk).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    )
    asked = placed.drop("inner").join(chunks, group).withColumn("block", block).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    )
    met = asking.withColumn("asks", F.lit(True)).unionByName(asked.withColumn("asks", F.lit(False)))
    return met.withColumn("gid", F.xxhash64(group, "block", "chunk"))
