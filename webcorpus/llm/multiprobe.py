"""Nearest vectors by inner product with multiprobe p-stable hashing.

Vectors are scaled by the greatest length and get one more component that makes all lengths 1, so
that the largest inner product is the least Euclidean distance. A table hashes a vector to a cell
of a few Gaussian projections cut at a fixed width. For a query, the projection of the difference
to a neighbour at distance d is Gaussian with deviation d, which gives each neighbouring cell its
chance of holding the neighbour; cells are visited from the likeliest on until the chances add up
to what the table owes for the target recall, however far that reaches. A query for which it would
be too many cells, or which found too few neighbours, is ranked against all rows, block by block. The distance is fitted on a bounded sample of
queries against all rows, the number of projections grows with the logarithm of the rows.

Spark deals out groups of cells, those that agree in the first projections, as many of these as
bring a group to a block's size. A query goes to a group once, with the list of the cells it visits
there. A task holds a block of a group's vectors and the queries that visit it, ranks the visited
cells exactly in double precision and keeps the nearest per query; tables are then merged. Large
groups are cut into blocks, so none is capped. The likeliest group of the first table goes ahead:
the scores found there are a border that later groups need not report below, so that a query gives
about as many rows however many blocks it visits.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.llm.common import written

SAMPLE = 48  # queries that fit the neighbour distance
VECTORS = 4096  # vectors of a block
QUERIES = 1024  # queries of a block
CELLS = 1 << 17  # cells around a query that a table weighs at most
FURTHEST = 8  # cells to either side at most: no distance of vectors of length 1 reaches further
WIDTH = 1.5  # of a cell, for vectors of length 1


def _matrix(column, dim: int | None = None) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1 if dim is None else dim)


def valid(embedding: Column) -> Column:
    """Whether a vector takes part: it has components, all finite, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


class _Tables:
    """The hash functions, the same on every executor."""

    def __init__(self, dim: int, tables: int, width: int, longest: float, distance: float, recall: float, leading: int):
        draw = np.random.default_rng(20_240_220)
        self.a = draw.standard_normal((tables, dim + 1, width))
        self.b = draw.uniform(0, WIDTH, (tables, width))
        self.longest, self.distance, self.leading = longest, distance, leading
        self.owed = 1 - (1 - recall) ** (1 / tables)
        self.width, self.steps = width, {}
        self.furthest = min(FURTHEST, max(1, (int(CELLS ** (1 / width) + 1e-9) - 1) // 2))

    def place(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Positions in units of cells, by table."""
        lengths = np.linalg.norm(x, axis=1)
        if query:
            x = np.column_stack((x / lengths[:, None], np.zeros(len(x))))
        else:
            scaled = np.minimum(lengths / self.longest, 1.0)
            x = np.column_stack((x / self.longest, np.sqrt(1 - scaled**2)))
        return (np.einsum("nd,tdm->tnm", x, self.a) + self.b[:, None, :]) / WIDTH

    @staticmethod
    def cell(table: int, cells: np.ndarray) -> np.ndarray:
        out = np.full(cells.shape[:-1], table, np.int64)
        for j in range(cells.shape[-1]):
            out = out * 4093 + cells[..., j] + 2046
        return out

    def group(self, table: int, cells: np.ndarray) -> np.ndarray:
        """The name of a cell's group."""
        return self.cell(table, cells[..., : self.leading])

    def chances(self, z: np.ndarray, reach: int) -> np.ndarray:
        """The chance of each cell up to `reach` to either side, by projection."""
        inside = z - np.floor(z)
        edges = np.stack([(e - inside) * WIDTH / self.distance for e in range(-reach, reach + 2)])
        return np.diff(0.5 * (1 + np.vectorize(math.erf, otypes=[float])(edges / math.sqrt(2))), axis=0)

    def reaches(self, z: np.ndarray) -> np.ndarray:
        """How far each query of one table has to look for the chances to reach what is owed; one
        more than `furthest` where that is too little."""
        out = np.full(len(z), self.furthest + 1)
        left = np.arange(len(z))
        for reach in range(1, self.furthest + 1):
            met = self.chances(z[left], reach).sum(axis=0).prod(axis=1) >= self.owed
            out[left[met]] = reach
            left = left[~met]
            if not len(left):
                break
        return out

    def probes(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Query numbers and cells to visit in one table, likeliest first."""
        reaches = np.minimum(self.reaches(z), self.furthest)
        found = []
        for reach in np.unique(reaches).tolist():
            if reach not in self.steps:
                self.steps[reach] = np.array(list(itertools.product(range(-reach, reach + 1), repeat=self.width)))
            steps, own = self.steps[reach], np.flatnonzero(reaches == reach)
            part = max(1, (1 << 20) // len(steps))
            for at in range(0, len(own), part):
                here = own[at : at + part]
                chance, base = self.chances(z[here], reach), np.floor(z[here])
                total = np.ones((len(here), len(steps)))
                for j in range(self.width):
                    total *= chance[steps[:, j] + reach, :, j].T
                order = np.argsort(-total, axis=1, kind="stable")
                gained = np.cumsum(np.take_along_axis(total, order, 1), axis=1)
                who, nth = np.nonzero(np.column_stack((np.ones(len(here), bool), gained[:, :-1] < self.owed)))
                found.append((here[who], (base[who] + steps[order[who, nth]]).astype(np.int64)))
        who, cells = (np.concatenate(c) for c in zip(*found))
        order = np.argsort(who, kind="stable")
        return who[order], cells[order]


def _beyond(tables: _Tables):
    """The queries for which some table cannot reach what it owes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z = tables.place(_matrix(batch.column("embedding")), query=True)
                far = np.any([tables.reaches(table) > tables.furthest for table in z], axis=0)
                yield batch.select(["vec_id"]).filter(pa.array(far))

    return run


def _index(tables: _Tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z = tables.place(_matrix(batch.column("embedding")), query=False)
                for t in range(len(z)):
                    cells = np.floor(z[t]).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tables.group(t, cells)), pa.array(tables.cell(t, cells)), *batch.columns],
                        ["group", "cell", *batch.schema.names],
                    )

    return run


def _visits(tables: _Tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z = tables.place(_matrix(batch.column("embedding")), query=True)
                for t in range(len(z)):
                    who, cells = tables.probes(z[t])
                    group, cell = tables.group(t, cells), tables.cell(t, cells)
                    likeliest = group[np.flatnonzero(np.append(True, who[1:] != who[:-1]))]
                    order = np.lexsort((cell, group, who))
                    who, group, cell = who[order], group[order], cell[order]
                    first = np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (group[1:] != group[:-1])))
                    ahead = group[first] == likeliest[who[first]] if t == 0 else np.zeros(len(first), bool)
                    rows = batch.take(pa.array(who[first]))
                    visited = pa.ListArray.from_arrays(pa.array(np.append(first, len(who)), pa.int32()), pa.array(cell))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(group[first]), visited, pa.array(ahead), *rows.columns], ["group", "cells", "ahead", *batch.schema.names]
                    )

    return run


def _rank(top: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            left = left.sort_by([("cell", "ascending"), ("vec_id", "ascending")])
            vectors, asked = _matrix(left["embedding"]), _matrix(right["embedding"])
            ids, who = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
            by_id = np.argsort(ids, kind="stable")
            firsts = np.flatnonzero(np.append(True, np.diff(ids[by_id]) != 0))
            cells, starts = np.unique(left["cell"].to_numpy(), return_index=True)
            ends = np.append(starts[1:], len(ids))
            visits = right["cells"].combine_chunks()
            borders = right["border"].to_numpy()
            for at in range(0, len(who), 128):
                part = visits.slice(at, 128)
                of = np.repeat(np.arange(len(part)), part.value_lengths().to_numpy())
                where = part.flatten().to_numpy()
                scores = np.full((len(part), len(ids)), -np.inf)
                for cell, start, end in zip(cells, starts, ends):
                    rows = of[where == cell]
                    if len(rows):
                        scores[rows, start:end] = asked[at + rows] @ vectors[start:end].T
                scores[who[at : at + 128, None] == ids[None, :]] = -np.inf
                for i, row in enumerate(scores):
                    met = np.isfinite(row) & (row >= borders[at + i])
                    if not met.any():
                        continue
                    row = np.where(met, row, -np.inf)
                    # A vec_id that comes several times counts once, with its best score.
                    once = row if len(firsts) == len(ids) else np.maximum.reduceat(row[by_id], firsts)
                    usable = int(np.isfinite(once).sum())
                    border = np.partition(once, len(once) - top)[len(once) - top] if usable > top else -np.inf
                    # A matrix product may round alike vectors differently; those near the border
                    # are measured again, one by one, before ties are told apart.
                    keep = np.flatnonzero(met & (row >= border - 1e-9 * np.abs(row[met]).max()))
                    exact = (vectors[keep] * asked[at + i]).sum(axis=1)
                    best = np.lexsort((ids[keep], -exact))
                    best = best[np.sort(np.unique(ids[keep][best], return_index=True)[1])][:top]
                    out.append((np.full(len(best), who[at + i]), ids[keep][best], exact[best]))
        if not out:
            return schema.empty_table()
        return pa.table([np.concatenate(c) for c in zip(*out)], schema=schema)

    return run


def _sampled(sample: np.ndarray, sample_ids: np.ndarray, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(sample), top), -np.inf)
        for batch in batches:
            if batch.num_rows:
                scores = sample @ _matrix(batch.column("embedding")).T
                scores[sample_ids[:, None] == batch.column("vec_id").to_numpy()[None, :]] = -np.inf
                best = -np.sort(-np.column_stack((best, scores)), axis=1)[:, :top]
        who, rank = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(best[who, rank])], ["who", "score"])

    return run


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, top: int = 20, recall: float = 0.95, tables: int = 3
) -> DataFrame:
    """(query_id, rank, vec_id, score): the top nearest rows of vectors for every row of queries.

    Both have vec_id and embedding (an array of numbers of one length); nearness is the largest
    inner product in double precision, ties go to the smaller vec_id, a query's own vec_id is no
    candidate. Vectors that are NULL, empty or zero or hold NULL or non-finite components take no
    part, nor do NULL ids or vectors of another length than most have. A vec_id that comes
    several times counts once per query, with its best score; fewer candidates than asked for
    are all returned. Other columns are not read. Tables without
    valid vectors give no rows.
    """
    spark = vectors.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    pick = lambda df: df.select(F.col("vec_id").cast("bigint"), "embedding").filter(
        F.col("vec_id").isNotNull() & valid(F.col("embedding"))
    ).withColumn("embedding", F.col("embedding").cast("array<double>"))
    vectors, queries = pick(vectors), pick(queries)
    squared = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    shapes = vectors.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n"), F.max(squared).alias("sq"))
    shape = shapes.orderBy(F.desc("n"), "dim").first()
    if shape is None:
        return spark.createDataFrame([], schema)
    dim, n, longest = shape["dim"], shape["n"], math.sqrt(shape["sq"])
    same = F.size("embedding") == dim
    vectors, queries = vectors.filter(same).dropDuplicates(["vec_id", "embedding"]), queries.filter(same)
    vectors = written(vectors, "vectors")

    sample = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    if not sample:
        return spark.createDataFrame([], schema)
    asked = np.array([r["embedding"] for r in sample])
    found = vectors.mapInArrow(_sampled(asked, np.array([r["vec_id"] for r in sample]), top), "who bigint, score double")
    last = found.withColumn("rank", F.row_number().over(Window.partitionBy("who").orderBy(F.desc("score")))).filter(
        F.col("rank") == top
    ).collect()
    cosines = sorted(r["score"] / np.linalg.norm(asked[r["who"]]) / longest for r in last) or [-1.0]
    distance = math.sqrt(max(2 - 2 * cosines[len(cosines) // 4], 1e-4))  # a far one among the sample's
    width = max(1, min(6, round(math.log2(max(n, 2)) / 4)))
    # A projection has about five cells that hold vectors.
    leading = min(width, max(1, math.ceil(math.log(max(n / VECTORS, 1), 5))))
    hashing = _Tables(dim, tables, width, longest, distance, recall, leading)

    cells = vectors.mapInArrow(_index(hashing), "group bigint, cell bigint, vec_id bigint, embedding array<double>")
    visits = queries.mapInArrow(_visits(hashing), "group bigint, cells array<bigint>, ahead boolean, vec_id bigint, embedding array<double>")
    count = lambda df, name, block: df.groupBy("group").agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    h = lambda n: F.pmod(F.xxhash64("vec_id", "embedding"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def ranked(cells: DataFrame, visits: DataFrame) -> DataFrame:
        deal = written(count(cells, "nv", VECTORS).join(count(visits, "nq", QUERIES), "group"), "groups")
        left = cells.join(deal, "group").withColumn("v", h("nv")).withColumn("q", every("nq")).select("group", "v", "q", "cell", "vec_id", "embedding")
        right = visits.join(deal, "group").withColumn("q", h("nq")).withColumn("v", every("nv")).select(
            "group", "v", "q", "cells", "vec_id", "embedding", "border"
        )
        found = left.groupBy("group", "v", "q").cogroup(right.groupBy("group", "v", "q")).applyInArrow(
            _rank(top), "query_id bigint, vec_id bigint, score double"
        )
        merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    lowest = F.lit(float("-inf"))
    early = ranked(cells, visits.filter("ahead").withColumn("border", lowest))
    # A little lower, since a matrix product rounds differently.
    borders = written(
        early.filter(F.col("rank") == top).select(F.col("query_id").alias("vec_id"), (F.col("score") - (F.abs("score") * 1e-9 + 1e-12 * longest**2)).alias("border")), "borders"
    )
    result = lambda df: df.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    found = written(result(ranked(cells, visits.join(borders, "vec_id", "left").withColumn("border", F.coalesce("border", lowest)))), "found")

    # Queries that the cells serve too little meet all rows, block by block.
    enough = min(top, vectors.select("vec_id").distinct().count())
    served = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n")).filter(F.col("n") >= enough).select("vec_id")
    short = queries.select("vec_id").join(served, "vec_id", "left_anti").unionByName(queries.mapInArrow(_beyond(hashing), "vec_id bigint"))
    short = written(short.distinct(), "short")
    if short.isEmpty():
        return found
    one = F.lit(0).cast("bigint")
    everything = vectors.select(one.alias("group"), one.alias("cell"), "vec_id", "embedding")
    asking = queries.join(short, "vec_id", "left_semi").select(one.alias("group"), F.array(one).alias("cells"), "vec_id", "embedding", lowest.alias("border"))
    return found.join(short, found.query_id == short.vec_id, "left_anti").unionByName(result(ranked(everything, asking)))
