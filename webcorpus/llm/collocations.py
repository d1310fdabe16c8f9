"""Phrases whose words belong together, from a weighted de Bruijn graph of the corpus.

Only the longest runs are counted: from every word on, the run of ``longest`` words, an edge between
the nodes that are its first and its last words but one, or, near the end of a piece, the shorter run
that is left. Paths of nodes with one way in, one way out and no end or start of a piece carry one
weight and are compacted. All shorter counts follow from the graph: a node occurs as often as edges
leave it and pieces end in it, and a shorter run as often as the runs that it opens, and the ends.

A phrase that is frequent holds frequent words and shorter runs only, so a run ends before the first
word or run, up to the nodes' length, that is not. Which are, is read from counts in a fixed number of hashed places, of bounded
size: a place that is shared can only let more text through, so no count changes by it. A task hands
its counts on as far as they matter, up to the threshold.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.llm.common import ODD, WordHashes, mix, written

PLACES = 26  # bits of a hashed place: 64 MB of counts in a task, 8 MB to each; raise it with the corpus
CELL = 16  # bits of the places whose counts travel together
WORDS = 200_000  # words taken at a time
COUNTED = 300_000  # distinct runs that a task counts before it hands them on
ROWS = 50_000  # rows of a batch that is handed on
CELLS = 4096  # parts of the runs, by hash, that travel and are added up together
HEAVY = 2000  # parts with over one in this many of all words are joined by broadcast
LANGUAGES = 1 << 16  # totals by language are broadcast up to this many

# A piece ends at these bytes.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes.maketrans(_ENDS, b"\n" * len(_ENDS))


class _Part:
    """Words of whole pieces: their hashes in their language, the language's number, and whether the
    word ends a piece."""

    def __init__(self, found: list[bytes], sizes: list[int], codes: list[int], hashes: WordHashes, names: list[str]):
        self.words = found
        self.lang = np.repeat(np.array(codes, np.int64), sizes)
        own = np.array([xxhash.xxh64_intdigest(name.encode()) for name in names], np.uint64)
        self.hash = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found)) ^ own[self.lang]
        self.ends = np.zeros(len(found), bool)
        self.ends[np.cumsum(sizes) - 1] = True


def _parts(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[_Part]:
    """The batch rows (lang, text) as parts; names gets the languages, numbered as they come."""
    hashes, codes = WordHashes(), {}
    found, sizes, langs = [], [], []
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            if lang not in codes:
                codes[lang] = len(names)
                names.append(lang)
            code = codes[lang]
            for piece in (text.as_py() or b"").lower().translate(_TABLE).split(b"\n"):
                got = piece.split()
                if got:
                    found += got
                    sizes.append(len(got))
                    langs.append(code)
                    if len(found) >= WORDS:
                        yield _Part(found, sizes, langs, hashes, names)
                        found, sizes, langs = [], [], []
    if found:
        yield _Part(found, sizes, langs, hashes, names)


def _gram_places(part: _Part, m: int, bits: int) -> np.ndarray:
    """The place of the m words from each word on; the last m - 1 have none."""
    n = max(len(part.hash) - m + 1, 0)
    gram = part.hash[:n]
    for j in range(1, m):
        gram = gram * ODD + part.hash[j : j + n]
    return (mix(gram) >> np.uint64(64 - bits)).astype(np.int64)


class _Checks:
    """The sets of frequent places for runs of 1, 2, ... words, as bits."""

    def __init__(self, broadcasts: list, bits: int):
        self.sets, self.bits = [np.frombuffer(b.value, np.uint8) for b in broadcasts], bits

    def passed(self, part: _Part) -> list[np.ndarray]:
        """For each length that is checked: whether the run from each word on is inside a piece and it
        and all that it holds are in frequent places."""
        out: list[np.ndarray] = []
        for m, known in enumerate(self.sets, 1):
            # Only what can pass is looked up: far from all, for longer runs.
            good = self.open(part, out)
            places = _gram_places(part, m, self.bits)
            at = np.flatnonzero(good[: len(places)])
            there = places[at]
            good[:] = False
            good[at] = known[there >> 3] >> (there & 7).astype(np.uint8) & 1 == 1
            out.append(good)
        return out

    @staticmethod
    def open(part: _Part, passed: list[np.ndarray]) -> np.ndarray:
        """Where a run of one word more can pass, after those of the lengths before it."""
        if not passed:
            return np.ones(len(part.hash), bool)
        held = np.append(passed[-1][1:], False) & passed[-1]
        return held & ~part.ends if len(passed) == 1 else held


def _batches(columns: dict[str, list | np.ndarray], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows = len(next(iter(columns.values())))
    for low in range(0, rows, ROWS):
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name][low : low + ROWS], f.type) for f in schema], schema=schema
        )


_PLACED = pa.schema([("lang", pa.string()), ("total", pa.int64()), ("cell", pa.int32()), ("places", pa.binary()), ("counts", pa.binary())])
PLACED = "lang string, total bigint, cell int, places binary, counts binary"


def _width(least: int) -> tuple[int, type]:
    """Counts beyond the threshold say no more than it; a threshold beyond two bytes is taken lower
    here, which lets more through."""
    return min(least, 0xFFFF), np.uint8 if least <= 0xFF else np.uint16


def _count_places(m: int, bits: int, least: int, broadcasts: list):
    """How often runs of m words come, by place; with m = 1 also the number of words by language."""
    enough, kind = _width(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        checks, counts, totals = _Checks(broadcasts, bits), np.zeros(1 << bits, kind), Counter()
        for part in _parts(batches, names):
            open_ = checks.open(part, checks.passed(part))
            places = _gram_places(part, m, bits)
            places, n = np.unique(places[open_[: len(places)]], return_counts=True)
            counts[places] = np.minimum(counts[places] + n, enough)
            if m == 1:
                for code, n in zip(*np.unique(part.lang, return_counts=True)):
                    totals[names[code]] += int(n)
        if totals:
            yield pa.RecordBatch.from_pylist([{"lang": lang, "total": n} for lang, n in totals.items()], schema=_PLACED)
        rows = []
        for cell in range(max(1 << bits >> CELL, 1)):
            own = counts[cell << CELL : cell + 1 << CELL]
            places = np.flatnonzero(own)
            if len(places):
                rows.append({"cell": cell, "places": places.astype("<u2").tobytes(), "counts": own[places].tobytes()})
            if len(rows) >= 64:
                yield pa.RecordBatch.from_pylist(rows, schema=_PLACED)
                rows = []
        yield pa.RecordBatch.from_pylist(rows, schema=_PLACED)

    return run


def _sum_places(bits: int, least: int):
    """Counts of a cell from all tasks -> the bits of its frequent places."""
    enough, kind = _width(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for cell, places, counts in zip(*(batch.column(c).to_pylist() for c in ("cell", "places", "counts"))):
                held = sums.setdefault(cell, np.zeros(1 << min(CELL, bits), np.uint16))
                at = np.frombuffer(places, "<u2")
                held[at] = np.minimum(held[at].astype(np.uint32) + np.frombuffer(counts, kind), enough)
        for cell, held in sums.items():
            made = np.packbits(held >= enough, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), pa.array([made], pa.binary())], ["cell", "bits"])

    return run


_BLOCKS = pa.schema([("cell", pa.int32()), ("lang", pa.string()), ("runs", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))])
_RUNS = pa.schema([("lang", pa.string()), ("run", pa.binary()), ("words", pa.int64()), ("n", pa.int64())])


def _count_runs(bits: int, longest: int, broadcasts: list):
    """From each frequent word on the run of longest words, or of as many as pass the checks."""

    def handed(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        """The counts as a row for each cell and language."""
        for lang, own in counts.items():
            cells: dict[int, list[bytes]] = {}
            for found in own:
                cells.setdefault(xxhash.xxh32_intdigest(found) % CELLS, []).append(found)
            for low in range(0, CELLS, 256):
                here = [cell for cell in range(low, low + 256) if cell in cells]
                columns = [here, [lang] * len(here), [cells[c] for c in here], [[own[r] for r in cells[c]] for c in here]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BLOCKS)], schema=_BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        counts: dict[str, Counter] = {}
        checks = _Checks(broadcasts, bits)
        for part in _parts(batches, names):
            passed = checks.passed(part)
            size = sum(p.astype(np.int64) for p in passed)
            # A longer run is a chain of the longest runs that are checked.
            chain = passed[-1]
            onward = chain & ~part.ends if len(passed) == 1 else chain
            for _ in range(len(passed), longest):
                chain = onward & np.append(chain[1:], False)
                size += chain
            line = b" ".join(part.words)
            lengths = np.fromiter(map(len, part.words), np.int64, len(part.words))
            ends = np.cumsum(lengths + 1) - 1
            starts = ends - lengths
            for code in np.unique(part.lang).tolist():
                own = counts.setdefault(names[code], Counter())
                mine = part.lang == code
                own.update([part.words[i] for i in np.flatnonzero(mine & (size == 1)).tolist()])
                at = np.flatnonzero(mine & (size > 1))
                own.update([line[a:b] for a, b in zip(starts[at].tolist(), ends[at + size[at] - 1].tolist())])
            if sum(map(len, counts.values())) > COUNTED:
                yield from handed(counts)
                counts = {}
        yield from handed(counts)

    return run


def _add_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by cell -> every run of the corpus once, with its count."""

    def summed(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, own in counts.items():
            runs = list(own)
            words = [run.count(b" ") + 1 for run in runs]
            yield from _batches({"lang": [lang] * len(runs), "run": runs, "words": words, "n": list(own.values())}, _RUNS)

    at, counts = None, {}
    for batch in batches:
        for cell, lang, runs, n in zip(*(batch.column(c).to_pylist() for c in ("cell", "lang", "runs", "counts"))):
            if cell != at:
                yield from summed(counts)
                at, counts = cell, {}
            own = counts.setdefault(lang, Counter())
            for found, more in zip(runs, n):
                own[found] += more
    yield from summed(counts)


def _frequent_places(counts: DataFrame, least: int, bits: int):
    """The places with at least ``least``, as a broadcast bit set of 2 ** bits bits."""
    cells = counts.filter("cell IS NOT NULL").select("cell", "places", "counts").repartition("cell")
    out = np.zeros(max(1 << bits >> 3, 1), np.uint8)
    size = max(1 << min(CELL, bits) >> 3, 1)
    for cell, made in cells.mapInArrow(_sum_places(bits, least), "cell int, bits binary").collect():  # 2 ** bits bits in all
        out[cell * size : (cell + 1) * size] = np.frombuffer(made, np.uint8)
    return counts.sparkSession.sparkContext.broadcast(out.tobytes())


def _first(run: Column, n) -> Column:
    return F.call_function("substring_index", run, F.lit(" "), F.lit(n) if isinstance(n, int) else n)


def _last(run: Column, n) -> Column:
    return F.call_function("substring_index", run, F.lit(" "), -F.lit(n) if isinstance(n, int) else -n)


def compact(edges: DataFrame, ends: DataFrame, longest: int) -> DataFrame:
    """Edges (lang, run, n) -> paths (lang, words, n) over nodes with one way in and one out.

    words are the path's words in order; an edge that no such node touches is a path of its own. ends
    (lang, run, n) are the pieces that end in a node. A path is no longer than the longest piece:
    no piece starts or ends inside it.
    """
    size = longest - 1
    run, none = F.col("run"), F.lit(None).cast("string")
    count = lambda c: F.lit(c).cast("bigint")
    touched = (
        edges.select("lang", _first(run, size).alias("node"), F.col("n").alias("out"), count(1).alias("outs"), count(0).alias("into"), count(0).alias("ins"), run.alias("after"), none.alias("before"))
        .unionByName(edges.select("lang", _last(run, size).alias("node"), count(0).alias("out"), count(0).alias("outs"), F.col("n").alias("into"), count(1).alias("ins"), none.alias("after"), run.alias("before")))
        # Two ways out are more than one: a node where pieces end isn't passed through.
        .unionByName(ends.select("lang", run.alias("node"), F.col("n").alias("out"), count(2).alias("outs"), count(0).alias("into"), count(0).alias("ins"), none.alias("after"), none.alias("before")))
    )
    nodes = touched.groupBy("lang", "node").agg(
        *[F.sum(c).alias(c) for c in ("out", "outs", "into", "ins")], F.max("after").alias("after"), F.max("before").alias("before")
    )
    passed = nodes.filter("outs = 1 AND ins = 1 AND out = into")
    # Each edge behind such a node points at the edge before it; doubling leads to the path's first.
    places = written(passed.select("lang", F.col("after").alias("run"), F.col("before").alias("root"), F.lit(1).alias("step")), "path-links")
    while not places.isEmpty():
        onward = places.select("lang", F.col("run").alias("root"), F.col("root").alias("further"), F.col("step").alias("more"))
        places = written(
            places.select("lang", "run", "root", "step").join(onward, ["lang", "root"], "left").select(
                "lang", "run", F.coalesce("further", "root").alias("root"),
                (F.col("step") + F.coalesce("more", F.lit(0))).alias("step"), F.col("further").isNotNull().alias("moved"),
            ),
            "path-links",
        )
        if places.filter("moved").isEmpty():
            break
    behind = places.groupBy("lang", F.col("root").alias("run")).agg(
        F.sort_array(F.collect_list(F.struct("step", _last(run, 1).alias("word")))).alias("behind")
    )
    firsts = edges.join(places.select("lang", "run"), ["lang", "run"], "left_anti")
    rest = F.coalesce(F.transform("behind", lambda x: x["word"]), F.array().cast("array<string>"))
    return firsts.join(behind, ["lang", "run"], "left").select("lang", F.concat(F.split(run, " "), rest).alias("words"), "n")


def _windows(paths: DataFrame, size: int, first: int, spare: int) -> DataFrame:
    """Runs of size words of each path, from the first position on, ``spare`` words left behind the last."""
    last = F.size("words") - size - spare
    made = F.transform(F.sequence(F.lit(first), last), lambda i: F.array_join(F.slice("words", i + 1, size), " "))
    return paths.filter(last >= first).select("lang", F.explode(made).alias("run"), "n")


def run_counts(documents: DataFrame, least: int, longest: int, bits: int = PLACES) -> tuple[DataFrame, DataFrame]:
    """How often every run of up to ``longest`` words that comes ``least`` times comes: (lang, run,
    words, n); and the number of words by language (lang, total)."""
    texts = documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text")
    )
    counted = written(texts.mapInArrow(_count_places(1, bits, least, []), PLACED), "word-places")
    totals = written(counted.filter("lang IS NOT NULL").groupBy("lang").agg(F.sum("total").alias("total")), "language-totals")
    frequent = [_frequent_places(counted, least, bits)]
    for m in range(2, longest):
        frequent.append(_frequent_places(texts.mapInArrow(_count_places(m, bits, least, list(frequent)), PLACED), least, bits))
    blocks = texts.mapInArrow(_count_runs(bits, longest, frequent), "cell int, lang string, runs array<binary>, counts array<bigint>")
    dealt = blocks.repartition("cell").sortWithinPartitions("cell")
    runs = dealt.mapInArrow(_add_runs, "lang string, run binary, words bigint, n bigint")
    graph = written(runs.select("lang", F.col("run").cast("string").alias("run"), "words", "n"), "runs")
    edges = graph.filter(F.col("words") == longest).select("lang", "run", "n")
    ends = {m: graph.filter(F.col("words") == m).select("lang", "run", "n") for m in range(1, longest)}

    paths = written(compact(edges, ends[longest - 1], longest), "paths")
    summed = lambda rows: rows.groupBy("lang", "run").agg(F.sum("n").alias("n"))
    # Inside a path a node comes as often as the path; its first node as often as paths open from it.
    opens = paths.select("lang", F.array_join(F.slice("words", 1, longest - 1), " ").alias("run"), "n")
    flow = _windows(paths, longest - 1, 1, 1).unionByName(summed(opens.unionByName(ends[longest - 1])))
    counts = [_windows(paths.filter(F.col("n") >= least), longest, 0, 0).withColumn("words", F.lit(longest))]
    for m in range(longest - 1, 0, -1):
        flow = written(flow, f"flow-{m}")
        counts.append(flow.filter(F.col("n") >= least).withColumn("words", F.lit(m)))
        if m > 1:
            flow = summed(flow.select("lang", _first(F.col("run"), m - 1).alias("run"), "n").unionByName(ends[m - 1]))
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return written(out, "run-counts"), totals


def _looked_up(rows: DataFrame, part: str, name: str, counts: DataFrame, heavy: Column) -> DataFrame:
    """Rows with the count of a part. Parts that open or close very many phrases are broadcast."""
    known = counts.select("lang", F.col("run").alias(part), F.col("n").alias(name), heavy.alias("_heavy"))
    keys = ["lang", part]
    met = rows.join(F.broadcast(known.filter("_heavy").drop("_heavy")), keys, "left")
    rest = met.filter(F.col(name).isNull()).drop(name).join(known.filter("NOT _heavy").drop("_heavy"), keys)
    return met.filter(F.col(name).isNotNull()).unionByName(rest)


def exact(value: Column) -> Column:
    return value.cast("decimal(19,0)")


def phrases(documents: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, bits: int = PLACES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` phrases.

    documents has text and lang; a NULL text is empty, a NULL lang is ``und``; whole texts count,
    however long, and repeated rows each. Words stand between blanks and tabs inside the pieces that
    ``.,;:!?`` and line ends cut, with A-Z in lower case. A phrase has 2 to ``longest`` words and comes
    a >= least times. Cut after k words, its parts come l and r times, and the score is
    floor(1000 a n / (l r)) with n words in the language; its least cut counts, the shorter first part
    among equals. A phrase that always stands inside one longer phrase is left out. Rank follows the score, then a, then the phrase.
    Other columns are not read; an empty table gives no rows.
    """
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    counts, totals = run_counts(documents, least, longest, bits)
    words, languages = totals.agg(F.sum("total"), F.count("*")).first()
    found = counts.filter("words > 1").select("lang", F.col("run").alias("phrase"), "words", F.col("n").alias("a"))

    # What stands inside a longer phrase every time does so inside one that is one word longer.
    whole = F.col("phrase")
    inner = F.explode(F.array(_first(whole, F.col("words") - 1), _last(whole, F.col("words") - 1)))
    longer = found.filter("words > 2").select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    open_ = found.join(longer, ["lang", "phrase"], "left").filter("most IS NULL OR most < a").drop("most")

    cuts = open_.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words").cast("int") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", _first(whole, F.col("k")).alias("first"), _last(whole, F.col("words").cast("int") - F.col("k")).alias("rest")
    )
    # Runs of one length share out at most all words, so few have a large part of them.
    heavy = F.col("n") > (words or 0) // HEAVY
    cuts = _looked_up(written(cuts, "phrase-cuts"), "first", "l", counts, heavy)
    cuts = _looked_up(cuts, "rest", "r", counts, heavy)
    cuts = cuts.join(F.broadcast(totals) if languages <= LANGUAGES else totals, "lang")
    scored = cuts.withColumn("above", exact(F.col("a") * 1000) * exact(F.col("total"))).withColumn(
        "below", exact(F.col("l")) * exact(F.col("r"))
    ).withColumn("score", F.expr("above div below"))
    best = scored.groupBy("lang", "phrase", "a", "total").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score").withColumn(
        "rank", F.row_number().over(order)
    )
    return ranked.filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
