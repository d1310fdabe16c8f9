"""Benchmark decontamination: a BM25 index of test items, queried by every passage.

The terms are pairs of neighbouring words. An item's weight for a term is its BM25 weight as a
share of what the item scores against itself, so that a score says how much of the item a passage
holds and one threshold serves all items. Every passage of every document is a query. Block-max
WAND retrieves all items above the threshold: posting lists are cut into blocks that keep their
greatest weight, the cursors move by item number, and a candidate is scored only where the block
weights of its terms can reach the threshold. A passage whose terms' greatest weights don't reach
it together has no pivot and ends there. What is retrieved is verified in windows of twice the
item's own length (PASSAGE words at least), which the other items don't change: one must score the
threshold and hold the question and the answer.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K1, B = 1.2, 0.75  # fixed values: the usual BM25 parameters
BLOCK = 64  # postings of a block
PASSAGE = 128  # words of an item's window at least; half of it is the step
ITEMS = 20_000  # items of one index; more items are several indexes

_TABLE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def normalised(text: str | None) -> list[bytes]:
    """Lower-case words; ASCII signs are blanks."""
    return (text or "").lower().encode().translate(_TABLE).split()


def question_and_answer(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """The words up to the last sentence and those of the last one; of one sentence, its halves."""
    ends = [i + 1 for i, c in enumerate(text or "") if c in ".?!\n"]
    for end in reversed(ends):
        question, answer = normalised(text[:end]), normalised(text[end:])
        if question and len(answer) >= 3:
            return question, answer
    found = normalised(text)
    half = (len(found) + 1) // 2
    return found[:half], found[half:]


class Index:
    """Items (item_id, text) with the statistics of all items."""

    def __init__(self, items: list[tuple[int, str]], n_items: int, mean: float, frequency: dict[tuple[bytes, bytes], int]):
        self.items = [(item_id, *question_and_answer(text)) for item_id, text in items]
        self.words: dict[bytes, int] = {}
        docs = [normalised(text) for _, text in items]
        for doc in docs:
            for word in doc:
                self.words.setdefault(word, len(self.words))
        # An item is looked for in windows of its own size, whatever the other items are.
        self.windows = [max(PASSAGE, 2 * len(doc)) for doc in docs]
        size = len(self.words)
        self.postings: dict[int, list[tuple[int, float]]] = {}
        for i, doc in enumerate(docs):
            counts = Counter(zip(doc, doc[1:]))
            length = max(len(doc) - 1, 1)
            weights = {}
            for pair, tf in counts.items():
                df = frequency.get(pair, 1)
                idf = math.log(1 + (n_items - df + 0.5) / (df + 0.5))
                weights[pair] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / max(mean, 1)))
            whole = sum(weights.values())
            for (a, b), weight in weights.items():
                self.postings.setdefault(self.words[a] * size + self.words[b], []).append((i, weight / whole))
        self.codes = np.array(sorted(self.postings), np.int64)
        self.lists = [self.postings[c] for c in self.codes.tolist()]
        self.weights: list[dict[int, float]] = [{} for _ in docs]
        for t, found in enumerate(self.lists):
            for i, weight in found:
                self.weights[i][t] = weight
        self.numbers = [[i for i, _ in p] for p in self.lists]
        self.blocks = [
            [(p[min(s + BLOCK, len(p)) - 1][0], max(w for _, w in p[s : s + BLOCK])) for s in range(0, len(p), BLOCK)] for p in self.lists
        ]
        self.lasts = [[last for last, _ in b] for b in self.blocks]
        self.most = np.array([max(w for _, w in b) for b in self.blocks] + [0.0])
        del self.postings
        self.size = size

    def terms(self, found: list[bytes]) -> np.ndarray:
        """The term at each word and its follower; the number past the last term where there is none."""
        none = len(self.codes)
        if len(found) < 2 or not none:
            return np.full(max(len(found) - 1, 0), none, np.int64)
        get = self.words.get
        ids = np.fromiter((get(w, -1) for w in found), np.int64, len(found))
        out = np.full(len(ids) - 1, none, np.int64)
        both = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        codes = ids[both] * self.size + ids[both + 1]
        at = np.minimum(np.searchsorted(self.codes, codes), none - 1)
        hit = self.codes[at] == codes
        out[both[hit]] = at[hit]
        return out

    def retrieve(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items that score the threshold against the set of terms, by block-max WAND."""
        cursors = [(self.numbers[t][0], t, 0) for t in terms]
        found = []
        while cursors:
            # The pivot: the first item at which the greatest weights so far reach the threshold.
            cursors.sort()
            total, pivot = 0.0, None
            for item, t, _ in cursors:
                total += self.most[t]
                if total >= threshold - 1e-9:
                    pivot = item
                    break
            if pivot is None:
                break
            upto = [c for c in cursors if c[0] <= pivot]
            bound, end = 0.0, None
            for _, t, _ in upto:
                b = bisect_left(self.lasts[t], pivot)
                if b < len(self.lasts[t]):
                    bound += self.blocks[t][b][1]
                    end = self.lasts[t][b] if end is None else min(end, self.lasts[t][b])
            if bound >= threshold - 1e-9:
                target, score = pivot, 0.0
                for _, t, _ in upto:
                    at = bisect_left(self.numbers[t], pivot)
                    if at < len(self.numbers[t]) and self.numbers[t][at] == pivot:
                        score += self.lists[t][at][1]
                if score >= threshold - 1e-9:
                    found.append((pivot, score))
            else:
                # No item up to the end of these blocks, or up to the next cursor, can do it.
                after = [c[0] for c in cursors if c[0] > pivot]
                target = max(pivot, min([end if end is not None else pivot, *(a - 1 for a in after)]))
            moved = []
            for item, t, at in cursors:
                if item <= target:
                    at = bisect_left(self.numbers[t], target + 1, at)
                    if at == len(self.numbers[t]):
                        continue
                    item = self.numbers[t][at]
                moved.append((item, t, at))
            cursors = moved
        return found


def overlap(part: list[bytes], passage: list[bytes]) -> float:
    """The share of the neighbouring pairs of a part that a passage holds; of its words for a single one."""
    if len(part) < 2:
        return float(bool(part) and part[0] in set(passage)) if part else 1.0
    want, have = Counter(zip(part, part[1:])), Counter(zip(passage, passage[1:]))
    return sum((want & have).values()) / sum(want.values())


def _search(model, threshold: float, question: float, answer: float):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("item_id", pa.int64()), ("passage", pa.int64()), ("score", pa.float64()),
        ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = model.value
        # A passage holds all windows that begin in its first half.
        step = max(index.windows, default=PASSAGE)
        size, none = 2 * step, len(index.codes)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = normalised(text)
                terms = index.terms(found)
                if not len(terms):
                    continue
                # What the terms of each passage can bring at most, by running sums.
                sums = np.concatenate(([0.0], np.cumsum(index.most[terms])))
                starts = np.arange(0, len(found), step)
                reach = sums[np.minimum(starts + size - 1, len(terms))] - sums[starts]
                for start in starts[reach >= threshold - 1e-9].tolist():
                    own = sorted(set(terms[start : start + size - 1].tolist()) - {none})
                    for i, _ in index.retrieve(own, threshold):
                        item_id, q, a = index.items[i]
                        weights, wide = index.weights[i], index.windows[i]
                        brings = np.cumsum([0.0, *(weights.get(t, 0.0) for t in terms[start : start + step + wide].tolist())])
                        half = wide // 2
                        upto = min(start + step, max(len(found) - half, 1))
                        places = np.arange(-(-start // half) * half, upto, half)
                        ends = np.minimum(places - start + wide - 1, len(brings) - 1)
                        for at in places[brings[ends] - brings[places - start] >= threshold - 1e-9].tolist():
                            score = sum(weights.get(t, 0.0) for t in set(terms[at : at + wide - 1].tolist()))
                            window = found[at : at + wide]
                            of_q, of_a = overlap(q, window), overlap(a, window)
                            if score >= threshold - 1e-9 and of_q >= question and of_a >= answer:
                                rows.append((doc_id, item_id, at, score, of_q, of_a))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)

    return run


def find_leaks(
    documents: DataFrame, benchmark: DataFrame, threshold: float = 0.6, question: float = 0.6, answer: float = 0.6
) -> DataFrame:
    """(doc_id, item_id, passage, score, question_overlap, answer_overlap): the best passage for each
    document and test item that it holds.

    documents has doc_id and text, benchmark item_id and text. passage is the number of the
    passage's first word, score the share of the item's BM25 weight found in it (1 is all). NULL
    and empty texts match nothing, nor do items of fewer than two words. Items with equal texts are
    all reported. An item_id that comes several times stands for all its texts, NULL ids for
    themselves; rows that repeat a document are one. Ties go to the first passage. Other columns
    are not read; empty tables give no rows.

    The benchmark is dealt by a hash into indexes of about ITEMS items, and each document is
    queried against each; one index at a time is copied to the executors, so the copy is bounded.
    """
    spark = documents.sparkSession
    items = benchmark.filter(F.col("text").isNotNull()).select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    texts = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            df, total = Counter(), 0
            for text in batch.column("text").to_pylist():
                found = normalised(text)
                total += max(len(found) - 1, 0)
                df.update(set(zip(found, found[1:])))
            keys = [*df, (b"", b"")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in keys], pa.binary()), pa.array([b for _, b in keys], pa.binary()), pa.array([*df.values(), total], pa.int64())],
                ["a", "b", "n"],
            )

    statistics = items.select("text").mapInArrow(pairs, "a binary, b binary, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))
    n_items = items.count()
    schema = "doc_id bigint, item_id bigint, passage bigint, score double, question_overlap double, answer_overlap double"
    shards = max(1, -(-n_items // ITEMS))
    found = spark.createDataFrame([], schema)
    for shard in range(shards):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard).orderBy("item_id", "text")
        rows = [(r["item_id"], r["text"]) for r in own.collect()]
        # Only the statistics of this index's terms are fetched.
        wanted = own.select("text").mapInArrow(pairs, "a binary, b binary, n bigint").select("a", "b").distinct()
        frequency = {(bytes(r["a"]), bytes(r["b"])): r["n"] for r in statistics.join(wanted, ["a", "b"], "left_semi").collect()}
        mean = frequency.pop((b"", b""), 0) / max(n_items, 1)
        model = spark.sparkContext.broadcast(Index(rows, n_items, mean, frequency))
        found = found.unionByName(texts.mapInArrow(_search(model, threshold, question, answer), schema))
    best = F.max(F.struct("score", (-F.col("passage")).alias("before"), "question_overlap", "answer_overlap")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("best.before")).alias("passage"), "best.score", "best.question_overlap", "best.answer_overlap"
    )
