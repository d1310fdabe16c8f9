"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

The terms are words and word beginnings whose frequency differs between toxic and other labelled
examples, by a two-sample test; document frequencies are counted over all documents. A text's
vector is matched against a block-max inverted index of the examples: each block of examples keeps
the greatest weight of each term, which bounds any cosine inside; blocks are opened in order of
that bound until no unopened one can reach the k-th best. Neighbours vote by cosine, and an
isotonic curve over left-out votes of the examples turns votes into probabilities.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import written

PER_LABEL = 6000  # examples of each label at most
TERMS = 4096  # terms at most
SIGNIFICANT = 6.0  # deviations from equal frequency that select a term
NEIGHBOURS = 16
BLOCK = 64

_WORD = re.compile(r"\w+")
_STARTS = (5, 6, 7)


def terms_of(word: str) -> tuple[str, ...]:
    """The word, and its beginnings marked by a trailing star."""
    return (word, *(f"{word[:n]}*" for n in _STARTS if len(word) > n))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Examples with each term, by label; counted per batch before anything moves."""
    for batch in batches:
        found: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = set(_WORD.findall((text or "").lower()))
            found[toxic].update({t for w in words for t in terms_of(w)})
        names = list(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([found[y][t] for t in names], pa.int64()) for y in (0, 1))],
            ["term", "clean", "toxic"],
        )


class _Vocabulary(dict):
    """Term numbers of a word, remembered for a bounded number of words."""

    def __init__(self, terms: dict[str, int]):
        super().__init__()
        self.terms = terms

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = tuple(self.terms[t] for t in terms_of(word) if t in self.terms)
        return value


def _vectors(terms: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _Vocabulary(terms)
        for batch in batches:
            out_terms, out_counts = [], []
            for text in batch.column("text").to_pylist():
                seen = Counter(t for found in map(vocabulary.__getitem__, _WORD.findall((text or "").lower())) if found for t in found)
                order = sorted(seen)
                out_terms.append(order)
                out_counts.append([seen[t] for t in order])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out_terms, pa.list_(pa.int32())), pa.array(out_counts, pa.list_(pa.int32()))],
                ["doc_id", "terms", "counts"],
            )

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each term, counted per task: at most a row per term of the vocabulary."""
    seen: Counter = Counter()
    for batch in batches:
        terms, n = np.unique(batch.column("terms").flatten().to_numpy(), return_counts=True)
        seen.update(dict(zip(terms.tolist(), n.tolist())))
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], ["term", "n"]
    )


class Index:
    """Examples under a block-max inverted index; equal vectors are one example with summed votes."""

    def __init__(self, rows: list[tuple], idf: np.ndarray, weights: tuple[float, float]):
        self.idf = idf
        merged: dict[tuple, list] = {}
        for doc_id, terms, counts, toxic in rows:
            own = merged.setdefault((tuple(terms), tuple(counts)), [0.0, 0.0, doc_id])
            own[toxic] += weights[toxic]
            own[2] = min(own[2], doc_id)
        self.empty = merged.pop(((), ()), [0.0, 0.0, None])
        total = [sum(v[y] for v in merged.values()) + self.empty[y] for y in (0, 1)]
        self.prior = (total[1] + 1e-9) / (sum(total) + 2e-9)
        # Like vectors stand in one block, which makes its bounds tight.
        keys = sorted(merged)
        self.keys = {k: i for i, k in enumerate(keys)}
        self.votes = np.array([merged[k][:2] for k in keys]).reshape(-1, 2)
        self.ids = np.array([merged[k][2] for k in keys], np.int64)
        self.blocks = -(-len(keys) // BLOCK)
        self.most = np.zeros((len(idf), self.blocks), np.float32)
        self.dense: list[tuple] = []  # per block: the postings (term, example, weight)
        for b in range(self.blocks):
            terms, where, values = [], [], []
            for j, (t, c) in enumerate(keys[b * BLOCK : (b + 1) * BLOCK]):
                v = self.vector(np.array(t), np.array(c))
                np.maximum.at(self.most[:, b], np.array(t), (v * (1 + 1e-6)).astype(np.float32))
                terms.append(np.array(t))
                where.append(np.full(len(t), j))
                values.append(v)
            self.dense.append((np.concatenate(terms), np.concatenate(where), np.concatenate(values)))

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v = (1 + np.log(counts)) * self.idf[terms]
        return v / np.sqrt(v @ v)

    def nearest(self, terms, counts, k: int, leave: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the k nearest examples with a cosine above 0, nearest first."""
        terms, counts = np.asarray(terms, np.int64), np.asarray(counts, np.float64)
        q = np.zeros(len(self.idf))
        q[terms] = v = self.vector(terms, counts)
        bounds = v @ self.most[terms]
        found, cosines, border = np.empty(0, np.int64), np.empty(0), 0.0
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] <= 0 or len(found) >= k and bounds[b] < border:
                break
            t, where, values = self.dense[b]
            scores = np.bincount(where, q[t] * values)
            inside = np.flatnonzero(scores > 0)
            found = np.concatenate((found, inside + b * BLOCK))
            cosines = np.concatenate((cosines, scores[inside]))
            if len(found) > k:
                order = np.lexsort((found, -np.round(cosines, 12)))[:k]
                found, cosines = found[order], cosines[order]
            border = cosines.min() if len(found) >= k else 0.0
        order = np.lexsort((found, -np.round(cosines, 12)))
        return found[order], cosines[order]

    def vote(self, terms, counts, own: tuple[float, float] = (0.0, 0.0)) -> tuple[float, list]:
        """The share of the votes for toxic, an example's own vote left out, and the evidence."""
        if not len(terms) or not len(self.ids):
            base = np.array(self.empty[:2]) - own
            return float((max(base[1], 0) + self.prior) / (max(base.sum(), 0) + 1)), []
        found, cosines = self.nearest(terms, counts, NEIGHBOURS)
        votes = self.votes[found].copy()
        if any(own):
            votes[found == self.keys.get((tuple(terms), tuple(counts)), -1)] -= own
        weight = np.maximum(votes, 0) * (cosines**2)[:, None]
        clean, toxic = weight.sum(axis=0) if len(found) else (0.0, 0.0)
        evidence = [(int(self.ids[i]), float(c)) for i, c in zip(found[:3], cosines[:3])]
        return float((toxic + 0.05 * self.prior) / (clean + toxic + 0.05)), evidence


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising step function nearest to y: where steps begin, and their values."""
    order = np.argsort(x, kind="stable")
    steps: list[list[float]] = []  # start, weighted sum, weight
    for i in order:
        if steps and steps[-1][0] == x[i]:
            steps[-1][1] += y[i] * w[i]
            steps[-1][2] += w[i]
        else:
            steps.append([x[i], y[i] * w[i], w[i]])
        while len(steps) > 1 and steps[-2][1] / steps[-2][2] >= steps[-1][1] / steps[-1][2]:
            last = steps.pop()
            steps[-1][1] += last[1]
            steps[-1][2] += last[2]
    return np.array([s[0] for s in steps]), np.array([s[1] / s[2] for s in steps])


def score(documents: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """(doc_id, score, predicted, evidence) for every row of documents (doc_id, text, ...).

    labels has doc_id and toxic; where a doc_id has several labels, toxic wins. Learns from rows
    whose doc_id `learn` admits: at most PER_LABEL of each label, chosen by a hash, weighted back
    to their true shares. Scores come from text alone. evidence holds the doc_id and cosine of the
    three nearest examples. NULL and empty texts, and texts without any selected term, get the
    share of toxic ones among such examples. NULL labels and labels without a document are not
    used; without labels all scores are 0. A NULL doc_id is scored like any other. Repeated rows get a row each. Other columns are not read.
    """
    texts = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    known = labels.filter(learn & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {y: min(1.0, 0.9 * PER_LABEL / n) for y, n in counts.items()}
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1_000_000)) / 1_000_000
    chosen = known.filter(drawn < F.when(F.col("toxic") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0)))
    # At most about 2 * PER_LABEL ids, so the copy for each executor is bounded.
    chosen = written(chosen, "examples")
    examples = texts.join(F.broadcast(chosen), "doc_id")

    n = {y: max(c * share[y], 1) for y, c in counts.items()}
    n0, n1 = n.get(0, 1), n.get(1, 1)
    seen = examples.select("text", "toxic").mapInArrow(_counts, "term string, clean bigint, toxic bigint")
    seen = seen.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    pooled = (F.col("clean") + F.col("toxic") + 1) / (n0 + n1 + 2)
    z = (F.col("toxic") / n1 - F.col("clean") / n0) / F.sqrt(pooled * (1 - pooled) * (1 / n0 + 1 / n1) + 1e-12)
    ordered = seen.filter("toxic + clean >= 3").withColumn("z", z).filter(F.abs("z") >= SIGNIFICANT)
    found = ordered.orderBy(F.desc(F.abs("z")), "term").limit(TERMS).collect()
    terms = {r["term"]: i for i, r in enumerate(found)}

    vectors = written(texts.mapInArrow(_vectors(terms), "doc_id bigint, terms array<int>, counts array<int>"), "vectors")
    total = vectors.count()
    frequency = np.zeros(max(len(terms), 1))
    for r in vectors.select("terms").mapInArrow(_frequencies, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        frequency[r["term"]] = r["n"]
    idf = np.log((total + 1) / (frequency + 1)) + 1
    rows = [
        (r["doc_id"], r["terms"], r["counts"], r["toxic"])
        for r in vectors.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).collect()
    ]
    drawn_n = Counter(r[3] for r in rows)
    weights = tuple(counts.get(y, 0) / max(drawn_n[y], 1) / max(sum(counts.values()), 1) * max(len(rows), 1) for y in (0, 1))
    index = Index(rows, idf, weights)
    own = lambda y: (weights[0], 0.0) if y == 0 else (0.0, weights[1])
    left_out = np.array([index.vote(t, c, own(y))[0] for _, t, c, y in rows])
    if len(rows):
        starts, values = isotonic(left_out, np.array([float(r[3]) for r in rows]), np.array([weights[r[3]] for r in rows]))
    else:
        starts, values = np.array([0.0]), np.array([0.0])
    model = documents.sparkSession.sparkContext.broadcast((index, starts, values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, starts, values = model.value
        shape = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())]))
        for batch in batches:
            scores, evidence = [], []
            for t, c in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist()):
                raw, near = index.vote(t, c)
                scores.append(float(values[max(np.searchsorted(starts, raw, "right") - 1, 0)]))
                evidence.append([{"doc_id": d, "cosine": s} for d, s in near])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(evidence, shape)],
                ["doc_id", "score", "predicted", "evidence"],
            )

    return vectors.mapInArrow(run, "doc_id bigint, score double, predicted int, evidence array<struct<doc_id:bigint,cosine:double>>")
