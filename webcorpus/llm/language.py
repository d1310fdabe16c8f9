"""Language of texts in two steps: the family first, then one-versus-one linear classifiers.

Features are byte trigrams of the lower-cased text, as shares of its trigrams. The family is the
one that makes the trigrams likeliest (multinomial, smoothed). Within a family every pair of
languages has a linear support vector machine, trained by dual coordinate descent; the language
with the most votes wins. All models are sums of a weight per trigram, so a batch of texts is
scored as one array of table look-ups.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLOTS = 1 << 14  # trigram slots
PER_LANGUAGE = 400  # labelled texts to learn from, for each language
IN_ALL = 8000  # and for all languages together
AT_ONCE = 1 << 19  # bytes of text whose trigrams are weighed together

# Well-known families; any other language is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "indo-aryan": ("hi", "ur", "bn", "mr", "pa", "gu", "ne"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "dravidian": ("ta", "te", "kn", "ml"),
    "semitic": ("ar", "he", "mt", "am"),
    "malayic": ("id", "ms", "jv", "su"),
}

_LETTER = re.compile(r"[^\W\d_]")
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[c for c in range(128) if not chr(c).isalpha()]] = 32  # digits and signs are blanks


def family_of(lang: str) -> str:
    return next((name for name, members in FAMILIES.items() if lang in members), lang)


def _slots(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The trigram slot at each byte of all texts, where each text starts, and its trigrams.
    A slot beyond the table stands where a trigram would reach into the next text."""
    low = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    blank, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    padded = pc.binary_join_element_wise(blank, low, blank, nothing)
    _, offsets, data = padded.buffers()
    offsets = np.frombuffer(offsets, np.int64)[padded.offset : padded.offset + len(padded) + 1]
    raw = _PLAIN[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]].astype(np.uint32)
    offsets = offsets - offsets[0]
    code = raw.copy()
    code[:-1] += raw[1:] << np.uint32(8)
    code[:-2] += raw[2:] << np.uint32(16)
    slots = ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int32)
    for back in (1, 2):
        slots[offsets[1:] - back] = SLOTS
    return slots, offsets, np.maximum(np.diff(offsets) - 2, 1)


def shares(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), SLOTS + 1), np.float32)
    slots, offsets, sizes = _slots(pa.array(texts, pa.string()))
    for i in range(len(texts)):
        out[i] = np.bincount(slots[offsets[i] : offsets[i + 1]], minlength=SLOTS + 1) / sizes[i]
    return out[:, :SLOTS]


def linear_machine(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 20) -> tuple[np.ndarray, float]:
    """Weights and bias of a support vector machine with squared hinge loss; y is 1 or -1."""
    w, bias = np.zeros(x.shape[1]), 0.0
    alpha, diagonal = np.zeros(len(x)), 0.5 / cost
    square = np.einsum("ij,ij->i", x, x).astype(np.float64) + 1.0 + diagonal
    draw = np.random.default_rng(7)
    for _ in range(rounds):
        for i in draw.permutation(len(x)):
            gradient = y[i] * (x[i] @ w + bias) - 1 + diagonal * alpha[i]
            new = max(alpha[i] - gradient / square[i], 0.0)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w += step * x[i]
                bias += step
                alpha[i] = new
    return w, bias


@dataclass
class Model:
    families: list[str]
    languages: dict[str, list[str]]  # by family
    pairs: list[tuple[str, str]]
    weights: np.ndarray  # a row per slot and one of zeros: families, then pairs
    bias: np.ndarray

    def sums(self, slots: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Weights summed over the trigrams of each text. Long texts go in stretches that begin
        with the text, so the sums do not depend on what else is in the batch."""
        if len(offsets) > 2:
            return np.add.reduceat(self.weights[slots], offsets[:-1], axis=0, dtype=np.float64)
        total = np.zeros((1, self.weights.shape[1]))
        for at in range(0, len(slots), AT_ONCE):
            total += np.add.reduceat(self.weights[slots[at : at + AT_ONCE]], [0], axis=0, dtype=np.float64)
        return total

    def predict(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        """Language and score of each text; a bounded number of bytes, or one text, at a time."""
        langs, scores = [], []
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 2)
        start = 0
        while start < len(texts):
            done = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, done + AT_ONCE, "right")), start + 1)
            for found, into in zip(self._predict(texts.slice(start, stop - start)), (langs, scores)):
                into += found
            start = stop
        return langs, scores

    def _predict(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        slots, offsets, sizes = _slots(texts)
        means = self.sums(slots, offsets) / sizes[:, None] + self.bias
        nf = len(self.families)
        evidence = means[:, :nf] * np.minimum(sizes, 100)[:, None]  # neighbouring trigrams aren't independent
        odds = np.exp(evidence - evidence.max(axis=1, keepdims=True))
        odds /= odds.sum(axis=1, keepdims=True)
        wins = 1 / (1 + np.exp(-np.clip(3 * means[:, nf:], -50, 50)))
        column = {pair: j for j, pair in enumerate(self.pairs)}
        langs, scores = [], []
        for i, text in enumerate(texts.to_pylist()):
            if not text or not _LETTER.search(text):
                langs.append("und")
                scores.append(0.0)
                continue
            f = int(odds[i].argmax())
            members = self.languages[self.families[f]]
            chance = {a: [] for a in members}
            for a, b in itertools.combinations(members, 2):
                p = wins[i, column[a, b]]
                chance[a].append(p)
                chance[b].append(1 - p)
            best = max(members, key=lambda a: (sum(p > 0.5 for p in chance[a]), sum(chance[a])))
            langs.append(best)
            scores.append(float(odds[i, f] * (np.mean(chance[best]) if chance[best] else 1.0)))
        return langs, scores


def fit(rows: list[tuple[str, str]]) -> Model | None:
    """The model of labelled texts (lang, text); None without any."""
    if not rows:
        return None
    x = shares([text for _, text in rows])
    langs = np.array([lang for lang, _ in rows])
    known = sorted(set(langs))
    languages: dict[str, list[str]] = {}
    for lang in known:
        languages.setdefault(family_of(lang), []).append(lang)
    families = sorted(languages)
    scale = 1 / np.sqrt(x.mean(axis=0) + 1e-5)  # rare trigrams weigh as much as frequent ones
    columns, bias = [], []
    for family in families:
        # Languages count alike, however many texts each has.
        mean = np.mean([x[langs == lang].mean(axis=0) for lang in languages[family]], axis=0)
        columns.append(np.log((mean + 1e-6) / (1 + 1e-6 * SLOTS)))
        bias.append(0.0)
    pairs = [p for family in families for p in itertools.combinations(languages[family], 2)]
    for a, b in pairs:
        chosen = np.flatnonzero((langs == a) | (langs == b))
        w, c = linear_machine(x[chosen] * scale, np.where(langs[chosen] == a, 1.0, -1.0))
        columns.append(w * scale)
        bias.append(c)
    weights = np.zeros((SLOTS + 1, len(columns)), np.float32)
    weights[:SLOTS] = np.stack(columns, axis=1)
    return Model(families, languages, pairs, weights, np.array(bias))


def sample(documents: DataFrame, learn: Column) -> list[tuple[str, str]]:
    """Labelled texts to learn from, chosen by a hash: PER_LANGUAGE of each language at most."""
    usable = documents.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    each = max(1, min(PER_LANGUAGE, IN_ALL // len(counts)))
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, 0.8 * each / n) if n > each else 1.0)])
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < F.try_element_at(share, F.col("lang")) * 1_000_000
    found = usable.filter(drawn).select("lang", "text").limit(2 * each * len(counts)).collect()
    return sorted((r["lang"], r["text"]) for r in found)


def detect(documents: DataFrame, learn: Column) -> DataFrame:
    """Every row of documents with lang_pred and score (0 to 1) added.

    Learns from lang and text of the rows that `learn` admits, a bounded sample of them; predicts
    from text alone. A NULL, empty or letterless text is `und` with score 0, and so is every row
    where nothing could be learned. Rows with equal texts get equal results; ties go to the first
    name. NULL lang is not learned from. Columns lang_pred and score of the input are replaced.
    """
    model = fit(sample(documents, learn))
    kept = [c for c in documents.columns if c not in ("lang_pred", "score")]
    documents = documents.select(*kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            n = len(texts)
            langs, scores = model.predict(texts) if model and n else (["und"] * n, [0.0] * n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names, "lang_pred", "score"],
            )

    schema = StructType([*documents.schema.fields]).add("lang_pred", "string").add("score", "double")
    return documents.mapInArrow(run, schema)
