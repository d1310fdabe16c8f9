"""Phrases against plain counting on small fixtures."""

import random
import re
from collections import Counter, defaultdict

import pytest

from webcorpus.llm import collocations

SCHEMA = "doc_id bigint, text string, lang string, n bigint, rank string"


def plain(rows, least, longest, top):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    counts[lang, tuple(words[i : i + m])] += 1
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    out = defaultdict(list)
    for (lang, words), a in found.items():
        text = f" {' '.join(words)} "
        if any(
            other == lang and len(more) > len(words) and b >= a and text in f" {' '.join(more)} "
            for (other, more), b in found.items()
        ):
            continue
        score, k = min(
            (1000 * a * totals[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))
        )
        out[lang].append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, totals[lang], -score)
        for lang, rows in out.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1)
    )


def corpus(seed):
    draw = random.Random(seed)
    word = lambda: draw.choice(["a", "b", "c", "The", "the", "É", "é", "x y", "of"])
    texts = []
    for _ in range(60):
        texts.append("".join(word() + draw.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "\r\n", "?"]) for _ in range(draw.randrange(40))))
    texts += ["one two three four five six seven eight nine"] * 7  # a path with one way through
    texts += ["five six seven eight! zero one two three four five"] * 3 + ["a a a a a a a a a a"] * 2
    texts += ["", None, " \t ", ".", "solo", "long " * 30_000 + "end"]
    return [(i, t, ("en", "de", None, "und")[i % 4], 3, "clash") for i, t in enumerate(texts)]


@pytest.mark.parametrize("longest,least,bits", [(5, 3, 22), (5, 1, 6), (2, 2, 3), (3, 4, 22)])
def test_phrases(spark, longest, least, bits):
    rows = corpus(longest)
    found = collocations.phrases(spark.createDataFrame(rows, SCHEMA), least=least, longest=longest, top=40, bits=bits).collect()
    assert sorted(tuple(r) for r in found) == plain([(t, lang) for _, t, lang, *_ in rows], least, longest, 40)


def test_paths_are_compacted(spark):
    """A passage repeated as a whole is one path, of one weight; a fork parts it."""
    edge = lambda i, n: ("en", " ".join(f"w{j}" for j in range(i, i + 3)), n)
    edges = [edge(i, 4) for i in range(6)] + [("en", "w1 w2 z", 2), ("en", "q r s", 1)]
    ends = [("en", "w6 w7", 4), ("en", "w4 w5", 0)]
    schema = "lang string, run string, n bigint"
    found = collocations.compact(spark.createDataFrame(edges, schema), spark.createDataFrame(ends, schema), 3).collect()
    assert sorted((" ".join(r.words), r.n) for r in found) == [
        ("q r s", 1), ("w0 w1 w2", 4), ("w1 w2 w3 w4 w5", 4), ("w1 w2 z", 2), ("w4 w5 w6 w7", 4),
    ]


def test_runs_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "HEAVY", 3)
    rows = corpus(9)
    found = collocations.phrases(spark.createDataFrame(rows, SCHEMA), least=2, longest=4, top=5).collect()
    assert sorted(tuple(r) for r in found) == plain([(t, lang) for _, t, lang, *_ in rows], 2, 4, 5)


def test_products_beyond_64_bits(spark):
    rows = spark.createDataFrame([(10**15, 10**13, 10**12, 10**13)], "a bigint, n bigint, l bigint, r bigint")
    exact = collocations.exact
    made = rows.select((exact(rows.a * 1000) * exact(rows.n)).alias("above"), (exact(rows.l) * exact(rows.r)).alias("below"))
    assert made.selectExpr("above div below AS s").first().s == 10**18 * 10**13 // 10**25


def test_empty(spark):
    assert collocations.phrases(spark.createDataFrame([], SCHEMA)).collect() == []
