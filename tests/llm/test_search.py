"""Neighbours, benchmark leaks, language and toxicity against brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from webcorpus.llm import decontaminate, language, multiprobe, toxicity


def test_nearest(spark):
    draw = np.random.default_rng(4)
    x = draw.standard_normal((1500, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[7] = x[3]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    odd = [(9000, None, 0), (9001, [], 0), (9002, [0.0] * 24, 0), (9003, [float("nan")] * 24, 0), (9004, [1.0, 2.0], 0), (None, [1.0] * 24, 0)]
    vectors = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>, rank int")
    found = multiprobe.nearest_neighbours(vectors, vectors.filter("vec_id % 20 = 0"), top=10).collect()
    hit = 0
    for q in range(0, 1500, 20):
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 11))
        scores = x @ x[q]
        scores[q] = -9
        hit += len({r.vec_id for r in own} & set(np.lexsort((np.arange(1500), -scores))[:10].tolist()))
        assert np.allclose([r.score for r in own], [scores[r.vec_id] for r in own])
    assert hit / 750 >= 0.9
    assert {r.query_id for r in found} <= set(range(1500))
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert multiprobe.nearest_neighbours(empty, empty).count() == 0


def test_leaks(spark):
    draw = random.Random(8)
    word = lambda: "".join(draw.choices("abcdefgh", k=4))
    line = lambda n: " ".join(word() for _ in range(n))
    items = [(i, f"{line(20)}. {line(12)}.", 1) for i in range(60)] + [(60, None, 1), (61, "", 1), (62, "one", 1)]
    docs = [(i, f"{line(300)} {items[i][1].upper()} {line(100)}", 1) for i in range(5)]
    docs += [(10, items[7][1].split(".")[0], 1), (11, line(500), 1), (12, None, 1), (13, "", 1), (None, items[3][1], 1)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, score int")
    bench = spark.createDataFrame(items, "item_id bigint, text string, score int")
    want = {(i, i) for i in range(5)} | {(None, 3)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(frame, bench).collect()} == want
    assert decontaminate.find_leaks(frame, bench.filter("false")).count() == 0
    assert decontaminate.find_leaks(frame.filter("false"), bench).count() == 0


def test_block_max_wand_is_exact(monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 2)
    draw = random.Random(1)
    items = [(i, " ".join(draw.choice("abcdef") for _ in range(12))) for i in range(40)]
    index = decontaminate.Index(items, 40, 11.0, {})
    for _ in range(200):
        own = sorted(set(index.terms([draw.choice(b"abcdef".decode()).encode() for _ in range(draw.randrange(2, 30))]).tolist()) - {len(index.codes)})
        scores: dict = {}
        for t in own:
            for i, w in index.lists[t]:
                scores[i] = scores.get(i, 0) + w
        assert {i for i, _ in index.retrieve(own, 0.4)} == {i for i, s in scores.items() if s >= 0.4 - 1e-9}


def test_language(spark):
    samples = {
        "en": "the house and the garden with this that", "de": "das haus und der garten mit dieser nicht",
        "fr": "la maison et le jardin avec cette les", "es": "la casa y el jardin con esta los",
    }
    draw = random.Random(6)
    rows = []
    for i in range(240):
        lang = "en de fr es".split()[i % 4]
        rows.append((i, " ".join(draw.choices(samples[lang].split(), k=12)), lang, 5))
    rows += [(900, None, "en", 5), (901, "", "en", 5), (902, "123 !!", None, 5), (903, "the garden with this house", None, 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int")
    out = {r.doc_id: r for r in language.detect(docs, F.col("doc_id") % 4 != 200).collect()}
    assert len(out) == 244 and all(out[i].lang_pred == "und" and out[i].score == 0 for i in (900, 901, 902))
    assert out[903].lang_pred == "en"
    assert sum(out[r[0]].lang_pred == r[2] for r in rows[:240]) >= 235
    nothing = language.detect(docs, F.lit(False)).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert language.detect(docs.filter("false"), F.lit(True)).count() == 0


def test_toxicity(spark):
    draw = random.Random(9)
    word = lambda: "".join(draw.choices("abcdefgh", k=4))
    rows, labels = [], []
    for i in range(400):
        toxic = int(i % 4 == 0)
        words = [word() for _ in range(30)] + ["vilest", "dreck"][: 2 * toxic]
        draw.shuffle(words)
        rows.append((i, " ".join(words), 7))
        labels.append((i, toxic))
    rows += [(900, None, 7), (901, "", 7), (None, "vilest dreck", 7)]
    labels += [(5000, 1), (3, None), (None, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score int")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    out = toxicity.score(docs, marks, F.col("doc_id") % 5 != 0).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == 403 and all(by[i].predicted == int(i % 4 == 0) for i in range(400))
    assert by[900].predicted == by[901].predicted == 0 and by[None].predicted == 1
    assert all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in toxicity.score(docs, marks.filter("false"), F.lit(True)).collect()} == {0.0}


def test_block_max_index_is_exact():
    draw = np.random.default_rng(0)
    rows = []
    for i in range(500):
        t = sorted(draw.choice(40, draw.integers(1, 6), replace=False).tolist())
        rows.append((i, t, draw.integers(1, 4, len(t)).tolist(), int(i % 3 == 0)))
    index = toxicity.Index(rows, 1 + draw.random(40), (1.0, 1.0))
    vectors = np.zeros((len(index.ids), 40))
    for (t, c), n in index.keys.items():
        vectors[n, list(t)] = index.vector(np.array(t), np.array(c))
    for _, t, c, _ in rows[:80]:
        q = np.zeros(40)
        q[t] = index.vector(np.array(t), np.array(c))
        want = np.sort(vectors @ q)[::-1][:16]
        assert np.allclose(index.nearest(t, c, 16)[1], want[want > 0])


def test_nearest_with_copies_of_a_near_vector(spark):
    draw = np.random.default_rng(8)
    x = draw.standard_normal((60, 8)) * 0.05 + np.ones(8)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(70, (np.ones(8) * 3).tolist())] * 30 + [(71, (np.ones(8) * (3 - 0.01 * j)).tolist()) for j in range(30)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = multiprobe.nearest_neighbours(vectors, vectors.filter("vec_id = 0"), top=20).collect()
    scores = {70: x[0].sum() * 3, 71: x[0].sum() * 3, **{i: float(v @ x[0]) for i, v in enumerate(x) if i}}
    got = {r.vec_id: r.score for r in found}
    assert sorted(r.rank for r in found) == list(range(1, 21)) and {70, 71} <= set(got)
    assert np.allclose([got[i] for i in got], [scores[i] for i in got])


def test_nearest_gives_all_of_few_candidates(spark):
    x = np.random.default_rng(5).standard_normal((15, 16))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    found = multiprobe.nearest_neighbours(vectors, vectors, top=20).collect()
    assert {(r.query_id, r.vec_id) for r in found} == {(i, j) for i in range(15) for j in range(15) if i != j}


def test_probes_reach_what_a_table_owes():
    draw = np.random.default_rng(1)
    for width in (5, 6):
        tables = multiprobe._Tables(8, 3, width, 1.0, 2**0.5, 0.95, 1)
        z = draw.uniform(-3, 3, (20, width))
        who, cells = tables.probes(z)
        assert (tables.reaches(z) <= tables.furthest).all()
        hits = np.zeros(len(z))
        chance = tables.chances(z, tables.furthest)
        for q, cell in zip(who, cells):
            steps = cell - np.floor(z[q]).astype(int) + tables.furthest
            hits[q] += np.prod([chance[s, q, j] for j, s in enumerate(steps)])
        assert (hits >= tables.owed - 1e-9).all()


def test_a_long_item_does_not_widen_the_window_of_a_short_one(spark):
    short = [f"s{i}" for i in range(24)]
    bench = [(1, " ".join(short[:14]) + ". " + " ".join(short[14:]) + "."), (2, " ".join(f"l{i}" for i in range(3000)))]
    scattered = [w for i in range(23) for w in [short[i], short[i + 1], *(f"c{i}x{j}" for j in range(100))]]
    docs = [(10, " ".join(scattered)), (11, " ".join(scattered[:700] + short + scattered[700:])), (12, "x " * 500 + bench[1][1])]
    items = spark.createDataFrame(bench, "item_id bigint, text string")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(frame, items).collect()} == {(11, 1), (12, 2)}
