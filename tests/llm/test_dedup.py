"""Near-duplicates and shared passages against brute force on small fixtures."""

import math
import os
import random
import time

import numpy as np
import pyarrow as pa
import pytest

from webcorpus.llm import chaining, chosen_path
from webcorpus.llm.common import WordHashes, grams, written
from webcorpus.llm.components import components
from webcorpus.session import checkpoint_dir

SCHEMA = "doc_id bigint, text string, key string, component_id bigint"


def corpus():
    draw = random.Random(5)
    word = lambda: "".join(draw.choices("abcdefgh", k=5))
    texts = []
    base = [word() for _ in range(120)]
    for i in range(40):  # a family of near copies
        copy = list(base)
        for _ in range(i % 4):
            copy[draw.randrange(120)] = word()
        texts.append(" ".join(copy))
    texts += [" ".join(word() for _ in range(60)) for _ in range(30)]
    texts += ["same text twice over again"] * 5 + ["One Two", "one\ttwo", "", None, " \n ", "x"]
    return [(i, t, "clash", -1) for i, t in enumerate(texts)]


def sets_of(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1)))


def brute(rows, k, above, below):
    sets = {i: sets_of(t, k) for i, t, *_ in rows}
    reach = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and above * both >= below * len(sets[a] | sets[b]) and reach[b] < reach[a]:
                    reach[a], changed = reach[b], True
    return {i: (len(sets[i]), reach[i], reach[i] == i) for i in sets}


@pytest.mark.parametrize("k,below", [(3, 85), (5, 80)])
def test_near_duplicates(spark, k, below):
    rows = corpus()
    found = chosen_path.near_duplicates(spark.createDataFrame(rows, SCHEMA), k=k, above=100, below=below).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows, k, 100, below)


def test_large_nodes_and_clusters(spark, monkeypatch):
    """The way for groups beyond a node or block gives the same result."""
    for name, value in (("NODE", 6), ("BLOCK", 4), ("PIVOTS", 2)):
        monkeypatch.setattr(chosen_path, name, value)
    rows = corpus()
    found = chosen_path.near_duplicates(spark.createDataFrame(rows, SCHEMA), k=3).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows, 3, 100, 85)


def test_twins_in_large_nodes(spark, monkeypatch):
    """Twins of a family that is too alike to be branched and too unlike to be linked meet, in
    whatever blocks of their nodes they are."""
    for name, value in (("NODE", 4), ("BLOCK", 2), ("PIVOTS", 1)):
        monkeypatch.setattr(chosen_path, name, value)
    draw = random.Random(11)
    base, rows = [f"w{i}" for i in range(100)], []
    for i in range(120):
        text = list(base)
        for at in draw.sample(range(95), 5):
            text[at] = f"d{i}x{at}"
        rows += [(i, " ".join(text), "", 0), (i + 120, " ".join([*text[:-1], f"t{i}"]), "", 0)]
    found = chosen_path.near_duplicates(spark.createDataFrame(rows, SCHEMA), k=3, trees=3).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows, 3, 100, 85)


def test_near_duplicates_odd_rows(spark):
    rows = [(1, "a b c d e", "", 0), (1, "f g h i j", "", 0), (2, "f g h i j", "", 0), (None, "a b c d e", "", 0), (3, None, "", 0), (3, None, "", 0)]
    found = chosen_path.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in found)
    assert got == [(-1, -1, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True), (3, 3, True)]
    assert chosen_path.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components(spark):
    path = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7), (None, 3)]
    found = {r.id: r.component for r in components(spark.createDataFrame(path, "a bigint, b bigint")).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}


def test_shared_passages(spark):
    draw = random.Random(3)
    word = lambda: "".join(draw.choices("abcdefgh", k=6))
    passage = [word() for _ in range(70)]
    edited = passage[:20] + [word()] + passage[21:45] + passage[46:]
    fill = lambda n: [word() for _ in range(n)]
    rows = [
        (1, " ".join(fill(80) + passage + fill(30))), (2, " ".join(fill(5) + passage)), (3, " ".join(edited + fill(90))),
        (4, " ".join(fill(200))), (5, " ".join(passage[:30] + fill(60))), (6, None), (7, ""), (8, "the " * 90), (9, "The " * 75),
    ]
    rows += [(10, rows[3][1]), (None, rows[0][1]), (3, rows[2][1])]
    texts = dict(rows)
    found = chaining.shared_passages(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, other bigint")).collect()
    assert {r.doc_id for r in found} == {2, 3, 9, 10}
    for r in found:
        words = texts[r.doc_id][r.start : r.end].split()
        assert len(words) == r.n_words >= 50 and r.similarity >= 0.8
        if r.doc_id == 2:
            assert words == passage and texts[r.other][r.other_start : r.other_end].split() == passage
        if r.doc_id == 3:
            assert len(set(words) & set(edited)) >= 60
    assert chaining.shared_passages(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_chains_match_the_quadratic_way():
    draw = np.random.default_rng(2)
    for _ in range(30):
        blocks = np.column_stack((draw.integers(0, 60, 12), draw.integers(0, 60, 12), draw.integers(5, 9, 12)))
        best = np.zeros(12)
        for i in np.lexsort((blocks[:, 1], blocks[:, 0])):
            gains = [
                best[j] - 0.25 * (blocks[i, 0] - blocks[j, 0] - blocks[j, 2] + blocks[i, 1] - blocks[j, 1] - blocks[j, 2])
                for j in range(12) if blocks[j, 0] + blocks[j, 2] <= blocks[i, 0] and blocks[j, 1] + blocks[j, 2] <= blocks[i, 1]
            ]
            best[i] = blocks[i, 2] + max([0, *gains])
        chain = chaining.chains(blocks, 0.25)[0]
        got = blocks[chain[0], 2] + sum(
            blocks[i, 2] - 0.25 * (blocks[i, 0] - blocks[j, 0] - blocks[j, 2] + blocks[i, 1] - blocks[j, 1] - blocks[j, 2])
            for j, i in zip(chain, chain[1:])
        )
        assert got == pytest.approx(best.max())


def test_words():
    assert len(WordHashes().of("A b c\td\n".encode())) == 3


def test_passage_behind_holders_of_its_short_seeds(spark):
    passage = [f"p{i}" for i in range(51)]

    def text(doc, parts):
        return " ".join(w for n, part in enumerate(parts) for w in [*part, *(f"d{doc}x{n}x{i}" for i in range(60))])

    halves = [passage[:31], passage[20:]]
    rows = [(0, text(0, halves)), (1, text(1, [passage])), (2, text(2, halves[::-1])), (3, text(3, [passage]))]
    found = chaining.shared_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [(r.doc_id, r.other, r.n_words) for r in found] == [(3, 1, 51)]


def _numbers(first, n):
    return np.arange(first, first + n, dtype=np.uint64)


@pytest.mark.parametrize("head,foot,gap_a,gap_b", [(60, 60, 100, 100), (100, 100, 150, 0), (60, 60, 30, 40), (55, 60, 80, 0)])
def test_passages_around_other_words(head, foot, gap_a, gap_b):
    a = np.concatenate((_numbers(0, head), _numbers(1000, gap_a), _numbers(500, foot)))
    b = np.concatenate((_numbers(0, head), _numbers(2000, gap_b), _numbers(500, foot)))
    found = sorted(chaining.passages(a, b, 50, 0.8))
    assert found == [(0, head, 0, head, 1.0), (head + gap_a, len(a), head + gap_b, len(b), 1.0)]


def test_common_words_keep_their_order_at_any_size(monkeypatch):
    assert chaining.common_words(_numbers(0, 3000), _numbers(0, 3000)[::-1]) == 1
    monkeypatch.setattr(chaining, "STRIP", 7)
    draw = np.random.default_rng(3)
    for _ in range(40):
        a, b = (draw.integers(0, 9, draw.integers(1, 90)) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            old = row[:]
            for j, y in enumerate(b):
                row[j + 1] = old[j] + 1 if x == y else max(old[j + 1], row[j])
        assert chaining.common_words(a, b) == row[-1]


@pytest.mark.parametrize("threshold", [0.8, 0.85])
def test_trees_find_pairs_at_the_last_level(threshold):
    """A pair may have to stay together in every branching, and its sketches agree in fewer
    coordinates than they should: the stated share of pairs is found all the same."""
    trees, extra, missed = chosen_path.trees_for(threshold, 0.9999), 1 / threshold - 1, 0.0
    for agree in range(chosen_path.WIDTH + 1):
        found = 1.0
        for _ in range(chosen_path.LEVELS + 1):
            one = agree / chosen_path.WIDTH * found
            found = 1 - (1 - one) * (1 - extra * one)
        share = math.comb(chosen_path.WIDTH, agree) * threshold**agree * (1 - threshold) ** (chosen_path.WIDTH - agree)
        missed += share * (1 - found) ** trees
    assert missed <= 1.3e-4  # of it, 3e-5 at most for pairs that aren't nominated


def test_passages_behind_shorter_holders_of_their_seeds(spark):
    """Documents 2 and 4 of a family repeat 50 words; 1 and 3, first and previous holder of the seeds, 49 of them."""
    fresh = (f"w{i}" for i in range(1_000_000))
    take = lambda n: [next(fresh) for _ in range(n)]
    rows = []
    for family in range(0, 300, 10):
        shared = take(50)
        for n, part in enumerate((shared[:49], shared, shared[:49], shared), 1):
            rows.append((family + n, " ".join(take(30) + part + take(30))))
    found = chaining.shared_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.doc_id, r.other) for r in found} == {(family + 4, family + 2) for family in range(0, 300, 10)}
    assert all(r.n_words == 50 and r.similarity == 1.0 for r in found)


def test_edited_passages_behind_other_holders_of_their_seeds(spark, monkeypatch):
    """Documents 50 and 90 share a passage that is edited every 15 words; each stretch between is quoted
    alone by earlier and later documents, first and previous holders of the seeds."""
    fresh = (f"w{i}" for i in range(1_000_000))
    take = lambda n: [next(fresh) for _ in range(n)]
    stretches = [take(14) for _ in range(5)]
    whole = lambda: take(70) + [w for s in stretches for w in [*s, *take(1)]] + take(70)
    rows = [(low + 5 * k + n, take(60) + s + take(60)) for low in (0, 60) for k in range(3) for n, s in enumerate(stretches)]
    rows = [(i, " ".join(text)) for i, text in [*rows, (50, whole()), (90, whole())]]
    for holders in (2048, 3):
        monkeypatch.setattr(chaining, "HOLDERS", holders, raising=False)
        found = chaining.shared_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        assert [(r.doc_id, r.other) for r in found] == [(90, 50)]
        assert found[0].n_words >= 70 and found[0].similarity > 0.9


def test_holders_around_whose_seed_is_a_passage_are_close():
    draw, tried = np.random.default_rng(8), 0
    radius, need = chaining._bounds(50, 0.8)
    for _ in range(400):
        a = draw.integers(1, 1 << 60, int(draw.integers(50, 75)), dtype=np.uint64)
        b = list(a)
        for _ in range(int(draw.integers(0, 12))):
            at = int(draw.integers(0, len(b)))
            b[at : at + int(draw.integers(0, 2))] = draw.integers(1, 1 << 60, int(draw.integers(0, 3)), dtype=np.uint64).tolist()
        sides = [np.concatenate((draw.integers(1, 1 << 60, 90, dtype=np.uint64), x, draw.integers(1, 1 << 60, 90, dtype=np.uint64))) for x in (a, np.array(b, np.uint64))]
        for s, e, u, v, _ in chaining.passages(*sides, 50, 0.8):
            runs = [grams(x, 8) for x in sides]
            for seed in np.intersect1d(runs[0][s : e - 7], runs[1][u : v - 7]):
                tried += 1
                near = [chaining.around(chaining.numbered_pairs(x), np.flatnonzero(r == seed), 8, radius) for x, r in zip(sides, runs)]
                found = chaining.close(np.array([5, 3]), np.array([True, False]), near, None, need)
                assert found.tolist() == [[5, 3]]
    assert tried > 1000


def test_places_of_seeds_are_those_of_the_profile():
    texts = [t for t in _odd_texts(80) if len(t.split()) >= 50]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.binary())], ["doc_id", "text"])
    rows = [r for part in chaining._profiles(8, 12, 50)(iter([batch])) for r in part.to_pylist()]
    for row in rows:
        seeds, hashes = np.frombuffer(row["seeds"], np.int64), chaining.word_hashes(texts[row["doc_id"]])
        runs, longer = grams(hashes, 8), chaining.long_runs(hashes, 39)
        short = {int(r) & ~1 for r in chaining.winnow(runs, 12)}
        seed, start, words = chaining.placed(hashes, seeds, 50)
        assert {s for s, n in zip(seed.tolist(), words.tolist()) if n == 8} == short
        assert {s for s, n in zip(seed.tolist(), words.tolist()) if n == 39} == {int(r) | 1 for r in chaining.winnow(longer, 12)}
        assert all(int((runs if n == 8 else longer)[at]) >> 1 == s >> 1 for s, at, n in zip(seed.tolist(), start.tolist(), words.tolist()))


def test_extensions_at_once_are_those_one_by_one():
    rng = np.random.default_rng(5)
    for _ in range(40):
        a = rng.integers(0, 3, 200).astype(np.uint64)
        b = np.where(rng.random(200) < rng.random() / 2, a + np.uint64(7), a)
        x, y = rng.integers(0, 201, 30), rng.integers(0, 201, 30)
        x[:15] = y[:15]
        upto, alike = chaining.extensions(a, b, x, y)
        for u, v, more, same in zip(x.tolist(), y.tolist(), upto.tolist(), alike.tolist()):
            expected = chaining.extend(a[u:], b[v:])
            assert more == expected and same == (a[u : u + more] == b[v : v + more]).sum() or more < 0 and min(len(a) - u, len(b) - v) > chaining.AHEAD


def test_components_end_with_stars(spark, monkeypatch):
    """A star takes one round; what only looks settled, nodes with one link each, goes on."""
    from webcorpus.llm import components as module

    labels = []
    monkeypatch.setattr(module, "written", lambda df, label, write=module.written: labels.append(label) or write(df, label))
    found = lambda links: sorted(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert found([(1, i) for i in range(2, 30)]) == [(i, 1) for i in range(1, 30)]
    assert len(labels) == 2  # the links, and one round
    assert found([(4, 3), (3, 2), (2, 1), (9, 8)]) == [(1, 1), (2, 1), (3, 1), (4, 1), (8, 8), (9, 8)]
    draw = random.Random(8)
    order = draw.sample(range(60), 60)
    assert found(list(zip(order, order[1:]))) == [(i, 0) for i in range(60)]


def test_long_runs_are_grams(monkeypatch):
    monkeypatch.setattr(chaining, "_PART", 64)
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 300).astype(np.uint64)
    for n in (0, 38, 39, 63, 64, 65, 102, 103, 300):
        for k in (2, 39, 50):
            assert (chaining.long_runs(hashes[:n], k) == grams(hashes[:n], k)).all()


def _shuffle_files(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


def test_a_written_table_leaves_no_shuffle_behind(spark):
    before = _shuffle_files(spark)
    table = written(spark.range(4000).selectExpr("id % 1000 AS id").groupBy("id").count(), "counted")
    until = time.time() + 20
    while _shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before
    assert table.count() == 1000


def test_shared_passages_keep_no_seeds(spark):
    """The tables of seeds are as large as the texts; they are deleted before texts are joined."""
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(["x", *words])), (2, " ".join(["x", *words])), (3, " ".join(words))]
    folder = os.path.join(checkpoint_dir(spark).removeprefix("file://").removeprefix("file:"), "webcorpus")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    found = chaining.shared_passages(spark.createDataFrame(rows, "doc_id bigint, text string"))
    left = {name.partition("-")[0] for name in set(os.listdir(folder)) - before}
    assert "texts" in left and not left & {"profiles", "classes"}
    assert sorted((r.doc_id, r.other, r.n_words) for r in found.collect()) == [(2, 1, 60), (3, 1, 60)]


def _odd_texts(n):
    draw = random.Random(6)
    base = [[f"{draw.choice('aBé')}{draw.randrange(v)}" for _ in range(size)] for v, size in zip((1, 3, 40, 900) * 8, (0, 7, 8, 49, 50, 90, 300) * 5)]

    def edited(words):
        out = words[:]
        for _ in range(draw.randrange(9) if out else 0):
            at = draw.randrange(len(out))
            out[at : at + draw.randrange(3)] = [f"e{draw.randrange(99)}"] * draw.randrange(3)
            out = out or ["e"]
        return out

    return [draw.choice((" ", "\n ")).join(edited(draw.choice(base)) + draw.choice(base)).encode() for _ in range(n)]


@pytest.mark.parametrize("together", [1, 300, 1 << 16])
def test_pairs_are_aligned_together(monkeypatch, together):
    """A batch of pairs takes a few steps on arrays, not some for each pair, and gives what each pair gives alone."""
    texts = _odd_texts(120)
    pairs = [(i, j) for i in range(len(texts)) for j in (i, (7 * i + 3) % len(texts), (i * i) % len(texts))]
    ids = [pa.array(side, pa.int64()) for side in zip(*pairs)]
    batch = pa.RecordBatch.from_arrays([*ids, *(pa.array([texts[pair[side]] for pair in pairs], pa.binary()) for side in (0, 1))], ["doc_id", "other", "text", "other_text"])
    calls, matches = [], chaining.matches
    monkeypatch.setattr(chaining, "matches", lambda *a: calls.append(1) or matches(*a))
    monkeypatch.setattr(chaining, "TOGETHER", together, raising=False)
    found = [r for part in chaining._align(50, 0.8)(iter([batch, batch.slice(0, 0)])) for r in part.to_pylist()]
    assert together < 1 << 16 or len(calls) <= 6
    hashes = [chaining.word_hashes(text) for text in texts]
    alone = [(doc, other, e - s, share) for doc, other in pairs for s, e, _, _, share in chaining.passages(hashes[doc], hashes[other], 50, 0.8)]
    assert len(alone) > 100 and [(r["doc_id"], r["other"], r["n_words"], r["similarity"]) for r in found] == alone
    for r in found:
        assert len(texts[r["doc_id"]].decode()[r["start"] : r["end"]].split()) == r["n_words"]


def test_texts_are_hashed_together(monkeypatch):
    """Seeds of a text don't depend on its neighbours."""
    calls, spans = [], chaining.word_spans
    monkeypatch.setattr(chaining, "word_spans", lambda text: calls.append(1) or spans(text))
    texts = _odd_texts(150) + [b"", b" ", b"one"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.binary())], ["doc_id", "text"])
    seeds = lambda batch, least: [r["seeds"] for part in chaining._profiles(8, 12, least)(iter([batch])) for r in part.to_pylist()]
    for least in (9, 50):
        calls.clear()
        found = seeds(batch, least)
        assert len(calls) <= 6
        assert found == [seeds(batch.slice(i, 1), least)[0] for i in range(len(texts))]
        for text, held in zip(texts, found):
            runs = grams(chaining.word_hashes(text), 8)
            short = chaining.repeated_seeds(runs, chaining.winnow(runs, 12), least - 7) & ~np.uint64(1)
            assert set(short.tolist()) <= set(np.frombuffer(held, np.uint64).tolist())
