"""SimHash classes against brute force on small fixtures."""

import random

import numpy as np
import pytest
import xxhash

from webcorpus.llm import simhash_trie

SCHEMA = "doc_id bigint, text string, fp bigint, component_id bigint, fingerprint string"


def plain(text, k=3):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(b" ".join(found[i : i + k]), 42) for i in range(max(len(found) - k + 1, 1))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(rows, within):
    """Least doc_id by doc_id, from (doc_id, fingerprint) rows; those that share a doc_id are one."""
    reach = {d: d for d, _ in rows if d is not None}
    changed = True
    while changed:
        changed = False
        for a, x in rows:
            for b, y in rows:
                if a is not None and b is not None and (x ^ y).bit_count() <= within and reach[b] < reach[a]:
                    reach[a], changed = reach[b], True
    return reach


def corpus():
    draw = random.Random(3)
    word = lambda: "".join(draw.choices("abcdefgh", k=5))
    base = [word() for _ in range(300)]
    texts = []
    for i in range(60):
        copy = list(base)
        for _ in range(i % 5):
            copy[draw.randrange(300)] = word()
        texts.append(" ".join(copy))
    texts += [" ".join(word() for _ in range(draw.randrange(1, 90))) for _ in range(80)]
    texts += ["Same  TEXT twice\tover"] * 4 + ["same text twice over", "", None, " \n ", "x", "x y", "é É é", "y " * 70_000]
    rows = [(i, t, 5, -1, "clash") for i, t in enumerate(texts)]
    return rows + [(7, "another text under a known id", 5, -1, None), (None, "same text twice over", 5, -1, None), (None, None, None, None, None)]


@pytest.mark.parametrize("tile", [4096, 2])
def test_documents(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash_trie, "TILE", tile)
    monkeypatch.setattr(simhash_trie, "SHARE", 1 << 40)
    rows = corpus()
    prints = [(r[0], plain(r[1])) for r in rows]
    want = classes(prints, 3)
    found = simhash_trie.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint) for r in found) == sorted(
        (d is None, d or 0, f"{x:016x}") for d, x in prints
    )
    assert all(r.component_id == want.get(r.doc_id) for r in found)


@pytest.mark.parametrize("within,tile", [(0, 4096), (3, 4096), (3, 16), (4, 16)])
def test_dense_fingerprints(spark, monkeypatch, within, tile):
    """Balls of near fingerprints and scattered ones; small tiles are cut down to the last level."""
    monkeypatch.setattr(simhash_trie, "TILE", tile)
    monkeypatch.setattr(simhash_trie, "SHARE", 1 << 40)
    monkeypatch.setattr(simhash_trie, "FRONTIER", 64)
    draw = random.Random(within)
    prints = set()
    for _ in range(4):
        centre = draw.getrandbits(64)
        for _ in range(40):
            x = centre
            for _ in range(draw.randrange(0, 9)):
                x ^= 1 << draw.randrange(64)
            prints.add(x)
    prints |= {draw.getrandbits(64) for _ in range(40)} | {0, 1, (1 << 64) - 1}
    rows = list(enumerate(sorted(prints)))
    want = classes(rows, within)
    signed = [(x - (1 << 64) if x >> 63 else x, i) for i, x in rows]
    links = simhash_trie.hamming_links(spark.createDataFrame(signed, "fp bigint, least bigint"), within).collect()
    label = simhash_trie.forest(len(rows), np.array([r.a for r in links], int), np.array([r.b for r in links], int))
    assert {i: int(label[i]) for i, _ in rows} == want


def test_large_tiles_are_cut(spark, monkeypatch):
    monkeypatch.setattr(simhash_trie, "TILE", 3)
    monkeypatch.setattr(simhash_trie, "SHARE", 1 << 40)
    cuts = []
    cut = simhash_trie._cut
    monkeypatch.setattr(simhash_trie, "_cut", lambda rows, within: cuts.append(1) or cut(rows, within))
    signed = [(x, x) for x in range(200)]
    assert simhash_trie.hamming_links(spark.createDataFrame(signed, "fp bigint, least bigint"), 3).count() >= 199
    assert len(cuts) >= 3


def test_empty(spark):
    assert simhash_trie.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
