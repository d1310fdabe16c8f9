"""Queries over whole tables against plain code, or held-out truth."""

import hashlib
import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"

# The three base patterns as the contract words them.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def plain_spans(text):
    found = [(m.start(), i, "assign", m.end()) for i in [0] for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 32]
    return sorted(found)


def test_base_secrets_of_all_documents(spark):
    larger = SF.replace("0.001", "0.01")  # the smallest tables hold none
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "text").collect()}
    rows = entry.queries()["op7_secrets"](spark, larger).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain_spans(texts[r.doc_id])
        counts = [sum(kind == k for _, _, kind, _ in spans) for k in ("assign", "access", "hex")]
        joined = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)
        assert [r.n_assign, r.n_access, r.n_hex] == counts
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
    assert sum(r.n_assign + r.n_access + r.n_hex for r in rows) > 0


def test_language_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in entry.queries()["op8_language"](spark, SF).collect() if r.held_out and r.lang_pred != "und"]
    right = sum(r.lang_pred == truth[r.doc_id] for r in held)
    assert len(held) > 20 and right >= 0.95 * len(held)


@pytest.mark.parametrize("name", ["op11_simhash_trie", "op1_near_duplicates"])
def test_components_name_their_least_member(spark, name):
    rows = entry.queries()[name](spark, SF).collect()
    members = {}
    for r in rows:
        members.setdefault(r.component_id, []).append(r.doc_id)
    assert all(component == min(ids) for component, ids in members.items())
