"""Formatting, secrets, packing, URL lists and the pipeline."""

import base64
import datetime
import json

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__
import corpus_pipeline
from webcorpus.llm import chat_format, packing, secrets, url_filter


def test_template_round_trip():
    texts = ["", "\\", "a<s>b</s>", "<<SYS>>\\[INST]", "<\\s>", "[/INST", "<", "[ANS][TEXT]\n", "é</s>[INST] ok [/INST]", None]
    roles = ["user", "assistant", "system", "tool", None, "a[TEXT]", "user", "assistant", "assistant", "user"]
    joined, loss = chat_format.assemble(roles, pa.array(texts), np.zeros(10, int))
    text = joined[0].as_py()
    assert chat_format.parse(text) == [(r or "", t or "") for r, t in zip(roles, texts)]
    masked = [chat_format.unescape(text[s["start"] : s["start"] + s["length"]]) for s in loss[0]]
    assert masked == [t for r, t in zip(roles, texts) if r == "assistant"]


def test_long_conversations_come_in_parts(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [(1, t, "user" if t % 2 else "assistant", f"turn {t}", 0) for t in range(10)] + [(2, 0, "user", None, 0), (None, None, None, None, 0)]
        parts = chat_format.format_conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, part int"))
        whole = {}
        for r in sorted(parts.collect(), key=lambda r: (r.conv_id or 0, r.part)):
            whole[r.conv_id] = whole.get(r.conv_id, "") + r.text
        assert chat_format.parse(whole[1]) == [(r[2], r[3]) for r in rows[:10]]
        digest = {r.conv_id: r for r in chat_format.read_back(parts).collect()}
        assert digest[1].n_turns == 10 and digest[1].formatted_chars == len(whole[1]) and digest[None].n_turns == 1
        empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
        assert chat_format.read_back(chat_format.format_conversations(empty)).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x81, n]) if n < 256 else bytes([0x82]) + n.to_bytes(2, "big")
    return bytes([tag]) + size + body


def test_secrets(spark):
    key = der(0x30, der(0x02, b"\0") + der(0x02, b"\x7f" * 128) + der(0x02, b"\1\0\1"))
    coded = base64.b64encode(key).decode()
    web = lambda v: base64.urlsafe_b64encode(json.dumps(v).encode()).decode().rstrip("=")
    token = f"{web({'alg': 'HS256', 'typ': 'JWT'})}.{web({'sub': 'x'})}.c2lnbmF0dXJl"
    ssh = base64.b64encode(b"\0\0\0\x07ssh-rsa\0\0\0\x03\1\0\1\0\0\0\x40" + b"k" * 64).decode()
    cases = {
        f"-----BEGIN RSA PRIVATE KEY-----\n{coded}\n-----END RSA PRIVATE KEY-----": "pem", coded: "der", key.hex(): "der", token: "token", ssh: "ssh",
    }
    for text, kind in cases.items():
        assert any(k == kind for _, _, k in secrets.spans_of(f"see {text} there")), kind
    plain = base64.b64encode(b"just some plain words, nothing else at all").decode()
    assert secrets.spans_of(f"{plain} {token[1:]} a.b.c") == []
    named = f"my.service_name.{token}"
    assert secrets.spans_of(named) == [(len(named) - len(token), len(named), "token")]
    for text in ("z" * 1_000_000, "z.y" * 300_000, "-----BEGIN A-----" * 50_000):
        assert secrets.spans_of(text) == []
    many = secrets.confirmed_spans(f"{token} {coded}\n" * 2_000)
    assert len(many) == 4_000 and all(b > a for (_, a, _), (b, _, _) in zip(sorted(many), sorted(many)[1:]))
    both = 'é Password = "abcdefgh" token: short AKIAABCDEFGHIJKL'
    assert secrets.spans_of(both) == [(2, 22, "assign"), (both.index("AKIA"), len(both), "access")]
    assert secrets.base_spans("é api_key=abcdefgh") == [(2, 18, "assign")]
    assert secrets.base_spans("token: secret: longvalue123") == []
    docs = spark.createDataFrame([(1, "x token=12345678 y", 0), (2, None, 0), (2, "", 0), (None, "a" * 40, 0)], "doc_id bigint, text string, spans int")
    out = sorted(((r.doc_id or 0), r.n_assign, r.n_hex, r.spans) for r in secrets.digest(secrets.find_secrets(docs)).collect())
    assert out == [(0, 0, 1, "hex:0:40"), (1, 1, 0, "assign:2:16"), (2, 0, 0, ""), (2, 0, 0, "")]
    clean = sorted((r.doc_id or 0, r.text or "") for r in secrets.redact_secrets(docs).collect())
    assert clean == [(0, "[SECRET]"), (1, "x [SECRET] y"), (2, ""), (2, "")]


def test_packing(spark):
    rows = [(i, "x" * (i * 37 % 3000), 1) for i in range(400)] + [(900, None, 1), (900, None, 1), (901, "y" * 20_000, 1), (901, "y" * 20_000, 1), (None, "z" * 5_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length int")
    out = packing.pack_documents(docs, (512, 1024, 2048)).collect()
    bins = {}
    for r in out:
        bins.setdefault(r.bin_id, []).append(r)
    for held in bins.values():
        held.sort(key=lambda r: r.offset)
        at = 0
        for r in held:
            assert r.offset == at
            at += r.length
        assert at == held[0].fill <= held[0].capacity and held[0].capacity == min(c for c in (512, 1024, 2048) if c >= at)
    assert sum(r.length for r in out) == sum(len(t or "") + 1 for _, t, _ in rows)
    assert sum(r.length for r in out if r.doc_id == 901) == 2 * 20_001
    assert sum(r.capacity for r in out if r.offset == 0) <= 1.06 * sum(r.length for r in out)
    assert packing.pack_documents(docs.filter("false")).count() == 0


def test_best_fit_picks_the_tightest_bin():
    bins, offsets, sizes, fills = packing.pack([70, 60, 38, 30, 2], (64, 100), (64.0, 100.0))
    assert bins == [0, 1, 1, 0, 1] and fills == [100, 100] and sizes == [100, 100] and offsets == [0, 0, 60, 70, 98]


def test_url_lists(spark):
    day = lambda n: datetime.date(2024, 1, n)
    entries = [
        ("b", "domain", "example.com", "block", "add", day(5)), ("b", "domain", "example.com", "block", "remove", day(10)),
        ("a", "domain", "sub.example.com", "allow", "add", day(6)), ("c", "address", "example.com/x", "allow", "add", day(1)),
        ("z", "domain", "example.com", "block", "add", day(7)), ("z", "domain", "example.com", "block", "remove", day(7)),
        (None, "domain", "other.com", "block", "add", day(1)), ("b", "other", "other.com", "block", "add", day(1)),
    ]
    lists = spark.createDataFrame(entries, "list_name string, kind string, pattern string, verdict string, action string, dated date")
    captures = [
        (1, "http://example.com/", day(4)), (2, "http://EXAMPLE.com:80/y", day(5)), (3, "http://a.sub.example.com/", day(6)),
        (4, "https://www.example.com/x/?q", day(6)), (5, "http://a.example.com/", day(10)), (6, "http://notexample.com/", day(6)),
        (7, None, day(6)), (8, "http://example.com/", None), (9, "mailto:x", day(6)), (2, "http://EXAMPLE.com:80/y", day(5)),
    ]
    frame = spark.createDataFrame([(*c, "old") for c in captures], "id int, url string, fetched date, verdict string")
    out = sorted((r.id, r.verdict, r.list_name) for r in url_filter.evaluate(frame, lists).collect())
    assert out == [
        (1, "pass", None), (2, "block", "b"), (2, "block", "b"), (3, "allow", "a"), (4, "allow", "c"), (5, "block", "z"),
        (6, "pass", None), (7, "pass", None), (8, "pass", None), (9, "pass", None),
    ]
    assert url_filter.evaluate(frame.filter("false"), lists).count() == 0
    assert {r.verdict for r in url_filter.evaluate(frame, lists.filter("false")).collect()} == {"pass"}


def test_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.parametrize("rows", [0, 4])
def test_pipeline_stages(spark, rows, tmp_path):
    long = " ".join(f"word{i} stands here" for i in range(40))
    leak = "what is the name of the largest city in the far north. it is called northville by all."
    docs = [(1, f"{long} token=12345678", "en", "s", 3), (2, f"{long} token=12345678", "en", "s", 3), (3, f"we know {leak} right", "en", "s", 1), (4, "123", None, None, None)]
    spark.createDataFrame(docs[:rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, str(tmp_path))
        assert out.columns == frame.columns
        kept.append(sorted(r.doc_id for r in out.collect()))
        frame = spark.createDataFrame(out.collect(), frame.schema)
    if rows:
        assert kept == [[1, 2, 3], [1, 3], [1], [1]] and frame.first().text.endswith("[SECRET]")
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == ({1} if rows else set())


def test_stages_decide_by_row(spark, tmp_path):
    leak = "what is the name of the largest city in the far north. it is called northville by all."
    clean = " ".join(f"word{i} stands here" for i in range(40))
    other = " ".join(f"thing{i} lies there" for i in range(40))
    docs = [(None, f"we know {leak} right"), (None, clean), (1, f"we know {leak} right"), (1, clean), (1, other), (2, clean)]
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = lambda df: sorted((r.doc_id or 0, r.text) for r in df.collect())
    assert rows(corpus_pipeline.decontamination(spark, frame, str(tmp_path))) == sorted([(0, clean), (1, clean), (1, other), (2, clean)])
    kept = rows(corpus_pipeline.near_dedup(spark, frame, str(tmp_path)))
    assert kept == sorted([(0, docs[0][1]), (0, clean), (1, docs[2][1]), (1, clean), (1, other)])
