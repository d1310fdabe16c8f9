import json
import random

import pytest
from pyspark.sql import functions as F

from webcorpus.operators import bulk


def greedy(sizes, cap):
    batch, fill, out = 0, 0, []
    for n in sizes:
        if fill + n > cap:
            batch, fill = batch + 1, 0
        fill += n
        out.append(batch)
    return out


@pytest.mark.parametrize("segment", [1, 3, 16, 1 << 17])
@pytest.mark.parametrize("kind", ["mixed", "equal", "tiny", "full"])
def test_packing_is_greedy_whatever_the_segments(spark, segment, kind):
    rng = random.Random(f"{segment}{kind}")
    size = {"mixed": lambda: rng.choice([1, 5, 30, 60, 99, 100]), "equal": lambda: 30, "tiny": lambda: 1, "full": lambda: 100}[kind]
    objects = {f"o{k}": [size() for _ in range(n)] for k, n in enumerate((1, 40, 400))}
    start = 17  # a resumed object does not begin at its first record
    rows = [(k, start + i, n) for k, sizes in objects.items() for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "object_key STRING, record_idx BIGINT, n_bytes BIGINT").repartition(5)
    got = {}
    for r in bulk.pack_batches(df, cap=100, segment=segment).orderBy("object_key", "record_idx").collect():
        got.setdefault(r.object_key, []).append(r.batch_no)
    assert got == {k: greedy(sizes, 100) for k, sizes in objects.items()}


def test_packing_leaves_out_what_no_body_can_hold(spark):
    df = spark.createDataFrame([("o", 1, 60), ("o", 2, 101), ("o", 3, 40), ("o", 4, 1)], "object_key STRING, record_idx BIGINT, n_bytes BIGINT")
    rows = bulk.pack_batches(df, cap=100).orderBy("record_idx").collect()
    assert [(r.record_idx, r.batch_no) for r in rows] == [(1, 0), (3, 0), (4, 1)]


def test_rendered_lines(spark):
    doc = F.struct(F.lit('say "hi"\n\\ é').alias("text"), F.timestamp_seconds(F.lit(0)).alias("at"), F.lit(None).cast("string").alias("none"))
    row = bulk.render_bulk(spark.range(1).select(F.lit("i").alias("doc_id"), doc.alias("doc")), "ix").first()
    action, body = row.payload.splitlines()
    assert action == '{"create":{"_id":"i","_index":"ix"}}'
    assert body == '{"at":"1970-01-01T00:00:00Z","none":null,"text":"say \\"hi\\"\\n\\\\ é"}'
    assert row.payload.endswith("\n") and row.n_bytes == len(row.payload.encode()) and row.reject_reason is None
    over = bulk.render_bulk(spark.range(1).select(F.lit("i").alias("doc_id"), doc.alias("doc")), "ix", cap=50).first()
    assert over.reject_reason == "oversize"


def test_replies(spark):
    item = lambda i, status, kind=None: {"create": {"_id": i, "_index": "ix", "status": status, **({"error": {"type": kind, "x": 1}} if kind else {})}}
    conflict = "version_conflict_engine_exception"
    reply = {"took": 1, "errors": True, "items": [item("a", 201), item("b", 409, conflict), item("c", 409, "other"), item("d", 400, conflict), item("e", 429, "busy")]}
    clean = {"errors": False, "items": [item("f", 201), item("g", 200)]}
    df = spark.createDataFrame([(0, json.dumps(reply)), (1, json.dumps(clean))], "bulk INT, reply STRING")
    rows = {r.doc_id: r for r in bulk.bulk_response_rows(df).collect()}
    assert [rows[i].outcome for i in "abcdefg"] == ["created", "already_exists", "failed", "failed", "failed", "created", "created"]
    assert rows["b"].error_type == conflict and rows["b"].status == 409
    tally = {r.bulk: (r.created, r.already_exists, r.failed) for r in bulk.tally_outcomes(bulk.bulk_response_rows(df), ["bulk"]).collect()}
    assert tally == {0: (1, 1, 3), 1: (2, 0, 0)}


def test_bodies_hold_every_line_in_order(spark, tmp_path):
    doc = F.struct(F.repeat(F.lit("x"), F.col("id").cast("int") % 40).alias("text"))
    docs = spark.range(1, 200).select((F.col("id") % 3).cast("string").alias("object_key"), F.col("id").alias("record_idx"), F.col("id").cast("string").alias("doc_id"), doc.alias("doc"))
    bulk.write_bodies(bulk.render_bulk(docs, "ix"), str(tmp_path / "b"), cap=500, segment=8)
    bodies = sorted((tmp_path / "b").glob("object_key=*/batch_no=*"), key=lambda p: (p.parent.name, int(p.name.split("=")[1])))
    ids = {}
    for body in bodies:
        (part,) = body.glob("*.txt")
        text = part.read_bytes()
        assert 0 < len(text) <= 500 and text.endswith(b"\n")
        lines = [json.loads(line) for line in text.splitlines()]
        ids.setdefault(body.parent.name[-1], []).extend(int(a["create"]["_id"]) for a in lines[::2])
    assert ids == {str(k): [i for i in range(1, 200) if i % 3 == k] for k in range(3)}
