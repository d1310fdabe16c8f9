"""Bodies in few files, outcomes from replies, served listings cut by many tasks, late listings."""

import json

import pytest
from helpers import info, members, uuid, wet, write
from pyspark.sql import functions as F

from webcorpus.operators import bulk
from webcorpus.plans.store import Store
from webcorpus.sources import bodies, served
from webcorpus.sources.manifest import checked_entries, completed_objects, rejected_entries
from webcorpus.streaming.late import MET, populate_listed_stream


def rendered(spark, rows=200, cap=500):
    doc = F.struct(F.repeat(F.lit("xé"), F.col("id").cast("int") % 40).alias("text"))
    docs = spark.range(1, rows).select(
        (F.col("id") % 3).cast("string").alias("object_key"), F.col("id").alias("record_idx"), F.col("id").cast("string").alias("doc_id"), doc.alias("doc")
    )
    return bulk.render_bulk(docs, "ix", cap=cap)


def test_bodies_in_few_files(spark, tmp_path):
    path, cap = str(tmp_path / "b"), 130
    docs = rendered(spark, cap=cap)
    rejects = {r.record_idx: r for r in bodies.store_bodies(docs, path, cap=cap, segment=8).collect()}
    pieces = {}
    for r in bodies.read_bodies(spark, path).collect():
        pieces.setdefault((r.object_key, r.batch_no), []).append((r.piece, bytes(r.body)))
    want = {}
    numbers = {(r.object_key, r.record_idx): r.batch_no for r in bulk.pack_batches(docs, cap, 8).collect()}
    for r in docs.orderBy("record_idx").collect():
        if r.n_bytes > cap:
            assert (rejects[r.record_idx].n_bytes, rejects[r.record_idx].reject_reason) == (r.n_bytes, "oversize")
        else:
            key = r.object_key, numbers[r.object_key, r.record_idx]
            want[key] = want.get(key, b"") + r.payload.encode()
    assert {key: b"".join(body for _, body in sorted(found)) for key, found in pieces.items()} == want
    assert rejects and all(len(body) <= cap for body in want.values())
    files = list((tmp_path / "b" / "bodies").iterdir())
    assert len(files) < len(want) / 2 and len(list((tmp_path / "b").iterdir())) == 3


def test_parts_of_failed_attempts_are_not_read(spark, tmp_path):
    path = str(tmp_path / "b")
    bodies.store_bodies(rendered(spark), path, cap=500, segment=64)
    before = bodies.body_index(spark, path).count()
    part = next((tmp_path / "b" / "index").iterdir())
    (part.parent / "part-99999-lost.parquet").write_bytes(part.read_bytes())
    assert bodies.body_index(spark, path).count() == before > 0


def test_no_bodies(spark, tmp_path):
    rejects = bodies.store_bodies(rendered(spark, cap=3), str(tmp_path / "b"), cap=3)
    assert rejects.count() == 199 and bodies.read_bodies(spark, str(tmp_path / "b")).count() == 0


def test_replies_by_position(spark):
    sent = spark.createDataFrame([("a", i, i // 4) for i in range(12)] + [("b", 1, 0)], "object_key STRING, record_idx BIGINT, batch_no BIGINT")
    conflict = {"type": "version_conflict_engine_exception"}
    item = lambda status, error=None: {"create": {"_id": "same", "status": status, **({"error": error} if error else {})}}
    answers = {
        0: [item(201), item(409, conflict), item(400, {"type": "mapper_parsing_exception"}), item(201)],
        1: [item(201), item(429, {"type": "busy"}), item(201), item(503, {"type": "down"})],
        2: [item(201), item(201)],  # too short: the last two are unanswered
    }
    rows = [("a", n, json.dumps({"errors": True, "items": items})) for n, items in answers.items()]
    rows.append(("b", 0, json.dumps({"errors": False, "items": [item(200)]})))
    replies = spark.createDataFrame(rows, "object_key STRING, batch_no BIGINT, reply STRING")
    found = bulk.reply_outcomes(sent, replies)
    told = {(r.object_key, r.record_idx): (r.outcome, r.error, r.retry) for r in found.collect()}
    assert [told["a", i] for i in range(12)] == [
        ("created", None, False), ("already_exists", None, False), ("failed", "mapper_parsing_exception", False), ("created", None, False),
        ("created", None, False), ("failed", "busy", True), ("created", None, False), ("failed", "down", True),
        ("created", None, False), ("created", None, False), ("failed", "no_reply", True), ("failed", "no_reply", True),
    ]
    refused = spark.createDataFrame([("b", 2), ("c", 1)], "object_key STRING, record_idx BIGINT")
    progress, again = bulk.reply_progress(found, refused)
    state = {r.object_key: (r.next_record_idx, r.done, r.created, r.already_exists, r.failed, r.rejected) for r in progress.collect()}
    assert state == {"a": (4, False, 3, 1, 1, 0), "b": (2, True, 1, 0, 0, 1), "c": (1, True, 0, 0, 0, 1)}
    assert sorted((r.object_key, r.record_idx) for r in again.collect()) == [("a", 5), ("a", 7), ("a", 10), ("a", 11)]


KEYS = ["010300000001", "0103000000FF", "zz", "ffff00000000", "010900000001", None]


def entry(i, key):
    text = ['plain', 'a "quote" [', 'back\\slash\\', '},{', 'é' * 50][i % 5]
    return {"db_key": key, "s3_key": f"{text}{i}", "status": {"Completed": {"content_length": i, "data_location": {"S3Key": "]["}}}}


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_listing_in_ranges(spark, tmp_path, size, indent):
    rows = [entry(i, KEYS[i % len(KEYS)]) for i in range(12 if size == 7 else 60)]
    (tmp_path / "m.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=indent is None))
    (tmp_path / "n.json").write_text("[]")
    data = (tmp_path / "m.json").read_bytes()
    if size == 7:  # every cut of the file, without Spark
        cut = [text for start in range(0, len(data), size) for _, text in cut_alone(str(tmp_path / "m.json"), data, start, size)]
        assert [json.loads(t) for t in cut] == rows
        return
    found = served.read_served_entries(spark, [str(tmp_path / "m.json"), str(tmp_path / "n.json")], size=size).orderBy("offset").collect()
    errors = [None, None, "not_hex", "invalid_section", "unknown_collection", "missing_key"]
    assert [(r.path, r.error, r.object_index) for r in found] == [
        (row["s3_key"], errors[i % 6], [1, 255, None, None, None, None][i % 6]) for i, row in enumerate(rows)
    ]


def cut_alone(path, data, start, size):
    before = served._marks(data[:start], False)[0] if start else None
    inside = bool(before.sum() % 2) if start else False
    depth = int(served._depths(data[:start], *served._marks(data[:start], False)).sum()) if start else 0
    yield from served.entries_of(path, start, min(start + size, len(data)), inside, depth)


def test_listing_that_is_cut_off(spark, tmp_path):
    whole = json.dumps([entry(0, KEYS[0]), entry(1, KEYS[0])])
    (tmp_path / "cut.json").write_text(whole[:-30])
    found = served.read_served_entries(spark, [str(tmp_path / "cut.json")], size=50).orderBy("offset").collect()
    assert [r.error for r in found] == [None, "cut_off"]


def test_wrong_keys_are_seen_whatever_is_read(spark):
    rows = [entry(i, key) for i, key in enumerate(KEYS)]
    from webcorpus.sources.manifest import SERVED_SCHEMA

    df = spark.read.schema(SERVED_SCHEMA).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))
    for read in (lambda d: d.count(), lambda d: d.select("path").collect()):
        with pytest.raises(Exception, match="malformed key"):
            read(completed_objects(df))
    assert completed_objects(df, strict=False).count() == 2
    assert sorted(r.error for r in rejected_entries(df).collect()) == ["invalid_section", "missing_key", "not_hex", "unknown_collection"]
    assert checked_entries(df).count() == len(KEYS)


def test_files_wait_for_their_listing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    index = store.open(store.create_index("cc-wet2024", "cc-wet"))
    source, listing, offsets = tmp_path / "in", str(tmp_path / "listing"), str(tmp_path / "offsets")
    source.mkdir()

    def step(files=(), listed=()):
        for o in files:
            write(source, f"{o}.gz", members(info(), wet(o)))
        rows = [(f"0103{o:08x}", o, f"{o}.gz") for o in listed]
        spark.createDataFrame(rows, MET).coalesce(1).write.mode("append").parquet(listing)
        stream = spark.readStream.schema(MET).parquet(listing)
        populate_listed_stream(index, str(source), stream, offsets, base=str(source)).awaitTermination()
        return {r.doc_id for r in index.documents().collect()} if index.run_list() else set()

    assert step(files=[1, 2]) == set()
    assert step(files=[3], listed=[4]) == set()
    assert step(listed=[1, 3]) == {uuid(1), uuid(3)}
    assert step(files=[4], listed=[2]) == {uuid(i) for i in (1, 2, 3, 4)}


def test_small_ranges_of_a_listing_share_tasks(spark, tmp_path):
    rows = [entry(i, KEYS[0]) for i in range(200)]
    (tmp_path / "m.json").write_text(json.dumps(rows))
    most = 4 * spark.sparkContext.defaultParallelism
    assert (tmp_path / "m.json").stat().st_size // 64 > 2 * most
    found = served.read_served_entries(spark, [str(tmp_path / "m.json")], size=64)
    assert found.rdd.getNumPartitions() <= most
    assert [r.path for r in found.orderBy("offset").collect()] == [row["s3_key"] for row in rows]
