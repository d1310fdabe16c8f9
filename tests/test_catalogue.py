import json

import pytest

from webcorpus.operators.catalogue import rekey
from webcorpus.sources.manifest import read_served_manifest
from webcorpus.operators import catalogue as ops
from webcorpus.operators import progress as progress_ops
from webcorpus.plans.store import Store

A, B, C = "a" * 22, "b" * 22, "c" * 22
CAT = "uuid STRING, index_name STRING, collection STRING, mapping STRING"


def catalogue(spark, *uuids):
    rows = [(u, f"index-{u}", "cc-wet2024", "cc-wet") for u in uuids]
    return spark.createDataFrame(rows, CAT)


def progress(spark, *rows):
    full = [(u, k, n, d, n, 0, 0, 0, 1) for u, k, n, d in rows]
    return spark.createDataFrame(full, progress_ops.SCHEMA)


def test_rekey_keeps_progress(spark):
    cat, prog = catalogue(spark, A, B), progress(spark, (A, "010300000000", 42, True), (B, "010300000001", 7, False))
    moves = spark.createDataFrame([(A, C)], "from_uuid STRING, to_uuid STRING")
    cat2, prog2, errors = ops.rekey(cat, prog, moves)
    assert {r.uuid for r in cat2.collect()} == {B, C} and errors.isEmpty()
    moved = prog2.filter(f"index_uuid = '{C}'").first()
    assert (moved.next_record_idx, moved.done) == (42, True) and prog2.count() == 2


@pytest.mark.parametrize(
    "move, error",
    [((A, A), None), ((A, B), "another index has the uuid"), ((C, "d" * 22), "no such index"), ((A, "short"), "invalid uuid length")],
)
def test_rekey_refusals(spark, move, error):
    cat, prog = catalogue(spark, A, B), progress(spark, (A, "010300000000", 42, True))
    moves = spark.createDataFrame([move], "from_uuid STRING, to_uuid STRING")
    cat2, prog2, errors = ops.rekey(cat, prog, moves)
    assert [r.error for r in errors.collect()] == ([error] if error else [])
    assert {r.uuid for r in cat2.collect()} == {A, B} and prog2.first().index_uuid == A


def test_register(spark):
    rows = catalogue(spark, B, "short", A, C, C)
    after, errors = ops.register(catalogue(spark, A), rows)
    assert sorted(r.uuid for r in after.collect()) == [A, B]
    assert sorted((r.uuid, r.error) for r in errors.collect()) == [
        (A, "another index has the uuid"), (C, "another index has the uuid"), (C, "another index has the uuid"), ("short", "invalid uuid length"),
    ]


def test_delete_twice_is_refused(spark):
    cat, prog = catalogue(spark, A, B), progress(spark, (A, "010300000000", 42, True), (B, "010300000000", 1, True))
    gone = spark.createDataFrame([(A,)], "uuid STRING")
    cat, prog, errors = ops.delete(cat, prog, gone)
    assert [r.uuid for r in cat.collect()] == [B] and [r.index_uuid for r in prog.collect()] == [B] and errors.isEmpty()
    assert [r.error for r in ops.delete(cat, prog, gone)[2].collect()] == ["no such index"]


def test_listing_order_counts_and_busy(spark):
    cat = catalogue(spark, B, A, C)
    prog = progress(spark, (B, "010300000000", 10, True), (B, "010300000001", 7, False), (C, "010300000000", 5, True))
    busy = spark.createDataFrame([(C,)], "uuid STRING")
    lines = [r.line for r in ops.list_indices(cat, prog, "table", busy).collect()]
    assert lines == [
        f"{A}\tindex-{A}\tcc-wet2024\tCcWet\t0", f"{B}\tindex-{B}\tcc-wet2024\tCcWet\t17", f"{C}\tindex-{C}\tcc-wet2024\tCcWet\tbusy",
    ]
    rows = [json.loads(r.line) for r in ops.list_indices(cat, prog, "json", busy).collect()]
    assert [(r["document_count"], r["busy"]) for r in rows] == [(0, False), (17, False), (None, True)]
    assert list(rows[0]) == ["busy", "collection", "document_count", "index_name", "mapping", "uuid"]


def test_resolve(spark):
    requests = spark.createDataFrame(
        [(1, f"index-{A}", None), (2, None, A), (3, "nope", None), (4, None, C), (5, None, None)], "i INT, index_name STRING, uuid STRING"
    )
    rows = {r.i: r for r in ops.resolve_index(requests, catalogue(spark, A)).collect()}
    assert all((rows[i].index_name, rows[i].uuid, rows[i].error) == (f"index-{A}", A, None) for i in (1, 2))
    assert [rows[i].error for i in (3, 4, 5)] == ["no such index", "no such index", "target must be set"]


def test_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.list().isEmpty()
    made = store.create_index("cc-wet2024", "cc-wet", uuid=B)
    assert made == B and store.open("cc-wet2024").uuid == B  # named after its collection
    other = store.create_index("cc-warc-2024", "raw", "best_compression", "mine", number_of_shards=3)
    assert len(other) == 22 and store.open("mine").compression == "zstd"
    for bad in [("cc-warc2024", "cc-wet", {}), ("cc-wet2024", "cc-wet", {}), ("cc-wet2024", "cc-wet", {"index_name": "x", "uuid": B}), ("cc-wet2024", "cc-wet", {"index_name": "y", "uuid": "short"}), ("cc-text", "raw", {"index_name": "z"})]:
        with pytest.raises(ValueError):
            store.create_index(bad[0], bad[1], **bad[2])
    store.rekey(B, B)
    store.rekey(B, A)
    with pytest.raises(ValueError):
        store.open(B)
    with pytest.raises(ValueError):
        store.rekey(A, other)
    assert [r.uuid for r in store.list().collect()] == sorted([A, other])
    assert store.delete(A, drop_data=True) is False  # nothing was ever written there
    with pytest.raises(ValueError):
        store.delete(A)
    assert [r.index_name for r in store.list().collect()] == ["mine"]


def test_rekey_refuses_repeated_ends(spark):
    u = lambda c: c * 22
    known = spark.createDataFrame([(u("a"),), (u("b"),), (u("c"),)], "uuid STRING")
    progress = spark.createDataFrame([(u("a"), 1), (u("b"), 2), (u("c"), 3)], "index_uuid STRING, n INT")
    moves = spark.createDataFrame([(u("a"), u("x")), (u("b"), u("x")), (u("c"), u("y")), (u("c"), u("z"))], "from_uuid STRING, to_uuid STRING")
    moved, state, errors = rekey(known, progress, moves)
    assert {r.uuid for r in moved.collect()} == {u("a"), u("b"), u("c")} and state.count() == 3
    assert {r.error for r in errors.collect()} == {"move is ambiguous"} and errors.count() == 4


def test_served_manifest_is_read_strictly(spark, tmp_path):
    done = '{"db_key": "%s", "s3_key": "p", "status": {"Completed": {"content_length": 1}}}'
    for name, text in (("cut", "[" + done % "010100000001" + ", {"), ("key", "[" + done % "zz" + "]")):
        (tmp_path / name).write_text(text)
        with pytest.raises(Exception):
            read_served_manifest(spark, str(tmp_path / name)).collect()
    (tmp_path / "good").write_text("[" + done % "010100000001" + "]")
    assert [r.object_index for r in read_served_manifest(spark, str(tmp_path / "good")).collect()] == [1]
