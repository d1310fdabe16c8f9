"""The stored index: ids in buckets, snapshots of progress."""

import pytest
from helpers import info, members, uuid, wet, write

from webcorpus.operators.selection import first_by_id
from webcorpus.plans import files, store as stores
from webcorpus.plans.buckets import BUCKETS_PER_SHARD, IdTable, absent
from webcorpus.plans.populate import populate
from webcorpus.plans.store import Store


@pytest.fixture
def corpus(spark, tmp_path):
    for o in range(20):
        write(tmp_path, f"{o:03d}.gz", members(info(f"{o}"), wet(o), wet(100 + o), wet(1)))
    rows = [(f"0103{o:08x}", o, f"{o:03d}.gz") for o in range(20)]
    listed = spark.createDataFrame(rows, "object_key STRING, object_index BIGINT, path STRING")
    store = Store(spark, str(tmp_path / "store"))
    return store.open(store.create_index("cc-wet2024", "cc-wet", number_of_shards=2)), listed, str(tmp_path)


def test_stored_ids_are_not_moved(spark, tmp_path):
    table = IdTable(spark, str(tmp_path / "ids"), 2)
    ids = spark.range(500).selectExpr("md5(cast(id AS string)) AS doc_id", "id AS pos")
    table.append(ids.filter("pos < 200"), 1, "zstd")
    table.append(ids.filter("pos BETWEEN 200 AND 299"), 2, "zstd")
    new = absent(first_by_id(ids), table.read([1, 2]))
    plan = new._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    (scan,) = [i for i, line in enumerate(plan) if "FileScan" in line]
    assert "Bucketed: true" in plan[scan]
    above, level = [], depth(plan[scan])
    for line in reversed(plan[:scan]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    assert not any("Exchange" in line for line in above) and len(above) >= 3
    assert not any("Sort " in line.split("Join")[0] for line in above[:3])
    assert new.count() == 200
    assert table.buckets == 2 * BUCKETS_PER_SHARD


def test_runs_that_were_not_committed_are_not_read(spark, tmp_path):
    table = IdTable(spark, str(tmp_path / "ids"), 1)
    ids = spark.range(100).selectExpr("cast(id AS string) AS doc_id", "id AS pos")
    table.append(ids.filter("pos < 10"), 1, "zstd")
    table.append(ids, 2, "zstd")
    assert table.read([1]).count() == 10
    table.append(ids.filter("pos < 30"), 2, "zstd")
    assert table.read([1, 2]).count() == 40
    table.drop()
    assert IdTable(spark, str(tmp_path / "ids"), 1).read([2]).count() == 30


def test_an_index_without_snapshot_or_with_gives_the_same(spark, corpus, monkeypatch):
    monkeypatch.setattr(stores, "SNAPSHOT", 3)
    index, listed, base = corpus
    populate(index, listed, base, window=2)
    assert files.children(spark, f"{index.path}/snapshots") == ["upto=6", "upto=9"]
    assert files.children(spark, f"{index.path}/progress") == ["run_id=10", "run_id=7", "run_id=8", "run_id=9"]
    assert {r.doc_id for r in index.documents().collect()} == {uuid(i) for o in range(20) for i in (o, 100 + o, 1)}
    states = {r.object_key: r for r in index.states().collect()}
    assert len(states) == 20 and all(r.done and r.next_record_idx == 3 for r in states.values())
    assert sorted(r.run_id for r in index.run_list()) == list(range(1, 11)) == index.committed()
    assert sum(r.created for r in index.progress().collect()) == 40
    assert populate(index, listed, base).runs == 0


def test_calls_do_not_grow_with_runs(spark, corpus, monkeypatch):
    monkeypatch.setattr(stores, "SNAPSHOT", 2)
    index, listed, base = corpus
    calls, real = [0], files._fs

    def counted(*args):
        calls[0] += 1
        return real(*args)

    monkeypatch.setattr(files, "_fs", counted)
    seen = []
    for o in range(7):
        calls[0] = 0
        index.states()
        index.run_list()
        seen.append(calls[0])
        populate(index, listed.filter(f"object_index = {o}"), base)
    assert max(seen) <= 4 * (1 + 2 * stores.SNAPSHOT)


def test_a_crash_while_the_snapshot_is_taken(spark, corpus, monkeypatch):
    monkeypatch.setattr(stores, "SNAPSHOT", 2)
    index, listed, base = corpus
    with monkeypatch.context() as m:
        m.setattr(stores, "RUNS", "no schema")
        with pytest.raises(Exception):
            populate(index, listed.filter("object_index < 4"), base, window=2)
    populate(index, listed, base, window=5)
    assert len(index.documents().collect()) == 40 and index.states().count() == 20
