import pytest
from helpers import info, members, record, uuid, wet, write
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from webcorpus.functions.keys import COLLECTIONS
from webcorpus.operators.mappings import Mapping
from webcorpus.plans import files, populate as plan
from webcorpus.plans.populate import populate
from webcorpus.plans.store import Store
from webcorpus.streaming.stream import populate_stream

PER_OBJECT = 6


def expected(objects):
    """id -> (object, record) of its first occurrence, in visit order."""
    first = {}
    for o, ids in enumerate(objects):
        for r, i in enumerate(ids):
            first.setdefault(uuid(i), (o, r + 1))
    return first


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Twelve objects; one id in three is a copy of the first document."""
    folder, objects = tmp_path_factory.mktemp("corpus"), []
    for o in range(12):
        ids = [1 if n % 3 == 2 else 100 * o + n + 1 for n in range(PER_OBJECT)]
        objects.append(ids)
        write(folder, f"{o:03d}.warc.wet.gz", members(info(f"{o}"), *[wet(i, f"{o}/{r}".encode()) for r, i in enumerate(ids)]))
    rows = [(f"0103{o:08x}", o, f"{o:03d}.warc.wet.gz") for o in range(12)]
    listed = spark.createDataFrame(rows, "object_key STRING, object_index BIGINT, path STRING")
    return str(folder), objects, listed


@pytest.fixture
def index(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    return store.open(store.create_index("cc-wet2024", "cc-wet", "best_compression"))


def stored(index):
    rows = index.documents().select("doc_id", "object_index", "record_idx", "doc.content").collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: (r.object_index, r.record_idx) for r in rows}


def test_everything_once_and_again_nothing(index, corpus):
    base, objects, listed = corpus
    done = populate(index, listed, base)
    want = expected(objects)
    assert stored(index) == want
    assert (done.created, done.already_exists, done.objects) == (len(want), 72 - len(want), 12)
    again = populate(index, listed, base)
    assert (again.runs, again.created) == (0, 0) and stored(index) == want
    assert all(r.done for r in index.progress().collect())


@pytest.mark.parametrize("budgets, window", [([1, 4, None], 5), ([7, 8, 100], 4096), ([0, 3], 1)])
def test_budgets_add_up(index, corpus, budgets, window, monkeypatch):
    monkeypatch.setattr(plan, "FIRST_WINDOW", 2)
    base, objects, listed = corpus
    want, total = list(expected(objects).items()), 0
    for n in budgets:
        done = populate(index, listed, base, n=n, window=window)
        left = len(want) - total
        assert done.created == (left if n is None else min(n, left))
        total += done.created
        if total:
            assert stored(index) == dict(want[:total])


def test_small_windows_give_the_same_index(index, corpus):
    base, objects, listed = corpus
    done = populate(index, listed, base, window=5)
    assert done.runs == 3 and stored(index) == expected(objects)


def test_many_losses_are_rewritten(index, corpus, monkeypatch):
    monkeypatch.setattr(plan, "LOST_ROWS", 3)
    base, objects, listed = corpus
    populate(index, listed.filter("object_index < 4"), base, window=1)
    assert stored(index) == expected(objects[:4])
    kinds = {r.data for r in index.runs().select("data").distinct().collect()}
    assert kinds == {"staged", "kept"} and index.lost_count() <= 3


def test_whole_objects_without_extension(spark, index, corpus, tmp_path):
    base, objects, listed = corpus
    for o in range(3):
        write(tmp_path, f"{o:012x}", open(f"{base}/{o:03d}.warc.wet.gz", "rb").read())
    rows = [(f"0103{o:08x}", o, f"{o:012x}") for o in range(3)]
    served = spark.createDataFrame(rows, "object_key STRING, object_index BIGINT, path STRING")
    populate(index, served, str(tmp_path), whole=True)
    assert stored(index) == expected(objects[:3])
    # Keys do not depend on the source: going on with the listed files skips those three.
    rest = populate(index, listed, base)
    assert rest.objects == 9 and stored(index) == expected(objects)


def test_interrupted_run_leaves_no_trace(spark, index, corpus, monkeypatch):
    base, objects, listed = corpus
    populate(index, listed.filter("object_index < 4"), base)
    before = stored(index)

    def crash(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(plan, "object_progress", crash)
        with pytest.raises(RuntimeError):
            populate(index, listed, base)
    assert files.exists(spark, f"{index.path}/outcomes/run_id=2") and stored(index) == before
    populate(index, listed, base)
    assert stored(index) == expected(objects)


def test_malformed_objects(spark, index, tmp_path):
    bad_header = record([("A", "1")], b"abc", length=False)
    write(tmp_path, "a.gz", members(info(), wet(1), wet(2, **{"WARC-Target-URI": "not a url"}), wet(3)))
    write(tmp_path, "b.gz", members(info(), wet(4), bad_header, wet(5)))
    write(tmp_path, "c.gz", members(b"garbage"))
    write(tmp_path, "d.gz", members(info()))
    write(tmp_path, "e.gz", members(b"".join([info(), wet(6), wet(7, b"x" * 100)])[:-60]))
    write(tmp_path, "f.gz", b"no gzip at all")
    write(tmp_path, "g.gz", members(info(), wet(8)) + members(wet(9, b"y" * 5000))[:-30])
    write(tmp_path, "h.gz", b"")
    rows = [(f"0103{i:08x}", i, f"{n}.gz") for i, n in enumerate("abcdefgh")]
    listed = spark.createDataFrame(rows, "object_key STRING, object_index BIGINT, path STRING")
    done = populate(index, listed, str(tmp_path))
    assert set(stored(index)) == {uuid(i) for i in (1, 3, 4, 6, 8)} and done.rejected == 7
    reasons = {(r.object_index, r.record_idx): r.reject_reason for r in index.rejects().collect()}
    assert reasons == {
        (0, 2): "bad target_uri",
        (1, 2): "parse: missing_content_length",
        (2, 0): "parse: invalid_version",
        (4, 2): "parse: truncated",
        (5, 0): "parse: bad_gzip",
        (6, 2): "parse: bad_gzip",
        (7, 0): "parse: bad_gzip",
    }
    state = {r.object_key[-1]: (r.next_record_idx, r.done, r.created) for r in index.progress().collect()}
    assert state == {
        "0": (3, True, 2), "1": (1, False, 1), "2": (0, False, 0), "3": (0, True, 0), "4": (1, False, 1),
        "5": (0, False, 0), "6": (1, False, 1), "7": (0, False, 0),
    }
    # Broken objects are settled; tried again on request, they give nothing new and no second reject.
    assert populate(index, listed, str(tmp_path)).runs == 0
    again = populate(index, listed, str(tmp_path), retry_failed=True)
    assert (again.objects, again.created, again.rejected) == (6, 0, 0)
    assert {(r.object_index, r.record_idx): r.reject_reason for r in index.rejects().collect()} == reasons
    # A mended object goes on where it stopped, and its reject is gone.
    write(tmp_path, "g.gz", members(info(), wet(8), wet(9), wet(10)))
    mended = populate(index, listed, str(tmp_path), retry_failed=True)
    assert (mended.created, mended.rejected) == (2, -1)
    assert (6, 2) not in {(r.object_index, r.record_idx) for r in index.rejects().collect()}


def test_missing_objects_hold_up_nothing(spark, index, corpus):
    base, objects, listed = corpus
    rows = [("0103000000f%d" % i, i, f"none{i}.gz") for i in (0, 5, 99)]
    gone = spark.createDataFrame(rows, "object_key STRING, object_index BIGINT, path STRING")
    done = populate(index, listed.unionByName(gone), base, window=4)
    assert stored(index) == expected(objects) and (done.objects, done.rejected) == (15, 3)
    assert {r.reject_reason for r in index.rejects().collect()} == {"parse: missing_object"}
    assert populate(index, listed.unionByName(gone), base).runs == 0


def test_objects_that_share_an_index(spark, index, corpus):
    """Two and three of them, on both sides of a window's border."""
    base, objects, listed = corpus
    shared = listed.withColumn("object_index", F.floor(F.col("object_index") / 5).cast("bigint"))
    populate(index, shared, base, n=7, window=2)
    populate(index, shared, base, window=2)
    rows = index.documents().select("doc_id", "object_key", "object_index", "record_idx").collect()
    want = expected(objects)
    assert {r.doc_id: (int(r.object_key[4:], 16), r.record_idx) for r in rows} == want and len(rows) == len(want)
    assert {(r.object_key, r.object_index) for r in rows} == {(f"0103{o:08x}", o // 5) for o, _ in want.values()}


def test_a_repeated_key_is_refused(spark, index, corpus):
    base, _, listed = corpus
    with pytest.raises(ValueError, match="more than once"):
        populate(index, listed.unionByName(listed.limit(1)), base)


@pytest.mark.parametrize("whole", [False, True])
def test_other_file_systems_go_through_sparks_readers(spark, index, corpus, monkeypatch, whole):
    monkeypatch.setattr(plan, "readable", lambda path: False)
    base, objects, listed = corpus
    gone = spark.createDataFrame([("0103000000ff", 3, "none.gz")], "object_key STRING, object_index BIGINT, path STRING")
    done = populate(index, listed.unionByName(gone), base, whole=whole)
    assert stored(index) == expected(objects) and done.rejected == 1


def test_budget_that_ends_with_an_object_finishes_it(spark, index, corpus):
    base, objects, listed = corpus
    n = len(expected(objects[:1]))
    populate(index, listed, base, n=n - 1)
    assert [r.done for r in index.progress().collect()] == [False]
    populate(index, listed, base, n=1)
    # The last record of the object is a copy and lies beyond the cut.
    assert [(r.next_record_idx, r.done) for r in index.progress().collect()] == [(5, False)]


def test_user_mapping_and_source(spark, tmp_path, corpus):
    base, objects, listed = corpus
    schema = StructType([StructField("size", StringType())])

    def transform(pairs):
        return pairs.select(
            "object_key", "object_index", "record_idx", F.col("headers")["WARC-Record-ID"].alias("doc_id"),
            F.struct(F.col("content_bytes").cast("string").alias("size")).alias("doc"), F.lit(None).cast("string").alias("reject_reason"),
        )

    mine = Mapping("sizes", frozenset(COLLECTIONS.values()), schema, transform)
    store = Store(spark, str(tmp_path / "s"))
    uuid_ = store.create_index("cc-warc2024", "sizes", user_mapping=mine, enable_source=True)
    mine_index = store.open(uuid_, user_mapping=mine)
    populate(mine_index, listed, base, refresh=True)
    row = mine_index.documents().filter("object_index = 11 AND record_idx = 1").first()
    assert row.doc.size == "4" and row._source == '{"size":"4"}'
    with pytest.raises(ValueError):
        store.create_index("cc-text", "sizes", user_mapping=mine)


def test_stream_picks_up_new_files(spark, index, corpus, tmp_path):
    base, objects, listed = corpus
    source, offsets = tmp_path / "in", str(tmp_path / "offsets")
    source.mkdir()
    numbered = listed.withColumn("path", F.concat(F.lit(f"file:{source}/"), "path"))
    for batch in (range(0, 5), range(5, 12)):
        for o in batch:
            write(source, f"{o:03d}.warc.wet.gz", open(f"{base}/{o:03d}.warc.wet.gz", "rb").read())
        populate_stream(index, str(source), numbered, offsets, max_files=3).awaitTermination()
        assert stored(index) == expected(objects[: batch[-1] + 1])
    # Delivered again from the start: nothing is created twice.
    populate_stream(index, str(source), numbered, str(tmp_path / "other"), max_files=12).awaitTermination()
    assert stored(index) == expected(objects)


@pytest.mark.parametrize("name", ["with space", "per%20cent", "plus+sign", "kéy=välue"])
def test_odd_folders_lose_nothing(spark, index, tmp_path, name):
    folder = tmp_path / name
    folder.mkdir()
    write(folder, "000.warc.wet.gz", members(info("0"), wet(1, b"a"), wet(2, b"b")))
    listed = spark.createDataFrame([("010300000000", 0, f"{name}/000.warc.wet.gz")], "object_key STRING, object_index BIGINT, path STRING")
    done = populate(index, listed, str(tmp_path))
    assert done.created == 2 and set(stored(index)) == {uuid(1), uuid(2)}


def test_stream_takes_the_batch_listing(spark, index, corpus, tmp_path):
    base, objects, listed = corpus
    populate_stream(index, base, listed, str(tmp_path / "cp"), base=base).awaitTermination()
    assert stored(index) == expected(objects)


def test_stream_stops_at_files_it_does_not_know(spark, index, corpus, tmp_path):
    base, objects, listed = corpus
    part = listed.filter("object_index < 5")
    with pytest.raises(Exception, match="not in the listing"):
        populate_stream(index, base, part, str(tmp_path / "cp"), base=base).awaitTermination()
    # Nothing was committed: with the whole listing the same checkpoint gives everything.
    populate_stream(index, base, listed, str(tmp_path / "cp"), base=base).awaitTermination()
    assert stored(index) == expected(objects)
