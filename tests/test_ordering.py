import random

import pytest
from test_functions import mix

from webcorpus.operators import ordering
from webcorpus.sources import manifest


def swaps(n, seed):
    items = list(range(n))
    for i in range(n):
        j = i + mix(seed, i) % (n - i)
        items[i], items[j] = items[j], items[i]
    return items


@pytest.mark.parametrize("n, seed", [(1, 5), (2, 5), (97, ordering.SHUFFLE_SEED), (5000, ordering.SHUFFLE_SEED), (300, 2**64 - 1)])
def test_swap_order_is_the_swap_shuffle(spark, n, seed):
    rows = ordering.swap_order(spark, n, seed).orderBy("position").collect()
    assert [r.source for r in rows] == swaps(n, seed)


def test_seeded_orders_are_permutations_and_stable(spark):
    df = spark.range(500).withColumnRenamed("id", "position")
    for method in ("swap", "mix64", "md5"):
        first = ordering.seeded_order(df, 9, method).orderBy("position").collect()
        again = ordering.seeded_order(df.repartition(7), 9, method).orderBy("position").collect()
        assert first == again and sorted(r.listed for r in first) == list(range(500))
        assert [r.position for r in first] == list(range(500)) and [r.listed for r in first] != list(range(500))
    by_hash = ordering.seeded_order(df, 9, "mix64").orderBy("position").collect()
    assert [r.listed for r in by_hash] == sorted(range(500), key=lambda i: mix(9, i))


def test_dense_index_with_a_hot_key(spark):
    rng = random.Random(1)
    rows = [(0 if rng.random() < 0.4 else rng.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a INT, b INT").repartition(6)
    got = ordering.dense_index(df, ["a", "b"]).orderBy("position").collect()
    assert [(r.a, r.b) for r in got] == sorted(rows) and [r.position for r in got] == list(range(3000))


def test_running_total(spark):
    rng = random.Random(2)
    rows = [(i * 3, rng.randrange(100)) for i in range(1000)]
    got = ordering.running_total(spark.createDataFrame(rows, "k BIGINT, v BIGINT"), "k", "v", "t", block=64).orderBy("k").collect()
    total = 0
    for row in got:
        assert row.t == total
        total += row.v


def test_nth_smallest(spark):
    rng = random.Random(3)
    for fan_out in (16, 1 << 14):
        xs = [rng.choice([rng.randrange(-50, 50), rng.randrange(1 << 62), 7]) for _ in range(200)]
        df = spark.createDataFrame([(x,) for x in xs], "x BIGINT").coalesce(1).cache()
        for n in (1, 77, 200):
            assert ordering.nth_smallest(df, "x", n, fan_out) == sorted(xs)[n - 1]
        assert ordering.nth_smallest(df, "x", 201, fan_out) is None
    assert ordering.nth_smallest(df.limit(0), "x", 1) is None


def test_positions_round_trip(spark):
    rows = [(0, 0), (0, 5), (1, 0), (2**32 - 1, 2**31 - 1)]
    df = spark.createDataFrame(rows, "i BIGINT, r BIGINT")
    pos = df.select(ordering.position(df.i, df.r).alias("p"))
    back = pos.select("p", ordering.object_index_of(pos.p), ordering.record_idx_of(pos.p)).collect()
    assert [(r[1], r[2]) for r in back] == rows and [r.p for r in back] == sorted(r.p for r in back) and back[0].p >= 0


def listing(spark, tmp_path):
    import gzip

    for crawl, n in (("crawl-data/B", 3), ("crawl-data/A", 12), ("crawl-data/C", 1)):
        folder = tmp_path / crawl
        folder.mkdir(parents=True)
        text = "".join(f"{crawl}/{i}.gz\r\n" if i % 2 else f"{crawl}/{i}.gz\n" for i in range(n))
        (folder / "wet.paths.gz").write_bytes(gzip.compress(text.encode()))
    return manifest.read_path_manifest(spark, str(tmp_path), "wet", ["crawl-data/B", "crawl-data/A", "crawl-data/C"])


def test_listed_order_keeps_crawl_and_line_order(spark, tmp_path):
    objects = manifest.list_objects(listing(spark, tmp_path), "cc-wet-2024").orderBy("object_index").collect()
    want = [f"crawl-data/B/{i}.gz" for i in range(3)] + [f"crawl-data/A/{i}.gz" for i in range(12)] + ["crawl-data/C/0.gz"]
    assert [r.path for r in objects] == want
    assert [r.object_key for r in objects] == [f"0103{i:08x}" for i in range(16)] and objects[0].collection == "cc-wet2024"


def test_shuffled_collection_numbers_after_the_shuffle(spark, tmp_path):
    plain = manifest.list_objects(listing(spark, tmp_path), "cc-wet2024").orderBy("object_index").collect()
    mixed = manifest.list_objects(listing(spark, tmp_path / "again"), "cc-wet2024-shuffled").orderBy("object_index").collect()
    order = swaps(16, ordering.SHUFFLE_SEED)
    assert [r.path for r in mixed] == [plain[i].path for i in order] and mixed[1].object_key == "010400000001"
    with pytest.raises(ValueError):
        manifest.list_objects(listing(spark, tmp_path / "third"), "cc-text2024")


def test_served_manifest_keeps_completed_only(spark, tmp_path):
    done = {"time_start": "2024-02-20T00:00:00Z", "time_end": "2024-02-20T00:00:01Z", "content_length": 1, "sha256": "x", "data_location": {"FilePath": "/a"}}
    import json

    entries = [
        {"db_key": "010300000002", "s3_key": "c", "status": {"Completed": done}},
        {"db_key": "010300000000", "s3_key": "a", "status": {"Dirty": {"content_length": 3}}},
        {"db_key": "010300000001", "s3_key": "b", "status": {"Completed": {**done, "data_location": {"S3Key": "k"}}}},
        {"db_key": "010300000003", "s3_key": "d", "status": {"Downloading": {"time_start": "2024-02-20T00:00:00Z", "content_length": 3}}},
    ]
    (tmp_path / "m.json").write_text(json.dumps(entries, indent=1))
    rows = manifest.read_served_manifest(spark, str(tmp_path / "m.json")).orderBy("object_key").collect()
    assert [(r.object_key, r.object_index, r.path) for r in rows] == [("010300000001", 1, "b"), ("010300000002", 2, "c")]
