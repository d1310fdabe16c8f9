"""Archives read in byte ranges: members, resume, error rows, splitting."""

import gzip
import random

import pytest
from helpers import info, members, record, wet, write

from webcorpus.sources import ranges
from webcorpus.sources.archive import read_archives
from webcorpus.sources.ranges import Range, read_range, read_ranges, read_split, split_objects


def rows_of(batches):
    return [row for batch in batches for row in batch.to_pylist()]


def key(row):
    headers = None if row["headers"] is None else dict(row["headers"])
    return row["record_idx"], headers, row["content"], row["parse_error"], dict(row["info_headers"] or []), row["info_content"]


@pytest.fixture
def archive(tmp_path):
    draw = random.Random(4)
    parts = [info()] + [wet(i, draw.randbytes(draw.randrange(1, 3000))) for i in range(60)]
    # A record that holds a whole archive, stored as it is: its members look like the file's own.
    parts.insert(30, wet(99, members(info("inner"), wet(5), wet(6))))
    payload = b"".join(gzip.compress(p, 0 if i == 30 else 6) for i, p in enumerate(parts))
    return write(tmp_path, "a.gz", payload), payload


def test_same_rows_as_the_scan(spark, archive):
    path, _ = archive
    got = [r.asDict() for r in read_ranges(spark, [Range("x", path)]).collect()]
    want = [r.asDict() for r in read_archives(spark, path).collect()]
    plain = lambda rows: sorted((r["record_idx"], r["headers"], bytes(r["content"] or b""), r["content_bytes"], r["info_headers"]) for r in rows)
    assert str(plain(got)) == str(plain(want)) and {r["path"] for r in got} == {"x"}


def test_every_record_says_where_to_go_on(archive):
    path, payload = archive
    whole = rows_of(read_range(Range("x", path)))
    for row in whole[1:]:
        rest = rows_of(read_range(Range("x", path, row["resume_offset"], None, row["resume_idx"])))
        assert [key(r) for r in rest] == [key(r) for r in whole[row["resume_idx"]:]]
        assert row["resume_idx"] == row["record_idx"]  # a member per record


def test_resume_reads_only_what_is_left(archive, monkeypatch):
    path, payload = archive
    opened = []

    class Counted(ranges.Members):
        def __init__(self, *args):
            super().__init__(*args)
            opened.append(self)

    monkeypatch.setattr(ranges, "Members", Counted)
    monkeypatch.setattr(ranges, "CHUNK", 512)
    last = rows_of(read_range(Range("x", path)))[-1]
    opened.clear()
    assert len(rows_of(read_range(Range("x", path, last["resume_offset"], None, last["resume_idx"])))) == 1
    first, rest = (m.read for m in opened)
    assert first <= 1024 and rest == len(payload) - last["resume_offset"]


def test_members_that_are_no_records(tmp_path):
    """Records over several members, several in one: reading goes on where a member opens with a record."""
    parts = [info(), wet(1), wet(2), wet(3), wet(4)]
    joined = b"".join(parts)
    cut = len(parts[0]) + len(parts[1]) + 20
    path = write(tmp_path, "m.gz", members(parts[0] + parts[1], parts[2][:20], parts[2][20:] + parts[3], parts[4]))
    rows = rows_of(read_range(Range("x", path)))
    assert len(rows) == 5 and cut < len(joined)
    assert [r["resume_idx"] for r in rows] == [0, 0, 2, 2, 4]
    for row in rows:
        rest = rows_of(read_range(Range("x", path, row["resume_offset"], None, row["resume_idx"])))
        assert [key(r) for r in rest] == [key(r) for r in rows[row["resume_idx"]:]]


@pytest.mark.parametrize("payload, errors", [
    (None, [(0, "missing_object")]),
    (b"", [(0, "bad_gzip")]),
    (b"no gzip", [(0, "bad_gzip")]),
    (members(info(), wet(1))[:-40], [(1, "bad_gzip")]),
    (members(info(), wet(1))[:-9], [(2, "bad_gzip")]),
    (members(info(), wet(1), b"junk"), []),
    (members(info(), record([("A", "1")], length=False), wet(2)), [(1, "missing_content_length")]),
])
def test_error_rows(tmp_path, payload, errors):
    path = str(tmp_path / "none.gz") if payload is None else write(tmp_path, "e.gz", payload)
    rows = rows_of(read_range(Range("x", path)))
    assert [(r["record_idx"], r["parse_error"]) for r in rows if r["parse_error"]] == errors


@pytest.mark.parametrize("size", [700, 5000, 1 << 20])
def test_one_object_in_many_tasks(spark, archive, size):
    path, payload = archive
    parts = split_objects(spark, [("x", path, len(payload))], size=size)
    # The stored archive inside misleads a range that starts in it: such an object stays in one piece.
    whole = rows_of(read_range(Range("x", path)))
    got = [r.asDict() for r in read_ranges(spark, parts).collect()]
    assert sorted(r["record_idx"] for r in got) == [r["record_idx"] for r in whole]
    assert {r["record_idx"]: bytes(r["content"]) for r in got} == {r["record_idx"]: r["content"] for r in whole}


def test_ranges_of_a_plain_archive(spark, tmp_path):
    payload = members(info(), *[wet(i, f"{i} ".encode() * (i % 90 + 1)) for i in range(200)])
    path = write(tmp_path, "p.gz", payload)
    parts = split_objects(spark, [("x", path, len(payload))], size=2000)
    assert len(parts) > 5 and parts[0].first_idx == 0 and parts[-1].stop == len(payload)
    assert read_ranges(spark, parts).rdd.getNumPartitions() == len(parts)
    rows = read_split(spark, [path], size=2000).select("record_idx", "info_headers").collect()
    assert sorted(r.record_idx for r in rows) == list(range(201))
    assert all(r.info_headers["WARC-Type"] == "warcinfo" for r in rows if r.record_idx)


def test_damage_keeps_an_object_in_one_piece(spark, tmp_path):
    payload = members(info(), *[wet(i) for i in range(50)])
    broken = payload[:3000] + b"\x00" * 50 + payload[3050:]
    path = write(tmp_path, "b.gz", broken)
    assert split_objects(spark, [("x", path, len(broken))], size=1000) == [Range("x", path)]
    errors = [r.parse_error for r in read_split(spark, [path], size=1000).collect() if r.parse_error]
    assert errors == ["bad_gzip"]


def test_small_ranges_share_tasks(spark, tmp_path):
    """Thousands of small ranges are no thousands of tasks, and give the same records."""
    payload = members(info(), *[wet(i, f"{i} ".encode() * 30) for i in range(300)])
    path = write(tmp_path, "s.gz", payload)
    most = 4 * spark.sparkContext.defaultParallelism
    assert len(payload) // 100 > 2 * most
    found = read_split(spark, [path], size=100)
    assert found.rdd.getNumPartitions() <= most
    assert sorted(r.record_idx for r in found.select("record_idx").collect()) == list(range(301))
