import gzip

import pytest
from helpers import info, members, record, wet, write
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from webcorpus.functions.headers import header_map
from webcorpus.sources import archive
from webcorpus.sources.archive import Splitter

INFO_BYTES = (
    "WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Date: 2023-11-02T03:04:05Z\r\n"
    "WARC-Filename: week-44-lot-3.warc.gz\r\nWARC-Record-ID: <urn:uuid:11111111-2222-4333-8444-555555555555>\r\n"
    "Content-Type: application/warc-fields\r\nContent-Length: 96\r\n\r\n"
)


def split(data, framing="standard", size=None):
    splitter, out = Splitter(framing), []
    for i in range(0, len(data), size or max(len(data), 1)):
        out += splitter.feed(data[i : i + (size or len(data))])
    return out + list(splitter.close())


def test_warcinfo_record():
    rows = split(INFO_BYTES.encode() + b"x" * 96 + b"\r\n\r\nWARC-like line, but no record\r\n")
    headers, content, error = rows[0]
    assert error is None and len(content) == 96
    assert headers["Version"] == "WARC/1.0" and headers["WARC-Type"] == "warcinfo"
    assert headers["WARC-Filename"] == "week-44-lot-3.warc.gz" and headers["Content-Length"] == "96"
    # What follows opens with the magic word but is no record.
    assert rows[1] == (None, None, "invalid_version")


@pytest.mark.parametrize(
    "data, errors",
    [
        (b"WARC/2.0\r\nContent-Length: 0\r\n\r\n", ["invalid_version"]),
        (b"", []),
        (b"no archive at all", ["invalid_version"]),
        (b"WARC/1.0\r\nA: 1\r\n\r\n", ["missing_content_length"]),
        (b"WARC/1.0\r\nContent-Length: x\r\n\r\n", ["bad_content_length"]),
        (b"WARC/1.0\r\nContent-Length: -1\r\n\r\n", ["bad_content_length"]),
        (b"WARC/1.0\r\nContent-Length: 18446744073709551616\r\n\r\n", ["bad_content_length"]),
        (b"WARC/1.0\r\nContent-Length: 10\r\n\r\nabc", ["truncated"]),
        (b"WARC/1.0\r\nno colon\r\nContent-Length: 0\r\n\r\n", ["bad_header_line"]),
        (b"WARC/1.0\r\nA: \xff\r\nContent-Length: 0\r\n\r\n", ["header_encoding"]),
        (b"WARC/1.0\r\nContent-Length: 0\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n", [None, "invalid_version"]),
        (b"WARC/1.0\r\nContent-Length: 0\r\n\r\nWARC/1.0\r\nContent-Length: 0\r\n", [None, None]),
        (b"WARC/1.0\r\nContent-Length: +2\r\n\r\nok", [None]),
        (b"WARC/1.0\r\nContent-Length: 5\r\nContent-Length: 2\r\n\r\nok\r\n\r\n", [None]),
        (b"WARC/1.0\r\ncontent-length: 2\r\n\r\nok", ["missing_content_length"]),
        (b"WARC/1.0\nContent-Length: 2\n\nok\n\nWARC/1.0\nContent-Length: 1\n\nz\n\n", [None, None]),
    ],
)
def test_malformed_and_odd_records(data, errors):
    for size in (1, 7, None):
        assert [r[2] for r in split(data, size=size)] == errors


def test_rows_before_an_error_are_kept_and_nothing_follows():
    bad = record([("A", "1")], b"abc", length=False)
    rows = split(info() + wet(1) + bad + wet(2))
    assert [r[2] for r in rows] == [None, None, "missing_content_length"]


def test_text_between_records_is_skipped_to_the_next_line_that_opens_one():
    data = record([], b"body") + b"junk WARC/1.0 junk\r\n" + record([], b"next")
    assert [r[1] for r in split(data)] == [b"body", b"next"]


def test_shifted_framing():
    rows = split(record([], b"body!") + record([], b"WARC inside"), "reference")
    assert [r[1] for r in rows] == [b"\r\nbod", b"\r\nWARC insi"]


bodies = st.lists(
    st.one_of(st.binary(max_size=60), st.just(b"\r\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\n"), st.just(b"WARC/1.0\r\n")),
    max_size=6,
).map(b"".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(bodies, min_size=1, max_size=6), st.integers(1, 50))
def test_any_payload_comes_back_whole_whatever_the_pieces(payloads, size):
    data = b"".join(record([("N", str(i))], body) for i, body in enumerate(payloads))
    assert [r[1] for r in split(data, size=size)] == payloads


def test_inflate_reads_every_member():
    parts = [b"a" * 3_000_000, b"", b"b"]
    assert b"".join(archive.inflate(members(*parts))) == b"".join(parts)


def test_files_payloads_and_members_agree(spark, tmp_path):
    nested = b"x\r\n\r\nWARC/1.0\r\nContent-Length: 1\r\n\r\ny\r\n\r\nWARC/1.0\r\n"
    one = [info("one"), wet(1, nested), wet(2, b"\xff\xfe\x00"), wet(3, "é".encode())]
    write(tmp_path, "one.gz", members(*one))
    write(tmp_path, "two.gz", gzip.compress(b"".join([info("two"), wet(4)])))
    write(tmp_path, "three.gz", members(b"".join([info("three"), wet(5)])[:-20]))
    write(tmp_path, "four.gz", gzip.compress(b"nothing"))
    cols = ["path", "record_idx", "content", "content_bytes", "parse_error", "info_content"]
    scanned = archive.read_archives(spark, str(tmp_path))
    whole = archive.split_payloads(archive.read_objects(spark, str(tmp_path)))
    key = lambda rows: sorted(map(repr, rows))
    assert key(scanned.select(*cols).collect()) == key(whole.select(*cols).collect())
    rows = {(r.path.split("/")[-1], r.record_idx): r for r in scanned.collect()}
    assert rows["one.gz", 1].content == nested and rows["one.gz", 2].content == b"\xff\xfe\x00"
    assert rows["one.gz", 3].info_headers["WARC-Filename"] == "one"
    assert rows["four.gz", 0].parse_error == "invalid_version"
    assert len(rows) == 4 + 2 + 2 + 1
    bare = archive.read_archives(spark, str(tmp_path), with_content=False).filter("content IS NOT NULL")
    assert bare.count() == 0


def test_bad_gzip_payload(spark):
    df = spark.createDataFrame([("p", bytearray(b"not gzip"))], "path STRING, payload BINARY")
    assert [r.parse_error for r in archive.split_payloads(df).collect()] == ["bad_gzip"]


def test_scan_and_column_header_maps_agree(spark):
    blocks = ["A: 1\r\nB :x:y \r\nA:\u20032\u00a0\r\nVersion: z\r\n", "K:\r\n: v\n", "a:b\r\r\n\r\nc:d\n"]
    df = spark.createDataFrame([(b,) for b in blocks], "b STRING")
    columns = [r[0] for r in df.select(header_map(F.col("b"))).collect()]
    scanned = [archive._read_header((b + "Content-Length: 0\n").encode())[0] for b in blocks]
    for got, want in zip(columns, scanned):
        want.pop("Content-Length")
        assert got == want
    assert columns[0] == {"Version": "z", "A": "2", "B": "x:y"}


def test_header_record_join_equals_the_scan(spark, tmp_path):
    write(tmp_path, "a.gz", members(info("a"), wet(1), wet(2)))
    rows = archive.read_archives(spark, str(tmp_path)).withColumn("object_key", F.col("path"))
    joined = archive.attach_header_record(rows).select("record_idx", "info_headers", "info_content")
    direct = rows.filter("record_idx > 0").select("record_idx", "info_headers", "info_content")
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, direct.collect()))


def test_objects_are_attached_either_way(spark, tmp_path, monkeypatch):
    paths = [write(tmp_path, f"{i}.gz", members(info(), wet(i))) for i in range(2)]
    objects = spark.createDataFrame([(f"file:{p}", i) for i, p in enumerate(paths)], "path STRING, object_index INT")
    rows = archive.read_archives(spark, paths)
    got = []
    for limit in (10, 1):
        monkeypatch.setattr(archive, "BROADCAST_OBJECTS", limit)
        got.append(sorted((r.object_index, r.record_idx) for r in archive.attach_objects(rows, objects).collect()))
    assert got[0] == got[1] == [(0, 0), (0, 1), (1, 0), (1, 1)]
