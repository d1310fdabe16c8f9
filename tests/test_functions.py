import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from webcorpus.functions import keys, parsers
from webcorpus.functions.whatwg import normalise


def values(spark, items, parse):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i INT, v STRING").repartition(1)
    return [r[0] for r in df.orderBy("i").select(parse(F.col("v"))).collect()]


def test_urn_uuid(spark):
    good = "<urn:uuid:123E4567-e89b-12d3-a456-426614174000>"
    bad = ["", None, good[:-1], good + "\n", good.replace("-", "_"), "<urn:uuid:" + "0" * 36 + ">", good.upper()]
    assert values(spark, [good, *bad], parsers.parse_urn_uuid) == ["123e4567-e89b-12d3-a456-426614174000"] + [None] * 7


def test_length(spark):
    items = ["0", "+7", "007", "", " 1", "1 ", "1.0", "-1", "１", "9223372036854775807", None]
    assert values(spark, items, parsers.parse_length) == [0, 7, 7, None, None, None, None, None, None, 2**63 - 1, None]


DATES = {
    "2024-02-20T12:34:56Z": "2024-02-20T12:34:56Z",
    "2024-02-20T12:34:56.25+02:00": "2024-02-20T10:34:56.250Z",
    "2024-02-20t12:34:56.1234567z": "2024-02-20T12:34:56.123456Z",
    "2024-02-20 00:00:00-00:00": "2024-02-20T00:00:00Z",
    "2016-12-31T23:59:60Z": "2017-01-01T00:00:00Z",
    "2024-03-10T02:30:00Z": "2024-03-10T02:30:00Z",
    "1969-12-31T23:59:59.5Z": "1969-12-31T23:59:59.500Z",
    "2024-02-20T12:34:56-23:59": "2024-02-21T12:33:56Z",
    "2024-02-20T12:34:56": None,
    "2024-02-20T12:34:56+24:00": None,
    "2024-02-20T24:00:00Z": None,
    "2024-02-30T00:00:00Z": None,
    "2024-02-20": None,
    "20240220T000000Z": None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = values(spark, list(DATES), lambda c: parsers.render_rfc3339(parsers.parse_rfc3339(c)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == list(DATES.values())


def python_ip(text):
    try:
        return None if "%" in text else str(ipaddress.ip_address(text))
    except ValueError:
        return None


def test_known_addresses(spark):
    items = [
        "93.184.216.34", "2606:2800:220:1:248:1893:25c8:1946", "::", "::1", "1::", "not-an-ip", "01.2.3.4", "1.2.3",
        "1:0:0:2:0:0:0:3", "::ffff:1.2.3.4", "::1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "1::2::3", "1:2:3:4:5:6:7::", ":::",
        ":1", "1:", "fe80::1%eth0", "2001:DB8:0:0:1:0:0:1", "12345::", "1:2:3:4:5:6:7", "1:0:2:0:3:0:4:0", "1.2.3.4:80",
    ]
    assert values(spark, items, parsers.parse_ip) == [python_ip(i) for i in items]


def test_random_addresses(spark):
    rng = random.Random(7)
    items = []
    for _ in range(400):
        groups = [rng.choice(["0", "0", "0000", f"{rng.randrange(65536):x}", f"{rng.randrange(65536):04X}"]) for _ in range(8)]
        if rng.random() < 0.4:
            a = rng.randrange(8)
            b = rng.randrange(a, 9)
            items.append(":".join(groups[:a]) + "::" + ":".join(groups[b:]))
        else:
            items.append(":".join(groups[: rng.choice([8, 8, 8, 7, 9])]))
    assert values(spark, items, parsers.parse_ip) == [python_ip(i) for i in items]


URLS = {
    "HTTP://EXAMPLE.com:80": "http://example.com/",
    "https://example.com": "https://example.com/",
    "https://example.com?a=b": "https://example.com/?a=b",
    "https://example.com/a/../b/./c": "https://example.com/b/c",
    "https://example.com/a/%2E%2e/b/..": "https://example.com/",
    "http://exämple.com/ü?ö#é": "http://xn--exmple-cua.com/%C3%BC?%C3%B6#%C3%A9",
    "  http://a.com/x\ty\n ": "http://a.com/xy",
    "http://a.com/%zz?'\"<>": "http://a.com/%zz?%27%22%3C%3E",
    "http:\\\\a.com\\b": "http://a.com/b",
    "http:///a.com/x": "http://a.com/x",
    "http://user:p@ss@h.com/": "http://user:p%40ss@h.com/",
    "http://[2001:DB8::0:1]:8080/x": "http://[2001:db8::1]:8080/x",
    "http://1.2.3/": "http://1.2.0.3/",
    "http://0x7f.1/": "http://127.0.0.1/",
    "mailto:a b@c": "mailto:a b@c",
    "foo://Host/A/../b": "foo://Host/b",
    "file:///C|/x/../y": "file:///C:/y",
    "http://a.com/a|b[]^": "http://a.com/a|b[]^",
    "not a url": None,
    "//x": None,
    "": None,
    "http://": None,
    "http://a b.com/": None,
    "http://256.256.256.256/": None,
    "http://h.com:99999/": None,
    "http://h.com:8a/": None,
    "http://[::1/": None,
}


def test_urls(spark):
    assert values(spark, list(URLS), parsers.normalise_url) == list(URLS.values())


def test_plain_urls_are_their_own_normal_form(spark):
    """What the fast pattern lets through must be what the slow way gives."""
    chars = "abzAZ09-._~!$&'()*+,;=:@%/?#|[]{}^`\\\"<> é"
    rng = random.Random(3)
    items = ["http://" + rng.choice(["a.com", "a-b.example", "x1.y2", "1.2", "a.b.1", "xn--a.c", "localhost"]) + "/" + "".join(rng.choice(chars + "/./..") for _ in range(rng.randrange(12))) for _ in range(800)]
    assert values(spark, items, parsers.normalise_url) == [normalise(i) for i in items]


def test_languages(spark):
    got = values(spark, ["fra", "fra, eng ,", "", None], parsers.language_list)
    assert got == [["fra"], ["fra", "eng", ""], [""], []]


def test_object_keys(spark):
    df = spark.createDataFrame([(1, 0), (4, 2**32 - 1), (3, 66)], "c INT, i BIGINT")
    rows = df.select("c", "i", keys.object_key(F.col("c"), F.col("i")).alias("k"))
    back = rows.select("*", keys.decode_object_key(F.col("k")).alias("d")).collect()
    assert [r.k for r in back] == ["010100000000", "0104ffffffff", "010300000042"]
    assert all((r.d.code, r.d.object_index, r.d.error) == (r.c, r.i, None) for r in back)


def test_collection_names(spark):
    for code, name in keys.COLLECTIONS.items():
        assert values(spark, [name, keys.ALIASES[code]], keys.collection_code) == [code, code]
    assert values(spark, ["cc-text", None], keys.collection_code) == [None, None]


def test_index_uuid_is_22_bytes(spark):
    assert values(spark, ["a" * 22, "a" * 21, "é" * 11, "é" * 22, None], keys.valid_index_uuid) == [True, False, True, False, False]


def mix(seed, x):
    mask = (1 << 64) - 1
    rot = lambda v, n: (v >> n | v << (64 - n)) & mask
    v = seed ^ x
    v ^= rot(v, 25) ^ rot(v, 47)
    for m in (keys.MIX_MULTIPLIER_1, keys.MIX_MULTIPLIER_2):
        v = v * m & mask
        v ^= v >> 23 ^ v >> 51
    return v


@pytest.mark.parametrize("seed", [0x420000FEFECA, 0, (1 << 64) - 1])
def test_position_hash(spark, seed):
    rows = spark.range(500).select("id", keys.mix64(seed, F.col("id") * 7919).alias("h")).collect()
    assert all(int(r.h) == mix(seed, r.id * 7919) for r in rows)
