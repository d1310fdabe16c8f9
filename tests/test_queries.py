"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check import compare

SF = "/root/testdata/sf0.001"


def test_each_core_query_has_an_oracle():
    core = set(entry.registered.queries())
    assert core <= set(entry.queries())
    assert set(entry.registered.oracle_sql()) == core


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert {r.warc_type for r in rows} == {"response", "request", "metadata"}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, name):
    assert compare(spark, SF, name)[0] == "ok"
