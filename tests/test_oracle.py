"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import check, connect

SF = "/root/testdata/sf0.001"
# a batch plan run a second time only for its metrics
SLOW = {"detect_run_metrics"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in SLOW])
def test_query(spark, con, name):
    ok, note = check(con, spark, SF, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok, note


def test_twins_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "trend_id"
