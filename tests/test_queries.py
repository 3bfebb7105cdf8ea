"""Every query runs on the smallest tables; those with SQL must give the SQL's rows."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck

DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
QUERIES = {n: q for n, q in entry.queries().items() if q.__module__.split(".")[1] != "llm"}


@pytest.fixture(scope="module")
def con():
    return duck(DIR)


def test_names():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_matches_sql(spark, con, name):
    _, got, want, *_ = compare(spark, con, name, QUERIES[name], SQL[name], DIR)
    assert got == want


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_runs(spark, name):
    df = QUERIES[name](spark, DIR)
    assert df.count() >= 0 and df.columns


def test_entry(spark):
    assert entry.entry(spark).count() > 0
