"""The llm package's queries on the smallest tables."""

import pytest

import __spark_entry__ as entry
from cartolux.llm.queries import ORACLES, QUERIES
from compare import compare, duck

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    assert name in entry.queries()
    if name in ORACLES:
        _, got, want, *_ = compare(spark, duck(DIR), name, QUERIES[name], ORACLES[name], DIR)
        assert got == want
    else:
        assert QUERIES[name](spark, DIR).count() >= 0


def test_round_trip(spark):
    assert QUERIES["p7_round_trip"](spark, DIR).filter("NOT exact").count() == 0
