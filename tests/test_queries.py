"""Registered queries against their SQL twins on the smallest tables."""

import pytest
from compare import compare, duck
from conftest import SMALL

import __spark_entry__ as entry_points

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()
# trained from scratch: covered by tests/test_learning.py and the bench
SLOW = {"train_all", "pipeline"}
# corpus queries have tests of their own
CORPUS = {n for n in QUERIES if n[:2] == "op" and n[2:3].isdigit()}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SMALL), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW - CORPUS))
def test_runs(spark, name):
    assert len(QUERIES[name](spark, SMALL).collect()) > 0  # every column is computed


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[:4] == ["user_id", "day", "x", "streak"] and df.count() > 0


def test_every_twin_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
