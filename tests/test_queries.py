"""Every registered query against its SQL."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(ORACLES))
def test_equals_sql(spark, duck, sf, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLES[name], sf) is None


@pytest.mark.parametrize("name", ["ks_normality", "train_tree", "batch_score", "stream_score"])
def test_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).limit(1).count() == 1


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["event_type", "day_of_week", "n", "mean_value"]
