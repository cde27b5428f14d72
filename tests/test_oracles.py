import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf, con, name):
    assert compare(queries()[name](spark, sf), con, ORACLES[name]) == []


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(queries())


def test_entry_has_rows(spark):
    out = entry(spark)
    assert out.columns == ["class_code", "n", "avg_moid", "avg_H", "n_pha"]
    assert out.count() == 5
