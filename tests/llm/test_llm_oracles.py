import pytest
from oracle import compare, connect

from perigee.llm.queries import load

QUERIES, ORACLES = load()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf, name):
    assert compare(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) == []


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
