"""Training-text queries against their SQL, on whole tables."""

import oracle
import pytest
from conftest import SF

from streamlytics.llm import queries

QUERIES, ORACLES = queries.all_queries(), queries.all_oracles()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert oracle.compare(spark, con, SF, QUERIES[name], ORACLES[name]) is None


def test_there_is_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
