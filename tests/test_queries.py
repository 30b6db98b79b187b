"""Every registered query against its SQL."""

import oracle
import pytest
from conftest import SF

import __spark_entry__ as entry_module

from streamlytics.plans.registry import all_oracles, all_queries

# Names only: filling the registry needs no session. The training-text queries have their own
# tests in tests/llm.
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert oracle.compare(spark, con, SF, QUERIES[name], ORACLES.get(name)) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_offers_them_all():
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


def test_entry_is_the_top3(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["dt", "area", "adid", "click_count", "rank"]
    assert df.count() > 0
