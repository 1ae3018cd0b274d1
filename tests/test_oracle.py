"""Every query against its SQL on the smallest data folder."""

import pytest

import __spark_entry__ as entry
from compare import difference, oracle_connection
from roomsight.catalog import oracles, queries

ORACLES = entry.oracle_sql()
MODELS = {"baseline_models", "tuned_models", "score_rows", "feature_importance",
          "model_roundtrip", "best_params"}


@pytest.fixture(scope="module")
def duck(folder):
    return oracle_connection(folder)


def test_every_query_has_sql_except_models():
    """Of the library's own queries; others may be registered beside them."""
    assert set(queries.QUERIES) - set(oracles.ORACLES) == MODELS
    assert set(queries.QUERIES) <= set(entry.queries())
    assert not set(ORACLES) - set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_result(spark, folder, duck, name):
    mine = entry.queries()[name](spark, folder).toArrow()
    assert difference(mine, duck.sql(ORACLES[name]).to_arrow_table()) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
