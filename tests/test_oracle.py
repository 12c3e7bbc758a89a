"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from __spark_entry__ import entry, oracle_sql, queries

from compare import database, differences
from conftest import SF_DIR

SLOW = {"ml_grid_search", "ml_model_comparison", "score_saved_model", "etl_ml_job"}


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_entry_has_rows(spark):
    assert entry(spark).count() == 3


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert differences(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - SLOW))
def test_query_without_sql_has_rows(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0
