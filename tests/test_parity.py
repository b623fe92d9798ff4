"""Every SQL-expressible registered query equals its DuckDB oracle on the
driver tables (sf0.001 here; the driver checks sf0.01)."""

import pytest

from conftest import SF_SMALL
from demandlens.plans.catalog import QUERIES
from demandlens.plans.oracle import ORACLE
from demandlens.plans.parity import compare, duckdb_con

KEYS = [k for k in QUERIES if k in ORACLE]


@pytest.fixture(scope="module")
def con():
    return duckdb_con(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    r = compare(spark, con, key, SF_SMALL, QUERIES[key], ORACLE[key])
    assert r["ok"], r


def test_every_query_without_oracle_is_a_model_fit():
    assert set(QUERIES) - set(ORACLE) == {
        "ridge_forecast", "seasonal_trend_forecast", "random_forest_forecast", "gbt_forecast",
        "leafwise_boosting_forecast", "forecast_tournament", "score_requests", "group_leaderboard",
    }
