"""Physical-plan properties: pruning, pushdown, shuffle counts, joins."""

import re

import pytest

from conftest import SF_SMALL
from demandlens.config import FeatureConfig
from demandlens.operators import features as FE
from demandlens.operators import quality as Q
from demandlens.plans import catalog as K


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns(spark):
    plan = K.q_raw_demand(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan
    plan = K.q_daily_signal(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: (\S+)", plan).group(1)
    assert "Order_Demand" in schema and "Product_Code" not in schema and "year" not in schema


@pytest.fixture()
def no_static_broadcast(spark):
    """The plan shape on data whose estimate is out of reach of a broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    "key",
    ["flag_outliers_iqr", "flag_outliers_zscore", "flag_sparse_products", "handle_nulls_median"],
)
def test_statistics_do_not_shuffle_the_facts(spark, no_static_broadcast, key):
    plan = executed(K.QUERIES[key](spark, SF_SMALL)).split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "hashpartitioning(Warehouse" not in plan and "hashpartitioning(Product_Code" not in plan


def test_quality_summary_does_not_shuffle_the_facts(spark, no_static_broadcast):
    plan = executed(K.QUERIES["quality_summary"](spark, SF_SMALL)).split("== Initial Plan ==")[0]
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    # what is shuffled are the sums per product and warehouse, and less
    assert all("Date" not in k and "coalesce" not in k for k in keys)


@pytest.mark.parametrize("key", ["flag_outliers_iqr", "flag_sparse_products", "handle_nulls_median"])
def test_statistics_and_rows_read_one_written_base(spark, key):
    plan = executed(K.QUERIES[key](spark, SF_SMALL)).split("== Initial Plan ==")[0]
    assert "FileScan" not in plan and "HashAggregate" not in plan  # neither parsed nor deduplicated again


def test_large_statistics_are_shuffled(spark, no_static_broadcast):
    base = K._base(spark, SF_SMALL)
    df = Q.flag_sparse_products(base, 20, broadcast_max_bytes=0)
    plan = executed(df).split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in plan
    want = Q.flag_sparse_products(base, 20)
    assert df.exceptAll(want).count() == 0


def test_dedupe_shuffles_raw_strings_and_two_parsed_values(spark):
    plan = executed(K.q_clean_demand(spark, SF_SMALL)).split("== Initial Plan ==")[0]
    keys = [re.search(r"hashpartitioning\((.*), \d+\)", x).group(1) for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(keys) == 1 and len(keys[0].split(", ")) == 7


def test_features_shuffle_the_facts_once_without_hot_series(spark):
    plan = executed(FE.add_lag_rolling(K.cleaned_demand(spark, SF_SMALL), FeatureConfig())).split("== Initial Plan ==")[0]
    assert len([x for x in plan.splitlines() if "Exchange hashpartitioning" in x]) == 1


def test_queries_leave_nothing_cached(spark):
    K.QUERIES["demand_features"](spark, SF_SMALL).count()
    K.QUERIES["ridge_forecast"](spark, SF_SMALL).count()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == 0


def test_lag_and_rolling_share_one_window_shuffle(spark):
    cleaned = K.cleaned_demand(spark, SF_SMALL)
    feats = FE.add_lag_rolling(cleaned, FeatureConfig())
    plan = feats._jdf.queryExecution().sparkPlan().toString()
    # feature windows over the facts (the day-count table has its own small ones)
    spec = re.compile(r"windowspecdefinition\(Product_Code#\d+, Warehouse#\d+, ")
    windows = [l for l in plan.splitlines() if "Window [" in l and spec.search(l)]
    # lag + stddev + mean: one window node (or two when a projection splits
    # them), all over the same partitioning, so one exchange and one sort
    assert len(windows) == 1
    assert "stddev_samp" in windows[0] and "avg(" in windows[0]


def test_dropped_flags_run_no_statistic(spark):
    plan = K.q_clean_demand(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" not in plan


def test_two_stage_summary_reads_a_written_stage(spark):
    plan = executed(K.q_quality_summary(spark, SF_SMALL)).split("== Initial Plan ==")[0]
    dedupes = [
        x for x in plan.splitlines() if "Exchange hashpartitioning(_raw_" in x and "ReusedExchange" not in x
    ]
    assert not dedupes  # the written stage ran it, once
