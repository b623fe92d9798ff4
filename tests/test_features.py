import datetime as dt
import math
import random

import pandas as pd
import pytest

from demandlens.config import FeatureConfig
from demandlens.operators import features as FE
from demandlens.operators import explore as X

SCHEMA = "Product_Code string, Warehouse string, Product_Category string, Order_Demand bigint, Date date, month int, day_of_week int"


def series(spark, spec, seed=1):
    """spec: {(product, warehouse): n_rows}; a few dates repeat (ties)."""
    rnd = random.Random(seed)
    rows = []
    for (p, w), n in spec.items():
        day = dt.date(2015, 1, 1)
        for i in range(n):
            if rnd.random() > 0.3:
                day = day + dt.timedelta(days=rnd.randint(1, 3))
            rows.append((p, w, "C", rnd.randint(0, 50), day, day.month, 1))
    return spark.createDataFrame(rows, SCHEMA)


def naive(pdf, n=7, lag=2):
    out = []
    for _, g in pdf.sort_values(["Date", "Order_Demand", "Product_Category"]).groupby(["Product_Code", "Warehouse"]):
        x = g["Order_Demand"].tolist()
        for i, v in enumerate(x):
            win = x[max(0, i - n + 1): i + 1]
            m = sum(win) / len(win)
            sd = math.sqrt(sum((a - m) ** 2 for a in win) / (len(win) - 1)) if len(win) > 1 else None
            out.append((g["Product_Code"].iloc[0], g["Warehouse"].iloc[0], g["Date"].iloc[i], v,
                        x[i - lag] if i >= lag else None, None if sd is None else round(sd, 6), round(m, 6)))
    return sorted(out, key=str)


def spark_rows(df):
    return sorted(
        ((r.Product_Code, r.Warehouse, r.Date, r.Order_Demand, r.demand_T_minus_2,
          None if r.rolling_7d_stddev is None else round(r.rolling_7d_stddev, 6), round(r.rolling_7d_mean, 6))
         for r in df.collect()),
        key=str,
    )


SPEC = {("A", "W1"): 1, ("B", "W1"): 2, ("C", "W1"): 7, ("D", "W1"): 8, ("E", "W2"): 40, ("A", "W2"): 23}


def test_lag_rolling_match_naive(spark):
    df = series(spark, SPEC)
    got = spark_rows(FE.add_lag_rolling(df, FeatureConfig()))
    assert got == naive(df.toPandas())


@pytest.mark.parametrize("block_rows", [1, 3, 5, 10])
def test_hot_series_blocks_equal_unsplit(spark, block_rows):
    """Series longer than block_rows are split with a halo; the result must
    equal the unsplit window exactly."""
    df = series(spark, SPEC, seed=7)
    split = spark_rows(FE.add_lag_rolling(df, FeatureConfig(block_rows=block_rows)))
    assert split == naive(df.toPandas())


def test_blocks_assign_multiple_blocks(spark):
    df = series(spark, {("E", "W2"): 40})
    b = FE.series_blocks(df, ["Product_Code", "Warehouse"], ["Date", *FE.TIE_BREAK], 6, 5)
    assert b.filter("NOT _halo").select("_blk").distinct().count() == 8
    assert {r["count"] for r in b.filter("NOT _halo").groupBy("_blk").count().collect()} == {5}


@pytest.mark.parametrize("block_rows", range(1, 11))
def test_one_date_is_split_between_blocks(spark, block_rows):
    """All rows of a series on one date, many of them equal."""
    rnd, day = random.Random(3), dt.date(2016, 5, 2)
    rows = [("H", "W1", "C", rnd.randint(0, 4), day, 5, 1) for _ in range(37)]
    rows += [("K", "W1", "C", rnd.randint(0, 90), day + dt.timedelta(days=k), 5, 1) for k in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = spark_rows(FE.add_lag_rolling(df, FeatureConfig(block_rows=block_rows)))
    assert got == naive(df.toPandas())
    b = FE.series_blocks(df, ["Product_Code", "Warehouse"], ["Date", *FE.TIE_BREAK], 6, block_rows)
    sizes = b.filter("NOT _halo AND Product_Code = 'H'").groupBy("_blk").count().collect()
    assert max(r["count"] for r in sizes) == block_rows


def test_exclusive_frame_for_scoring(spark):
    df = series(spark, {("C", "W1"): 8})
    rows = FE.add_lag_rolling(df, FeatureConfig(include_current=False)).orderBy("Date", "Order_Demand").collect()
    assert rows[0].rolling_7d_mean is None
    assert rows[1].rolling_7d_mean == rows[0].Order_Demand


def test_engineer_features_fills_and_indicators(spark):
    df = spark.createDataFrame(
        [("P", "W", "C", 5, dt.date(2016, 11, 7), 11, 2)], SCHEMA
    )
    r = FE.engineer_features(df).first()
    assert (r.demand_T_minus_2, r.rolling_7d_stddev, r.is_q4, r.is_monday) == (0, 0.0, 1, 1)
    assert r.rolling_7d_mean == 5.0


def test_lag_pairs_one_product(spark):
    df = series(spark, {("P", "W1"): 5, ("P", "W2"): 4, ("Q", "W1"): 3})
    pairs = X.lag_pairs(df, "P", FeatureConfig(block_rows=2)).collect()
    assert len(pairs) == 8
