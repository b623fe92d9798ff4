import datetime as dt
import math

import numpy as np

from demandlens.operators import explore as X

SCHEMA = "Product_Code string, Warehouse string, Product_Category string, Order_Demand bigint, Date date, month int, day_of_week int"


def test_acf_matches_numpy(spark):
    rng = np.random.default_rng(3)
    vals = rng.integers(0, 100, 60).tolist()
    rows = [(dt.date(2015, 1, 1) + dt.timedelta(days=2 * i), int(v)) for i, v in enumerate(vals)]
    daily = spark.createDataFrame(rows, "Date date, daily_demand bigint")
    got = {r.lag: (r.acf, r.conf_band) for r in X.demand_acf(daily, 10).collect()}
    x = np.array(vals, float) - np.mean(vals)
    den = (x * x).sum()
    r = [(x[: len(x) - k] * x[k:]).sum() / den for k in range(11)]
    assert got[0][0] == 1.0 and got[0][1] == 0.0
    for k in range(1, 11):
        assert abs(got[k][0] - r[k]) < 1e-9
    band2 = 1.959963984540054 * math.sqrt((1 + 2 * r[1] ** 2) / 60)
    assert abs(got[2][1] - band2) < 1e-9


def test_decomposition_parts_sum_to_series(spark):
    rows = []
    for p, months in (("LONG", 36), ("MID", 24), ("SHORT", 23)):
        for m in range(months):
            d = dt.date(2010 + m // 12, m % 12 + 1, 5)
            rows.append((p, "W", "C", 100 + 10 * (m % 12) + m, d, d.month, 1))
    df = spark.createDataFrame(rows, SCHEMA)
    out = X.seasonal_decompose(df, 12).collect()
    assert {r.Product_Code for r in out} == {"LONG", "MID"}
    short = X.decomposition_exclusions(df, 12).collect()
    assert [(r.Product_Code, r.months, r.required) for r in short] == [("SHORT", 23, 24)]
    for r in out:
        if r.trend is not None:
            assert abs(r.trend + r.seasonal + r.resid - r.observed) < 1e-3
    for p in ("LONG", "MID"):
        seas = {r.year_month[-2:]: r.seasonal for r in out if r.Product_Code == p}
        assert abs(sum(seas.values())) < 1e-3


def test_pareto_cumulative(spark):
    rows = [("P", "W", c, v, dt.date(2015, 1, 1), 1, 1) for c, v in (("A", 50), ("B", 30), ("C", 20))]
    out = X.pareto_categories(spark.createDataFrame(rows, SCHEMA)).orderBy("rank").collect()
    assert [r.Product_Category for r in out] == ["A", "B", "C"]
    assert [r.cumulative_percentage for r in out] == [50.0, 80.0, 100.0]


def test_heatmap_shape(spark):
    rows = [("P", "W", "C", 10 * d, dt.date(2015, 1, 1), m, d) for m in (1, 2) for d in range(1, 8)]
    out = X.month_dow_heatmap(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 2 and out[0].dow_3 == 30.0


def test_boxplot_whiskers(spark):
    vals = list(range(1, 21)) + [1000]
    rows = [("P", "WHSE_S", "CATEGORY_019", v, dt.date(2015, 1, 1), 1, 2) for v in vals]
    r = X.seasonal_boxplot_stats(spark.createDataFrame(rows, SCHEMA), "WHSE_S", "CATEGORY_019").first()
    assert r.whisker_high == 20 and r.n_outliers == 1 and r.n == 21
    assert (r.q1, r.median, r.q3) == (6, 11, 16)
    even = spark.createDataFrame([row for row in rows[:4] for _ in range(1 + row[3] % 2)], SCHEMA)
    r = X.seasonal_boxplot_stats(even, "WHSE_S", "CATEGORY_019").first()
    assert (r.q1, r.median, r.q3, r.n) == (1.25, 2.5, 3.0, 6)
