import math
import random

import pytest
from pyspark.sql import functions as F

from demandlens.operators import quality as Q
from demandlens.operators.quantiles import exact_quantiles

PROBS = {"low": 0.0, "q1": 0.25, "median": 0.5, "p90": 0.9, "top": 1.0}


def _groups(kind):
    rng = random.Random(kind)
    if kind == "spread":
        return {"a": [rng.randint(0, 10**9) for _ in range(3000)], "b": [5], "c": [7, 3], None: [1, 2, 3, 4]}
    if kind == "ties":
        return {"a": [1] * 2000 + [2] * 2000, "b": [0] * 999 + [10**12], "c": [rng.randint(0, 3) for _ in range(2500)]}
    return {"a": [2.0**-k for k in range(900)] * 3, "b": [rng.gauss(0, 1e9) for _ in range(2000)], "c": [-0.5] * 7}


def _discrete(x, p):
    return sorted(x)[max(math.ceil(p * len(x)) - 1, 0)]


def _between(x, p):
    x, at = sorted(x), (len(x) - 1) * p
    low = math.floor(at)
    return x[low] * (1 - (at - low)) + x[min(low + 1, len(x) - 1)] * (at - low)


@pytest.mark.parametrize("kind", ["spread", "ties", "powers"])
@pytest.mark.parametrize("how", [{}, {"small": 10, "grid": 16, "accuracy": 100}])
def test_quantiles_equal_sorting(spark, kind, how):
    groups = _groups(kind)
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [("a", None), ("empty", None)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, f"g string, x {'double' if kind == 'powers' else 'long'}").repartition(4)
    got = {r.g: r for r in exact_quantiles(df, ["g"], F.col("x"), PROBS, **how).collect()}
    assert set(got) == set(groups)
    for g, xs in groups.items():
        assert got[g].n == len(xs)
        assert [got[g][c] for c in PROBS] == [_discrete(xs, p) for p in PROBS.values()]
    if how:
        return
    for r in exact_quantiles(df, ["g"], F.col("x"), PROBS, interpolate=True).collect():
        want = [_between(groups[r.g], p) for p in PROBS.values()]
        assert [r[c] for c in PROBS] == pytest.approx(want, rel=1e-12)


def test_no_rows_and_no_keys(spark):
    none = spark.createDataFrame([], "g string, x long")
    assert exact_quantiles(none, ["g"], F.col("x"), PROBS).collect() == []
    with pytest.raises(ValueError):
        exact_quantiles(none, [], F.col("x"), PROBS)


def test_no_pass_gathers_a_groups_values(spark):
    """One group of many values: what is aggregated are sketches and counts."""
    df = spark.range(5000).select(F.lit("w").alias("Warehouse"), (F.col("id") % 777).alias("Order_Demand"))
    fences = Q.warehouse_fences(df, exact=True)
    plan = fences._jdf.queryExecution().toString()
    assert "percentile_disc" not in plan and "collect_list" not in plan
    r = fences.first()
    assert (r.Q1, r.Q3) == tuple(_discrete([k % 777 for k in range(5000) if k % 777], p) for p in (0.25, 0.75))
