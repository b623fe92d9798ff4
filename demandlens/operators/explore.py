"""Exploration queries over the cleaned table: profile, seasonality,
concentration, autocorrelation and classical decomposition.

Global (unpartitioned) windows appear only after aggregation to a bounded
domain: categories (Pareto), days of one slice (ACF). Per-product windows run
on monthly totals, never on raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlens.config import FeatureConfig
from demandlens.functions.calendar import MONDAY, Q4_MONTHS
from demandlens.operators.features import series_blocks
from demandlens.operators.quantiles import exact_quantiles

# Two-sided 95% normal quantile used for the ACF band.
Z_95 = 1.959963984540054


def describe_demand(
    df: DataFrame,
    cols: Sequence[str] = ("Order_Demand", "day_of_week", "week_of_year"),
    text_cols: Sequence[str] = ("Product_Code", "Product_Category"),
) -> DataFrame:
    """count / mean / stddev / min / max per column from ONE aggregation,
    returned long (one row per column). Numeric columns fill the typed
    ``min``/``max``; text columns have count and ``min_text``/``max_text``."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"{c}__count"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__stddev"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
    for c in text_cols:
        aggs += [
            F.count(c).alias(f"{c}__count"),
            F.min(c).alias(f"{c}__min"),
            F.max(c).alias(f"{c}__max"),
        ]
    wide = df.agg(*aggs)
    null_d, null_s = "CAST(NULL AS DOUBLE)", "CAST(NULL AS STRING)"
    parts = [
        f"'{c}', `{c}__count`, `{c}__mean`, `{c}__stddev`, `{c}__min`, `{c}__max`, {null_s}, {null_s}"
        for c in cols
    ] + [
        f"'{c}', `{c}__count`, {null_d}, {null_d}, {null_d}, {null_d}, `{c}__min`, `{c}__max`"
        for c in text_cols
    ]
    long = wide.select(
        F.expr(
            f"stack({len(parts)}, {', '.join(parts)}) "
            "AS (column_name, count, mean, stddev, min, max, min_text, max_text)"
        )
    )
    return long.select(
        "column_name", "count", "mean",
        "stddev", "min", "max", "min_text", "max_text",
    )


def year_month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def monthly_demand(df: DataFrame, product: str) -> DataFrame:
    return (
        df.filter(F.col("Product_Code") == product)
        .groupBy(year_month(F.col("Date")).alias("year_month"))
        .agg(F.sum("Order_Demand").alias("total_demand"))
        .orderBy("year_month")
    )


def month_dow_heatmap(df: DataFrame) -> DataFrame:
    """Average demand, month rows x day-of-week columns ``dow_1..dow_7``."""
    days = list(range(1, 8))
    piv = df.groupBy("month").pivot("day_of_week", days).agg(F.avg("Order_Demand"))
    return piv.select("month", *[F.col(str(d)).alias(f"dow_{d}") for d in days]).orderBy(
        "month"
    )


def q4_day_filter(df: DataFrame, day_of_week: int = MONDAY) -> DataFrame:
    return df.filter((F.col("day_of_week") == day_of_week) & F.col("month").isin(*Q4_MONTHS))


def warehouse_impact(df: DataFrame, day_of_week: int = MONDAY) -> DataFrame:
    return (
        q4_day_filter(df, day_of_week)
        .groupBy("Warehouse")
        .agg(
            F.avg("Order_Demand").alias("avg_monday_demand"),
            F.count(F.lit(1)).alias("row_count"),
        )
        .orderBy(F.desc("avg_monday_demand"), "Warehouse")
    )


def category_impact_top(df: DataFrame, k: int = 10, day_of_week: int = MONDAY) -> DataFrame:
    return (
        q4_day_filter(df, day_of_week)
        .groupBy("Product_Category")
        .agg(F.sum("Order_Demand").alias("total_q4_monday_volume"))
        .orderBy(F.desc("total_q4_monday_volume"), "Product_Category")
        .limit(k)
    )


def pareto_categories(df: DataFrame) -> DataFrame:
    """Total per category, descending, with cumulative percentage. The
    global window runs on the aggregated categories only."""
    totals = df.groupBy("Product_Category").agg(F.sum("Order_Demand").alias("total_demand"))
    w = Window.orderBy(F.desc("total_demand"), "Product_Category")
    cum = F.sum("total_demand").over(w.rowsBetween(Window.unboundedPreceding, 0))
    grand = F.sum("total_demand").over(Window.partitionBy())
    return totals.select(
        F.row_number().over(w).alias("rank"),
        "Product_Category",
        "total_demand",
        F.try_divide(cum * 100.0, grand).alias("cumulative_percentage"),
    )


def slice_rows(df: DataFrame, warehouse: str, category: str) -> DataFrame:
    return df.filter((F.col("Warehouse") == warehouse) & (F.col("Product_Category") == category))


def seasonal_boxplot_stats(
    df: DataFrame, warehouse: str, category: str, whisker: float = 1.5
) -> DataFrame:
    """Box statistics of demand per (month, day_of_week) cell of a slice:
    exact interpolated quartiles, whiskers = most extreme values within
    ``whisker * IQR`` of the box, and the count of points beyond them. The
    quartiles come from counting passes, so a cell has no list of its values."""
    cell = ["month", "day_of_week"]
    s = slice_rows(df, warehouse, category).select(*cell, "Order_Demand")
    x = F.col("Order_Demand")
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    q = exact_quantiles(s, cell, x, quartiles, interpolate=True).drop("n")
    # at most 12 x 7 = 84 cells: a proven bound for the broadcast
    j = s.join(F.broadcast(q), cell)
    iqr = F.col("q3") - F.col("q1")
    lo = F.col("q1") - F.lit(whisker) * iqr
    hi = F.col("q3") + F.lit(whisker) * iqr
    inside = (x >= lo) & (x <= hi)
    return j.groupBy(*cell, "q1", "median", "q3").agg(
        F.count(x).alias("n"),
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def daily_signal(df: DataFrame, warehouse: str, category: str) -> DataFrame:
    return (
        slice_rows(df, warehouse, category)
        .groupBy("Date")
        .agg(F.sum("Order_Demand").alias("daily_demand"))
    )


def lag_pairs(df: DataFrame, product: str, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """(demand_t, demand_t_plus_1) of consecutive observations of one
    product, ordered by date (ties by demand, warehouse, category)."""
    s = df.filter(F.col("Product_Code") == product).select(
        "Product_Code", "Warehouse", "Product_Category", "Date", "Order_Demand"
    )
    order = ["Date", "Order_Demand", "Warehouse", "Product_Category"]
    b = series_blocks(s, ["Product_Code"], order, 1, cfg.block_rows, cfg.broadcast_max_bytes)
    w = Window.partitionBy("Product_Code", "_blk").orderBy(*order, "_pos")
    return (
        b.withColumn("demand_t", F.lag("Order_Demand", 1).over(w))
        .filter(~F.col("_halo") & F.col("demand_t").isNotNull())
        .select("Date", "demand_t", F.col("Order_Demand").alias("demand_t_plus_1"))
    )


def lag_pair_correlation(pairs: DataFrame) -> DataFrame:
    """Number of the lag pairs and the correlation of their two values."""
    return pairs.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.corr("demand_t", "demand_t_plus_1").alias("correlation"),
    )


def demand_acf(daily: DataFrame, nlags: int = 31) -> DataFrame:
    """Autocorrelation of the observed daily series for lags 0..nlags with
    the Bartlett 95% band. ``daily`` has (Date, daily_demand)."""
    w_all = Window.partitionBy()
    x = F.col("daily_demand").cast("double")
    d = daily.select(
        F.row_number().over(Window.orderBy("Date")).alias("t"),
        (x - F.avg(x).over(w_all)).alias("dev"),
    )
    d = d.withColumns(
        {"denom": F.sum(F.col("dev") * F.col("dev")).over(w_all), "n": F.count(F.lit(1)).over(w_all)}
    )
    shifted = d.select(
        "t", "dev", "denom", "n", F.explode(F.sequence(F.lit(0), F.lit(nlags))).alias("k")
    ).filter(F.col("k") < F.col("n"))
    ahead = d.select(F.col("t").alias("t2"), F.col("dev").alias("dev2"))
    acf = (
        shifted.join(ahead, F.col("t2") == F.col("t") + F.col("k"))
        .groupBy("k")
        .agg(
            F.try_divide(F.sum(F.col("dev") * F.col("dev2")), F.first("denom")).alias("acf"),
            F.first("n").alias("n"),
        )
    )
    wk = Window.orderBy("k")
    # sum of r_j^2 for 1 <= j < k
    sq_before = F.coalesce(
        F.sum(F.when(F.col("k") >= 1, F.col("acf") * F.col("acf"))).over(
            wk.rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0.0),
    )
    var = (
        F.when(F.col("k") == 0, F.lit(0.0))
        .when(F.col("k") == 1, 1.0 / F.col("n"))
        .otherwise((1.0 + 2.0 * sq_before) / F.col("n"))
    )
    return acf.select(
        F.col("k").cast("int").alias("lag"),
        "acf",
        (F.lit(Z_95) * F.sqrt(var)).alias("conf_band"),
    )


def decomposition_exclusions(
    df: DataFrame, period: int = 12, keys: Sequence[str] = ("Product_Code",)
) -> DataFrame:
    """Series that are too short to decompose: their observed months and how
    many a decomposition needs."""
    keys = list(keys)
    months = df.select(*keys, year_month(F.col("Date")).alias("year_month")).distinct()
    counted = months.groupBy(*keys).agg(F.count(F.lit(1)).alias("months"))
    return counted.filter(F.col("months") < 2 * period).withColumn("required", F.lit(2 * period))


def seasonal_decompose(
    df: DataFrame, period: int = 12, keys: Sequence[str] = ("Product_Code",)
) -> DataFrame:
    """Classical additive decomposition of every monthly series at once.
    Trend: centred moving average (2 x period for even periods); seasonal:
    per-phase mean of the detrended values, centred to sum 0; residual.
    Series shorter than two periods are left to
    :func:`decomposition_exclusions`."""
    keys = list(keys)
    monthly = df.groupBy(*keys, year_month(F.col("Date")).alias("year_month")).agg(
        F.sum("Order_Demand").alias("observed")
    )
    w = Window.partitionBy(*keys).orderBy("year_month")
    half = period // 2
    x = F.col("observed").cast("double")
    m = monthly.withColumns(
        {"pos": F.row_number().over(w) - 1, "n": F.count(F.lit(1)).over(Window.partitionBy(*keys))}
    ).filter(F.col("n") >= 2 * period)
    win = w.rowsBetween(-half, half)
    if period % 2 == 0:
        edge = 0.5 * (F.lag(x, half).over(w) + F.lead(x, half).over(w))
        trend = (F.sum(x).over(win) - edge) / F.lit(float(period))
    else:
        trend = F.when(
            F.lag(x, half).over(w).isNotNull() & F.lead(x, half).over(w).isNotNull(),
            F.avg(x).over(win),
        )
    m = m.withColumn("trend", trend).withColumn("phase", F.col("pos") % period)
    m = m.withColumn("detrended", x - F.col("trend"))
    wp = Window.partitionBy(*keys, "phase")
    m = m.withColumns(
        {"_pavg": F.avg("detrended").over(wp), "_pcnt": F.count(F.lit(1)).over(wp)}
    )
    centre = F.sum(F.col("_pavg") / F.col("_pcnt")).over(Window.partitionBy(*keys)) / float(period)
    m = m.withColumn("seasonal", F.col("_pavg") - centre)
    return m.select(
        *keys,
        "year_month",
        "observed",
        "trend",
        "seasonal",
        (x - F.col("trend") - F.col("seasonal")).alias("resid"),
    )
