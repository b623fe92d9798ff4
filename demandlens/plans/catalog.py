"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, all reading the driver tables through the
``raw_demand`` view. Parameters are the fixture values (see README)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.config import DEFAULT_MODELS, CleanConfig, FeatureConfig, TrainConfig
from demandlens.operators import clean as C
from demandlens.operators import evaluate as EV
from demandlens.operators import explore as X
from demandlens.operators import features as FE
from demandlens.operators import forecast as FC
from demandlens.operators import moments as MO
from demandlens.operators import quality as Q
from demandlens.operators import score as SC
from demandlens.operators import summaries as SU
from demandlens.operators.dedupe import drop_duplicates_in_two_phases
from demandlens.plans.pipelines import clean, clean_stages, parse_stage
from demandlens.session import ensure_parallelism, scratch_path
from demandlens.sources.fixture import landed, landed_raw_demand, raw_demand
from demandlens.sources.readers import read_cleaned, read_raw
from demandlens.sources.sinks import write_cleaned

# Fixture parameters of the registered queries.
MIN_RECORDS = 20
TEST_YEAR = 2001
THRESHOLD = 4000.0
WAREHOUSE = "WHSE_S"
CATEGORY = "CATEGORY_019"
PRODUCT = "PRODUCT_0115"
IQR_MULTIPLIER = 3.0
Z_THRESHOLD = 4.0
# The learners run at full size: TrainConfig's default trees and rounds.

CLEAN_CFG = CleanConfig(min_records_per_product=MIN_RECORDS)
FEATURE_CFG = FeatureConfig()
TRAIN_CFG = TrainConfig(
    test_year=TEST_YEAR,
    target_warehouse=WAREHOUSE,
    target_category=CATEGORY,
    high_demand_threshold=THRESHOLD,
)

Query = Callable[[SparkSession, str], DataFrame]


def _r(c: str | Column, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 4).alias(name or (c if isinstance(c, str) else None))


# ---------------------------------------------------------------- stages


def _raw(spark, sf):
    return landed_raw_demand(spark, sf)


def _parsed(spark, sf):
    return parse_stage(_raw(spark, sf), CLEAN_CFG)


def _base(spark, sf):
    """Rows that survive the >= 0 filter and the key/date drop."""
    return C.drop_null_keys(C.drop_negative_demand(_parsed(spark, sf)))


def _written_base(spark, sf):
    """The same, written once: a statistic and the rows it is joined to read it
    from there instead of parsing and deduplicating twice."""
    return FC.materialise(_base(spark, sf))


def _clean_from_raw(spark, sf, keep_flags=False):
    return clean(_raw(spark, sf), replace(CLEAN_CFG, keep_flags=keep_flags, checkpoint_base=keep_flags))


def cleaned_demand(spark, sf):
    """The cleaned table, which exploration, features, training and scoring
    start from: cleaned once per session and read back."""
    return ensure_parallelism(landed(spark, sf, "cleaned_demand", _clean_from_raw))


def _featured(spark, sf):
    return FE.engineer_features(cleaned_demand(spark, sf), FEATURE_CFG)


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Figures of a report, rounded for the comparison with SQL."""
    return df.withColumns({c: F.round(c, 4) for c in cols})


def _round_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: F.round(c, 4) for c in df.columns if c.startswith("rolling_")}
    )


# ---------------------------------------------------------------- sources


def q_raw_demand(spark, sf):
    return raw_demand(spark, sf)


def q_scan_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "raw-csv")
    (
        _raw(spark, sf)
        .write.mode("overwrite")
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
    return read_raw(spark, path)


def q_scan_csv_reordered(spark, sf):
    """A header CSV with other columns, another order and blanks in names."""
    path = scratch_path(spark, "raw-csv-reordered")
    raw = _raw(spark, sf)
    names = ["Order_Demand", "Warehouse", "Date", "Product_Code", "Product_Category"]
    odd = raw.select(F.lit("x").alias("note"), *[F.col(c).alias(f" {c} ") for c in names])
    (
        odd.write.mode("overwrite")
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
    return read_raw(spark, path)


def q_scan_csv_layouts(spark, sf):
    """One folder of header CSVs in three layouts: the plain one, another order
    with more columns, and blanks in the names."""
    path = scratch_path(spark, "raw-csv-layouts")
    raw = _raw(spark, sf).withColumn("_third", F.pmod(F.xxhash64("Product_Code", "Date"), F.lit(3)))
    names = raw.columns[:-1]
    layouts = (
        [F.col(c) for c in names],
        [F.lit("x").alias("note"), *[F.col(c) for c in reversed(names)]],
        [F.col(c).alias(f" {c} ") for c in names[2:] + names[:2]],
    )
    for k, columns in enumerate(layouts):
        (
            raw.filter(F.col("_third") == k)
            .select(*columns)
            .write.mode("append")
            .option("header", "true")
            .option("quote", '"')
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .csv(path)
        )
    return read_raw(spark, path)


def q_partitioned_roundtrip(spark, sf):
    path = scratch_path(spark, "cleaned")
    write_cleaned(cleaned_demand(spark, sf), path, "parquet")
    return read_cleaned(spark, path)


# ---------------------------------------------------------------- cleaning


def q_drop_duplicates(spark, sf):
    return C.drop_duplicates(_raw(spark, sf))


def q_drop_duplicates_two_phase(spark, sf):
    """The same rows, with only fingerprints and possible repeats shuffled."""
    return drop_duplicates_in_two_phases(_raw(spark, sf))


def q_clean_categoricals(spark, sf):
    return C.clean_categoricals(C.drop_duplicates(_raw(spark, sf)))


def q_parse_date(spark, sf):
    df = C.clean_categoricals(C.drop_duplicates(_raw(spark, sf)))
    return C.parse_date(df, CLEAN_CFG.date_formats)


def q_parse_order_demand(spark, sf):
    return C.parse_order_demand(q_parse_date(spark, sf))


def q_flag_demand_anomalies(spark, sf):
    return _parsed(spark, sf)


def q_drop_negative_demand(spark, sf):
    return C.drop_negative_demand(_parsed(spark, sf))


def q_drop_null_keys(spark, sf):
    return C.drop_null_keys(_parsed(spark, sf))


def q_handle_nulls_drop(spark, sf):
    return C.handle_nulls(_parsed(spark, sf), "drop")


def q_handle_nulls_zero(spark, sf):
    return C.handle_nulls(_parsed(spark, sf), "zero")


def q_handle_nulls_median(spark, sf):
    return C.handle_nulls(FC.materialise(_parsed(spark, sf)), "median")


def q_product_median(spark, sf):
    return C.product_median(C.drop_null_keys(_parsed(spark, sf)))


def q_temporal_columns(spark, sf):
    return C.add_temporal_columns(_base(spark, sf))


def q_warehouse_fences(spark, sf):
    f = Q.warehouse_fences(_base(spark, sf), IQR_MULTIPLIER)
    return f.select("Warehouse", "Q1", "Q3", "IQR", _r("lower_fence"), _r("upper_fence"))


def q_warehouse_fences_exact(spark, sf):
    """The fences from exact quartiles, found in counting passes."""
    f = Q.warehouse_fences(_written_base(spark, sf), IQR_MULTIPLIER, exact=True)
    return f.select("Warehouse", "Q1", "Q3", "IQR", _r("lower_fence"), _r("upper_fence"))


def q_flag_outliers_iqr(spark, sf):
    return Q.flag_outliers_iqr(_written_base(spark, sf), IQR_MULTIPLIER)


def q_flag_outliers_zscore(spark, sf):
    return Q.flag_outliers_zscore(_written_base(spark, sf), Z_THRESHOLD)


def q_flag_sparse_products(spark, sf):
    return Q.flag_sparse_products(_written_base(spark, sf), MIN_RECORDS)


def q_warehouse_outliers(spark, sf):
    """Flagship: outlier rows and fences per warehouse after cleaning."""
    stages = clean_stages(_raw(spark, sf), replace(CLEAN_CFG, checkpoint_base=True))
    counts = stages["flagged"].groupBy("Warehouse").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("is_outlier")).alias("outlier_rows"),
        F.count_if(F.col("is_sparse_product")).alias("sparse_rows"),
    )
    fences = Q.warehouse_fences(stages["base"], IQR_MULTIPLIER).select(
        "Warehouse", _r("lower_fence"), _r("upper_fence")
    )
    return counts.join(fences, "Warehouse", "left")


def q_quality_summary(spark, sf):
    return Q.two_stage_summary(_parsed(spark, sf), CLEAN_CFG)


def q_merged_landing_summary(spark, sf):
    """Summaries of the landings of each year, written, read back and merged;
    whether the estimated distinct numbers are within their error is told."""
    path = scratch_path(spark, "landing-summaries")
    parsed = FC.materialise(_parsed(spark, sf)).withColumn("landing", F.coalesce(F.year("Date"), F.lit(0)))
    SU.summarise(parsed, ["landing"]).write.parquet(path)
    merged = SU.merge(spark.read.parquet(path))
    exact = parsed.agg(
        F.count_distinct("Product_Code").alias("products"), F.count_distinct("Warehouse").alias("warehouses")
    )
    near = [
        (F.abs(F.col(f"distinct_{c}") - F.col(c)) <= 0.08 * F.col(c)).alias(f"{c}_within_error")
        for c in ("products", "warehouses")
    ]
    return merged.crossJoin(F.broadcast(exact)).select(*SU.COUNTS, "min_date", "max_date", *near)  # one row each


def q_cleaning_step_report(spark, sf):
    return Q.cleaning_step_report(_raw(spark, sf), CLEAN_CFG)


def q_clean_demand(spark, sf):
    return _clean_from_raw(spark, sf)


# ---------------------------------------------------------------- features


def q_lag_features(spark, sf):
    return FE.add_lag_features(cleaned_demand(spark, sf), FEATURE_CFG)


def q_rolling_features(spark, sf):
    return _round_features(FE.add_rolling_features(cleaned_demand(spark, sf), FEATURE_CFG))


def q_rolling_features_in_blocks(spark, sf):
    """Lag and rolling features with every series of more than eight rows cut
    into blocks by position."""
    blocked = FE.add_lag_rolling(cleaned_demand(spark, sf), replace(FEATURE_CFG, block_rows=8))
    return _round_features(blocked)


def q_binary_indicators(spark, sf):
    return FE.add_binary_indicators(cleaned_demand(spark, sf))


def q_demand_features(spark, sf):
    return _round_features(_featured(spark, sf))


# ---------------------------------------------------------------- explore


def q_describe_demand(spark, sf):
    return _rounded(X.describe_demand(cleaned_demand(spark, sf)), "mean", "stddev")


def q_monthly_demand(spark, sf):
    return X.monthly_demand(cleaned_demand(spark, sf), PRODUCT)


def q_month_dow_heatmap(spark, sf):
    return _rounded(X.month_dow_heatmap(cleaned_demand(spark, sf)), *[f"dow_{d}" for d in range(1, 8)])


def q_warehouse_impact(spark, sf):
    return _rounded(X.warehouse_impact(cleaned_demand(spark, sf)), "avg_monday_demand")


def q_category_impact_top10(spark, sf):
    return X.category_impact_top(cleaned_demand(spark, sf), 10)


def q_pareto_categories(spark, sf):
    return _rounded(X.pareto_categories(cleaned_demand(spark, sf)), "cumulative_percentage")


def q_seasonal_boxplot_stats(spark, sf):
    return X.seasonal_boxplot_stats(cleaned_demand(spark, sf), WAREHOUSE, CATEGORY)


def q_daily_signal(spark, sf):
    return X.daily_signal(cleaned_demand(spark, sf), WAREHOUSE, CATEGORY)


def q_lag_pairs(spark, sf):
    return X.lag_pairs(cleaned_demand(spark, sf), PRODUCT, FEATURE_CFG)


def q_demand_acf(spark, sf):
    return _rounded(X.demand_acf(X.daily_signal(cleaned_demand(spark, sf), WAREHOUSE, CATEGORY), 31), "acf", "conf_band")


def q_seasonal_decompose(spark, sf):
    return _rounded(X.seasonal_decompose(cleaned_demand(spark, sf), 12), "trend", "seasonal", "resid")


# ---------------------------------------------------------------- forecasting


def q_whale_slice(spark, sf):
    return _round_features(FC.whale_slice(_featured(spark, sf), WAREHOUSE, CATEGORY))


def q_train_test_split(spark, sf):
    s = FC.whale_slice(_featured(spark, sf), WAREHOUSE, CATEGORY)
    return _round_features(FC.split_column(s, TEST_YEAR))


METRICS = ("mae", "accuracy", "f1", "precision", "recall")


def _reference_metrics(spark, sf):
    s = FC.whale_slice(_featured(spark, sf), WAREHOUSE, CATEGORY)
    _, test = FC.train_test(s, TEST_YEAR)
    return EV.forecast_metrics(EV.reference_predictions(test), THRESHOLD)


def q_forecast_metrics(spark, sf):
    return _rounded(_reference_metrics(spark, sf), *METRICS)


def q_leaderboard(spark, sf):
    return _rounded(EV.leaderboard(_reference_metrics(spark, sf)), *METRICS)


def _split(spark, sf):
    s = FC.whale_slice(_featured(spark, sf), WAREHOUSE, CATEGORY)
    return FC.materialise_sides(FC.split_column(s, TEST_YEAR))


RIDGE, TREND, FOREST, BY_LEVEL, LEAFWISE = DEFAULT_MODELS


def _contender(name):
    def q(spark, sf):
        train, test = _split(spark, sf)
        _, pred = FC.fit_predict(name, train, test, TRAIN_CFG)
        return pred.select("model", "Product_Code", "Date", "Order_Demand", "prediction")

    return q


def q_forecast_tournament(spark, sf):
    board, _, _ = FC.run_tournament(_featured(spark, sf), TRAIN_CFG)
    return board


def q_score_request_features(spark, sf):
    cleaned = cleaned_demand(spark, sf)
    features = SC.request_features(SC.requests_from_table(cleaned, TEST_YEAR), cleaned)
    return _rounded(features, "demand_T_minus_2", "rolling_7d_stddev", "rolling_7d_mean")


def _scored(spark, sf):
    cleaned = cleaned_demand(spark, sf)
    train, _ = _split(spark, sf)
    model = FC.fit(FOREST, train, TRAIN_CFG)
    reqs = SC.requests_from_table(cleaned, TEST_YEAR)
    return SC.score_requests(reqs, cleaned, model, "random_forest@local")


def q_score_requests(spark, sf):
    return _scored(spark, sf)


# Companions of the learned queries whose results SQL can give.


def q_score_requests_echo(spark, sf):
    """Every request's fields and error; whether it has a prediction."""
    return _scored(spark, sf).select(
        "warehouse", "product_category", "target_date", "error",
        F.col("predicted_demand").isNotNull().alias("has_prediction"),
    )


def q_forest_within_labels(spark, sf):
    """Per test row whether the forest's prediction lies within the labels it
    was trained on (means of labels always do)."""
    train, test = _split(spark, sf)
    _, pred = FC.fit_predict(FOREST, train, test, TRAIN_CFG)
    bounds = train.agg(F.min("Order_Demand").alias("low"), F.max("Order_Demand").alias("high"))
    near = F.col("prediction").between(F.col("low") - 1e-6, F.col("high") + 1e-6)
    return pred.crossJoin(F.broadcast(bounds)).select(  # one row of bounds
        "Product_Code", "Warehouse", "Date", "Order_Demand", near.alias("within_labels")
    )


def q_ridge_normal_equations(spark, sf):
    """Per feature the normal-equation residual of the ridge fit, relative to
    the largest term: X'(y - Xw) = alpha w at the solution."""
    train, _ = _split(spark, sf)
    return FC.ridge_residuals(train, TRAIN_CFG).select(
        "feature", (F.abs("residual") < 1e-6).alias("solved")
    )


def q_tournament_test_rows(spark, sf):
    """Per contender the test rows it was scored on and the true positives
    among them, from the same fits as the tournament's."""
    _, _, preds = FC.run_tournament(_featured(spark, sf), TRAIN_CFG)
    return preds.groupBy("model").agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.count_if(F.col("Order_Demand") > THRESHOLD).alias("high_demand_rows"),
        F.count_if(F.col("prediction").isNull()).alias("without_prediction"),
    )


def q_boosted_first_stumps(spark, sf):
    """Both boosted contenders' first split, cut to one level, with the medians
    of its sides; trained in one task and distributed."""
    s = FC.whale_slice(_featured(spark, sf), WAREHOUSE, CATEGORY)
    train = FC.materialise(_round_features(FC.train_test(s, TEST_YEAR)[0]))
    found = [
        FC.first_stumps(train, FC.boost_params(name, TRAIN_CFG), ("one task", "distributed")).withColumn(
            "model", F.lit(name)
        )
        for name in (BY_LEVEL, LEAFWISE)
    ]
    return found[0].unionByName(found[1])


def _per_term(models: DataFrame, names: list[str], *keep: str) -> DataFrame:
    """One row per coefficient: its moment with the label, and whether the
    optimality condition of the fit holds for it."""
    each = models.select(
        *keep, F.posexplode(F.arrays_zip("moments", "misses")).alias("position", "found")
    )
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("position") + 1)
    return each.select(
        *keep,
        name.alias("term"),
        _r(F.col("found.moments"), "moment"),
        (F.col("found.misses") < 1e-6).alias("solved"),
    )


def q_trend_conditions(spark, sf):
    """Per coefficient of the trend + seasonality fit: the sum of products of
    its column with the label, and whether the posterior is at its maximum."""
    train, _ = _split(spark, sf)
    models = MO.fit(train.withColumn("slice", F.lit(0)), ["slice"], "trend")
    return _per_term(models, MO.term_names("trend"))


GROUP_CFG = replace(TRAIN_CFG, group_cols=("Warehouse", "Product_Category"))


def q_group_ridge(spark, sf):
    """Ridge of every category x warehouse from one aggregation: training rows,
    moments and optimality of each coefficient."""
    train, _ = FC.train_test(_featured(spark, sf), TEST_YEAR)
    keys = list(GROUP_CFG.group_cols)
    models = MO.fit(FC.materialise(train), keys, "ridge")
    return _per_term(models, MO.term_names("ridge"), *keys, "rows")


def q_group_leaderboard(spark, sf):
    """Every category x warehouse with a model of its own per contender."""
    board, _, _ = FC.run_group_tournament(_featured(spark, sf), GROUP_CFG, GROUP_CFG.models)
    return board


def q_seasonal_decompose_excluded(spark, sf):
    return X.decomposition_exclusions(cleaned_demand(spark, sf), 12)


def q_lag_pair_correlation(spark, sf):
    pairs = X.lag_pairs(cleaned_demand(spark, sf), PRODUCT, FEATURE_CFG)
    return _rounded(X.lag_pair_correlation(pairs), "correlation")


QUERIES: dict[str, Query] = {
    "raw_demand": q_raw_demand,
    "scan_csv_roundtrip": q_scan_csv_roundtrip,
    "partitioned_roundtrip": q_partitioned_roundtrip,
    "drop_duplicates": q_drop_duplicates,
    "drop_duplicates_two_phase": q_drop_duplicates_two_phase,
    "clean_categoricals": q_clean_categoricals,
    "parse_date": q_parse_date,
    "parse_order_demand": q_parse_order_demand,
    "flag_demand_anomalies": q_flag_demand_anomalies,
    "drop_negative_demand": q_drop_negative_demand,
    "drop_null_keys": q_drop_null_keys,
    "handle_nulls_drop": q_handle_nulls_drop,
    "handle_nulls_zero": q_handle_nulls_zero,
    "handle_nulls_median": q_handle_nulls_median,
    "product_median": q_product_median,
    "temporal_columns": q_temporal_columns,
    "warehouse_fences": q_warehouse_fences,
    "flag_outliers_iqr": q_flag_outliers_iqr,
    "flag_outliers_zscore": q_flag_outliers_zscore,
    "flag_sparse_products": q_flag_sparse_products,
    "warehouse_outliers": q_warehouse_outliers,
    "quality_summary": q_quality_summary,
    "merged_landing_summary": q_merged_landing_summary,
    "cleaning_step_report": q_cleaning_step_report,
    "clean_demand": q_clean_demand,
    "lag_features": q_lag_features,
    "rolling_features": q_rolling_features,
    "binary_indicators": q_binary_indicators,
    "demand_features": q_demand_features,
    "describe_demand": q_describe_demand,
    "monthly_demand": q_monthly_demand,
    "month_dow_heatmap": q_month_dow_heatmap,
    "warehouse_impact": q_warehouse_impact,
    "category_impact_top10": q_category_impact_top10,
    "pareto_categories": q_pareto_categories,
    "seasonal_boxplot_stats": q_seasonal_boxplot_stats,
    "daily_signal": q_daily_signal,
    "lag_pairs": q_lag_pairs,
    "demand_acf": q_demand_acf,
    "seasonal_decompose": q_seasonal_decompose,
    "whale_slice": q_whale_slice,
    "train_test_split": q_train_test_split,
    "forecast_metrics": q_forecast_metrics,
    "leaderboard": q_leaderboard,
    "score_request_features": q_score_request_features,
    "ridge_forecast": _contender(RIDGE),
    "seasonal_trend_forecast": _contender(TREND),
    "random_forest_forecast": _contender(FOREST),
    "gbt_forecast": _contender(BY_LEVEL),
    "leafwise_boosting_forecast": _contender(LEAFWISE),
    "forecast_tournament": q_forecast_tournament,
    "score_requests": q_score_requests,
    "scan_csv_reordered": q_scan_csv_reordered,
    "seasonal_decompose_excluded": q_seasonal_decompose_excluded,
    "lag_pair_correlation": q_lag_pair_correlation,
    "score_requests_echo": q_score_requests_echo,
    "forest_within_labels": q_forest_within_labels,
    "ridge_normal_equations": q_ridge_normal_equations,
    "tournament_test_rows": q_tournament_test_rows,
    "scan_csv_layouts": q_scan_csv_layouts,
    "warehouse_fences_exact": q_warehouse_fences_exact,
    "rolling_features_in_blocks": q_rolling_features_in_blocks,
    "boosted_first_stumps": q_boosted_first_stumps,
    "trend_conditions": q_trend_conditions,
    "group_ridge": q_group_ridge,
    "group_leaderboard": q_group_leaderboard,
}
