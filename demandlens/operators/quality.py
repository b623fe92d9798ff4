"""Quality statistics and flags: outliers (IQR / z-score per warehouse),
sparse products, the quality summary and the per-step cleaning report.

Statistics are aggregates with map-side partial aggregation (quantile
sketches merge), attached back with a size-checked join; no window over a
warehouse, which would put a whole warehouse into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlens.config import CleanConfig
from demandlens.operators.joins import BROADCAST_BYTES, attach_stats
from demandlens.operators.quantiles import exact_quantiles
from demandlens.session import shared_dir


def _positive(x: Column) -> Column:
    # conditional input instead of a pre-filter: a filter would be pushed
    # below the dedupe aggregate and fork the plan, while a NULL-ignoring
    # aggregate keeps one subtree that the facts and every statistic share
    return F.when(x > 0, x)


def warehouse_fences(
    df: DataFrame, multiplier: float = 3.0, accuracy: int = 10000, exact: bool = False
) -> DataFrame:
    """Q1/Q3 of positive demand per warehouse and the fences
    ``Q1 - m*IQR`` / ``Q3 + m*IQR``. One sketch yields both quartiles;
    ``exact=True`` finds the exact discrete ones in a few counting passes.
    Warehouses without positive demand get no row."""
    x = _positive(F.col("Order_Demand"))
    if exact:
        stats = exact_quantiles(df, ["Warehouse"], x, {"Q1": 0.25, "Q3": 0.75}).drop("n")
    else:
        stats = (
            df.groupBy("Warehouse")
            .agg(F.percentile_approx(x, [0.25, 0.75], accuracy).alias("_q"))
            .select("Warehouse", F.col("_q")[0].alias("Q1"), F.col("_q")[1].alias("Q3"))
        )
    stats = stats.filter(F.col("Q1").isNotNull())
    iqr = F.col("Q3") - F.col("Q1")
    return stats.select(
        "Warehouse",
        "Q1",
        "Q3",
        iqr.alias("IQR"),
        (F.col("Q1") - F.lit(multiplier) * iqr).alias("lower_fence"),
        (F.col("Q3") + F.lit(multiplier) * iqr).alias("upper_fence"),
    )


def _outside(x: Column, lo: Column, hi: Column) -> Column:
    # NULL fences (no positive demand in a warehouse) give NULL, a NULL
    # demand gives False
    return F.when(x.isNotNull(), (x < lo) | (x > hi)).otherwise(F.lit(False))


def flag_outliers_iqr(
    df: DataFrame,
    multiplier: float = 3.0,
    accuracy: int = 10000,
    exact: bool = False,
    broadcast_max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    fences = warehouse_fences(df, multiplier, accuracy, exact).select(
        "Warehouse", "lower_fence", "upper_fence"
    )
    cols = df.columns
    joined = attach_stats(df, fences, ["Warehouse"], broadcast_max_bytes)
    flag = _outside(F.col("Order_Demand"), F.col("lower_fence"), F.col("upper_fence"))
    return joined.select(*cols, flag.alias("is_outlier"))


def warehouse_moments(df: DataFrame) -> DataFrame:
    x = _positive(F.col("Order_Demand"))
    return (
        df.groupBy("Warehouse")
        .agg(F.avg(x).alias("mean_demand"), F.stddev_samp(x).alias("std_demand"))
        .filter(F.col("mean_demand").isNotNull())
    )


def flag_outliers_zscore(
    df: DataFrame, threshold: float = 4.0, broadcast_max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    cols = df.columns
    joined = attach_stats(df, warehouse_moments(df), ["Warehouse"], broadcast_max_bytes)
    std = F.col("std_demand")
    z = F.when(std > 0, F.abs(F.col("Order_Demand") - F.col("mean_demand")) / std).otherwise(
        F.lit(0.0)
    )
    return joined.select(*cols, (z > F.lit(threshold)).alias("is_outlier"))


def flag_outliers(df: DataFrame, cfg: CleanConfig) -> DataFrame:
    if cfg.outlier_strategy == "iqr":
        return flag_outliers_iqr(
            df, cfg.iqr_multiplier, cfg.quantile_accuracy, broadcast_max_bytes=cfg.broadcast_max_bytes
        )
    if cfg.outlier_strategy == "zscore":
        return flag_outliers_zscore(df, cfg.zscore_threshold, cfg.broadcast_max_bytes)
    raise ValueError(f"Unknown outlier strategy '{cfg.outlier_strategy}'.")


def product_record_counts(df: DataFrame) -> DataFrame:
    """Non-null demand rows per product; products without any get no row
    (their sparse flag stays NULL)."""
    return (
        df.groupBy("Product_Code")
        .agg(F.count("Order_Demand").alias("record_count"))
        .filter(F.col("record_count") > 0)
    )


def flag_sparse_products(
    df: DataFrame,
    min_records: int = 10,
    broadcast_max_bytes: int = BROADCAST_BYTES,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``counted`` has the rows to count (default: the flagged rows)."""
    cols = df.columns
    stats = product_record_counts(df if counted is None else counted)
    joined = attach_stats(df, stats, ["Product_Code"], broadcast_max_bytes)
    return joined.select(*cols, (F.col("record_count") < min_records).alias("is_sparse_product"))


def _count_flag(df: DataFrame, name: str) -> Column:
    if name in df.columns:
        return F.count_if(F.col(name))
    return F.lit(None).cast("bigint")


def quality_summary(df: DataFrame, stage: str = "cleaned", approx: bool = False) -> DataFrame:
    """All summary figures in ONE aggregation (one job), as a 1-row frame.
    Flags absent at this stage give NULL counts."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        distinct("Product_Code").alias("distinct_products"),
        distinct("Warehouse").alias("distinct_warehouses"),
        F.min("Date").alias("min_date"),
        F.max("Date").alias("max_date"),
        F.count_if(F.col("Order_Demand").isNull()).alias("null_demand_rows"),
        _count_flag(df, "is_negative_demand").alias("negative_demand_rows"),
        _count_flag(df, "is_zero_demand").alias("zero_demand_rows"),
        _count_flag(df, "is_outlier").alias("outlier_rows"),
        _count_flag(df, "is_sparse_product").alias("sparse_product_rows"),
        _count_flag(df, "date_parse_failed").alias("date_parse_failures"),
    ).select(F.lit(stage).alias("stage"), "*")


def two_stage_summary(parsed: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """The quality summary of the parsed stage AND of the cleaned output
    (with outlier and sparse flags). The parsed, deduped rows are written once
    to the shared folder; each statistic is an aggregate over them, measured
    and joined by size, and all figures come from one aggregation, in which
    the cleaned stage is a condition instead of a filter."""
    from demandlens.operators.clean import not_null

    shared_dir(parsed.sparkSession)
    parsed = parsed.checkpoint()
    x = F.col("Order_Demand")
    keep = (x >= 0) & not_null(["Product_Code", "Warehouse", "Product_Category", "Date"])
    kept_x = F.when(keep, x)
    cols = parsed.columns
    # rows without a key are in no statistic and need none: they are not kept
    limit = cfg.broadcast_max_bytes
    if cfg.outlier_strategy == "iqr":
        fences = (
            parsed.groupBy("Warehouse")
            .agg(F.percentile_approx(F.when(keep & (x > 0), x), [0.25, 0.75], cfg.quantile_accuracy).alias("_q"))
            .filter(F.col("_q").isNotNull())
        )
        q1, q3 = F.col("_q")[0], F.col("_q")[1]
        m = F.lit(cfg.iqr_multiplier)
        joined = attach_stats(parsed, fences, ["Warehouse"], limit)
        flag = _outside(x, q1 - m * (q3 - q1), q3 + m * (q3 - q1))
    elif cfg.outlier_strategy == "zscore":
        pos = F.when(keep & (x > 0), x)
        moments = (
            parsed.groupBy("Warehouse")
            .agg(F.avg(pos).alias("_mean"), F.stddev_samp(pos).alias("_std"))
            .filter(F.col("_mean").isNotNull())
        )
        joined = attach_stats(parsed, moments, ["Warehouse"], limit)
        z = F.when(F.col("_std") > 0, F.abs(x - F.col("_mean")) / F.col("_std")).otherwise(F.lit(0.0))
        flag = z > F.lit(cfg.zscore_threshold)
    else:
        raise ValueError(f"Unknown outlier strategy '{cfg.outlier_strategy}'.")
    flagged = joined.select(*cols, flag.alias("is_outlier"))
    records = (
        parsed.groupBy("Product_Code")
        .agg(F.count(kept_x).alias("_records"))
        .filter(F.col("_records") > 0)
    )
    flagged = attach_stats(flagged, records, ["Product_Code"], limit).select(
        *cols, "is_outlier", (F.col("_records") < cfg.min_records_per_product).alias("is_sparse_product")
    )

    def kept(c: Column) -> Column:
        return F.when(keep, c)

    def kept_if(c: Column) -> Column:
        return F.count_if(keep & c)

    # additive figures per (product, warehouse) first: the distinct counts
    # then run over that small table instead of expanding every fact
    small = flagged.groupBy("Product_Code", "Warehouse").agg(
        F.count(F.lit(1)).alias("p_total"),
        F.min("Date").alias("p_min"),
        F.max("Date").alias("p_max"),
        F.count_if(x.isNull()).alias("p_null"),
        F.count_if(F.col("is_negative_demand")).alias("p_neg"),
        F.count_if(F.col("is_zero_demand")).alias("p_zero"),
        F.count_if(F.col("date_parse_failed")).alias("p_datefail"),
        F.count_if(keep).alias("c_total"),
        F.min(kept(F.col("Date"))).alias("c_min"),
        F.max(kept(F.col("Date"))).alias("c_max"),
        kept_if(x.isNull()).alias("c_null"),
        kept_if(F.col("is_negative_demand")).alias("c_neg"),
        kept_if(F.col("is_zero_demand")).alias("c_zero"),
        kept_if(F.col("is_outlier")).alias("c_outlier"),
        kept_if(F.col("is_sparse_product")).alias("c_sparse"),
        kept_if(F.col("date_parse_failed")).alias("c_datefail"),
    )
    counts = [c for c, t in small.dtypes if t == "bigint"]
    some = F.col("c_total") > 0
    wide = small.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts],
        F.min("p_min").alias("p_min"),
        F.max("p_max").alias("p_max"),
        F.min("c_min").alias("c_min"),
        F.max("c_max").alias("c_max"),
        F.count_distinct("Product_Code").alias("p_products"),
        F.count_distinct("Warehouse").alias("p_warehouses"),
        F.count_distinct(F.when(some, F.col("Product_Code"))).alias("c_products"),
        F.count_distinct(F.when(some, F.col("Warehouse"))).alias("c_warehouses"),
    )
    nb = "CAST(NULL AS BIGINT)"
    return wide.select(
        F.expr(
            "stack(2,"
            f" 'parsed', p_total, p_products, p_warehouses, p_min, p_max, p_null, p_neg, p_zero, {nb}, {nb}, p_datefail,"
            " 'cleaned', c_total, c_products, c_warehouses, c_min, c_max, c_null, c_neg, c_zero, c_outlier, c_sparse,"
            " c_datefail) AS (stage, total_rows, distinct_products, distinct_warehouses, min_date, max_date,"
            " null_demand_rows, negative_demand_rows, zero_demand_rows, outlier_rows, sparse_product_rows,"
            " date_parse_failures)"
        )
    )


def cleaning_step_report(raw: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Rows in / out / flagged for each row-level cleaning step, from ONE
    aggregation over the distinct raw rows (the dedupe aggregate carries the
    duplicate multiplicity, so raw and distinct counts need no second scan).
    The null-demand strategy is reported as in the reference order (after
    the >= 0 filter)."""
    from demandlens.operators.clean import clean_categoricals, parse_date, parse_order_demand

    grouped = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("_mult"))
    parsed = parse_order_demand(
        parse_date(clean_categoricals(grouped), cfg.date_formats, cfg.lenient_dates)
    )
    d = F.col("Order_Demand")
    keys_ok = F.col("Product_Code").isNotNull() & F.col("Warehouse").isNotNull()
    keys_ok = keys_ok & F.col("Product_Category").isNotNull() & F.col("Date").isNotNull()
    kept = d >= 0
    totals = parsed.agg(
        F.sum("_mult").cast("bigint").alias("raw_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.count_if(F.col("date_parse_failed")).alias("date_failed"),
        F.count_if(F.col("demand_cast_failed")).alias("demand_failed"),
        F.count_if(d < 0).alias("negative"),
        F.count_if(d.isNull()).alias("null_demand"),
        F.count_if(kept).alias("non_negative"),
        F.count_if(kept & keys_ok).alias("final_rows"),
    )
    stack = F.expr(
        "stack(6,"
        " 1, 'drop_duplicates', raw_rows, distinct_rows, raw_rows - distinct_rows,"
        " 2, 'parse_date', distinct_rows, distinct_rows, date_failed,"
        " 3, 'parse_order_demand', distinct_rows, distinct_rows, demand_failed,"
        " 4, 'drop_negative_demand', distinct_rows, non_negative, negative + null_demand,"
        " 5, 'drop_null_keys', non_negative, final_rows, non_negative - final_rows,"
        " 6, 'handle_null_demand', final_rows, final_rows, CAST(0 AS BIGINT))"
        " AS (step_no, step, rows_in, rows_out, rows_affected)"
    )
    return totals.select(stack)
