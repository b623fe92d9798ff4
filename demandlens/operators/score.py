"""Batch scoring of forecast requests (warehouse, product_category,
target_date).

History per request = the last 7 observed daily totals of its (warehouse,
category) strictly before the target date. Instead of a range join
(request x history, which grows with both), the daily totals are
aggregated first, their rolling statistics computed by a window per
(warehouse, category) over days (bounded), and each request picks the
statistics of the last day before it with an as-of step: requests and days
are unioned into one timeline and ``last(..., ignorenulls)`` carries the
latest day forward.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from demandlens.config import FEATURE_COLUMNS
from demandlens.functions.calendar import is_monday, is_q4
from demandlens.functions.parsing import multi_format_date

REQUEST_SCHEMA = StructType(
    [
        StructField("warehouse", StringType(), False),
        StructField("product_category", StringType(), False),
        StructField("target_date", StringType(), False),
    ]
)
HISTORY = 7
#: Layouts of a request's date, tried in this order; a time of day may follow.
TARGET_DATE_FORMATS = ("yyyy-M-d", "yyyy/M/d", "M/d/yyyy", "yyyyMMdd", "d MMM yyyy", "MMM d, yyyy")


def validate_requests(requests: DataFrame) -> DataFrame:
    """Schema check (raises on missing fields) and a per-row validity flag:
    the target date must parse under one of ``TARGET_DATE_FORMATS``."""
    missing = [f.name for f in REQUEST_SCHEMA if f.name not in requests.columns]
    if missing:
        raise ValueError(f"Request fields missing: {missing}")
    t = multi_format_date(F.col("target_date").cast("string"), TARGET_DATE_FORMATS, lenient=True)
    return requests.withColumns(
        {
            "warehouse": F.upper(F.trim("warehouse")),
            "product_category": F.upper(F.trim("product_category")),
            "_target": t,
            "valid_request": t.isNotNull(),
        }
    )


def daily_history_stats(cleaned: DataFrame, n: int = HISTORY) -> DataFrame:
    """Per (warehouse, category, day): the rolling stats of the last ``n``
    days up to and including that day, the previous day's total and the
    number of days available."""
    daily = cleaned.groupBy(
        F.col("Warehouse").alias("warehouse"),
        F.col("Product_Category").alias("product_category"),
        F.col("Date").alias("day"),
    ).agg(F.sum("Order_Demand").cast("double").alias("total"))
    w = Window.partitionBy("warehouse", "product_category").orderBy("day")
    frame = w.rowsBetween(-(n - 1), 0)
    return daily.select(
        "warehouse",
        "product_category",
        "day",
        F.avg("total").over(frame).alias("h_mean"),
        F.stddev_samp("total").over(frame).alias("h_std"),
        F.lag("total", 1).over(w).alias("h_second_last"),
        F.count(F.lit(1)).over(frame).alias("h_count"),
    )


def request_features(requests: DataFrame, cleaned: DataFrame, n: int = HISTORY) -> DataFrame:
    """Model inputs for each request; ``insufficient_history`` when fewer
    than ``n`` prior days exist (the row is kept and flagged).

    Features depend only on (warehouse, category, date), so they are built
    once per distinct key (bounded by pairs x days, whatever the number of
    requests) and joined back to the requests; a heavily repeated request
    key is a skewed equi-join, which AQE splits."""
    req = validate_requests(requests)
    hist = daily_history_stats(cleaned, n)
    stat_cols = ["h_mean", "h_std", "h_second_last", "h_count"]
    keys = req.filter(F.col("valid_request")).select(
        "warehouse", "product_category", F.col("_target").alias("_t")
    ).distinct()
    # requests sort before days of the same date: history is strictly earlier
    timeline = keys.select(
        "warehouse",
        "product_category",
        "_t",
        F.lit(0).alias("_kind"),
        *[F.lit(None).cast("double").alias(c) for c in stat_cols],
    ).unionByName(
        hist.select(
            "warehouse",
            "product_category",
            F.col("day").alias("_t"),
            F.lit(1).alias("_kind"),
            *[F.col(c).cast("double").alias(c) for c in stat_cols],
        )
    )
    w = Window.partitionBy("warehouse", "product_category").orderBy("_t", "_kind").rowsBetween(
        Window.unboundedPreceding, -1
    )
    per_key = (
        timeline.withColumns({c: F.last(F.col(c), ignorenulls=True).over(w) for c in stat_cols})
        .filter(F.col("_kind") == 0)
        .drop("_kind")
        .withColumnRenamed("_t", "_target")
    )
    carried = req.join(per_key, ["warehouse", "product_category", "_target"], "left")
    t = F.col("_target")
    cnt = F.coalesce(F.col("h_count"), F.lit(0.0)).cast("int")
    return carried.select(
        *[c for c in req.columns if not c.startswith("_")],
        F.year(t).alias("year"),
        F.month(t).alias("month"),
        F.dayofweek(t).alias("day_of_week"),
        F.weekofyear(t).alias("week_of_year"),
        F.col("h_second_last").alias("demand_T_minus_2"),
        F.col("h_std").alias("rolling_7d_stddev"),
        F.col("h_mean").alias("rolling_7d_mean"),
        is_q4(F.month(t)).alias("is_q4"),
        is_monday(F.dayofweek(t)).alias("is_monday"),
        cnt.alias("history_days"),
        (cnt < n).alias("insufficient_history"),
    )


def requests_from_table(cleaned: DataFrame, year: int) -> DataFrame:
    """Request set derived from the data: every observed (warehouse,
    category, day) of ``year``."""
    return (
        cleaned.filter(F.col("year") == year)
        .select(
            F.col("Warehouse").alias("warehouse"),
            F.col("Product_Category").alias("product_category"),
            F.date_format("Date", "yyyy-MM-dd").alias("target_date"),
        )
        .distinct()
    )


def score_requests(
    requests: DataFrame, cleaned: DataFrame, model: PipelineModel, model_version: str
) -> DataFrame:
    feats = request_features(requests, cleaned)
    ok = feats.filter(F.col("valid_request") & ~F.col("insufficient_history"))
    scored = model.transform(ok.fillna(0.0, subset=list(FEATURE_COLUMNS)))
    out = scored.select(
        "warehouse",
        "product_category",
        "target_date",
        F.col("prediction").cast("double").alias("predicted_demand"),
        F.lit(model_version).alias("model_version"),
        F.lit(None).cast("string").alias("error"),
    )
    rejected = feats.filter(~F.col("valid_request") | F.col("insufficient_history")).select(
        "warehouse",
        "product_category",
        "target_date",
        F.lit(None).cast("double").alias("predicted_demand"),
        F.lit(model_version).alias("model_version"),
        F.when(~F.col("valid_request"), F.lit("invalid target_date"))
        .otherwise(F.lit("insufficient history"))
        .alias("error"),
    )
    return out.unionByName(rejected)
