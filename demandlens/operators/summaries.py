"""Quality summaries that merge.

A landed partition (a day's files, a region's) is summarised once: additive
figures, extremes, and sketches of its distinct products and warehouses, in one
row of a small table. The summary of everything is a merge of these rows, so a
new landing reads its own rows only. Counts and extremes are exact; distinct
numbers are HyperLogLog estimates, whose relative standard error is
1.04 / sqrt(2^LG_K), 1.6 % here (exact while a sketch is small). For exact
distinct numbers use ``quality.quality_summary``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K = 12
_DISTINCT = {"products": "Product_Code", "warehouses": "Warehouse"}
_FLAGS = {
    "negative_demand_rows": "is_negative_demand",
    "zero_demand_rows": "is_zero_demand",
    "date_parse_failures": "date_parse_failed",
}
COUNTS = ("total_rows", "null_demand_rows", *_FLAGS)


def summarise(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per value of ``by`` (the landed partitions), or one in all. A
    flag that the table does not have is counted as null."""
    flags = [
        (F.count_if(F.col(c)) if c in df.columns else F.lit(None).cast("bigint")).alias(name)
        for name, c in _FLAGS.items()
    ]
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("Order_Demand").isNull()).alias("null_demand_rows"),
        *flags,
        F.min("Date").alias("min_date"),
        F.max("Date").alias("max_date"),
        *[F.hll_sketch_agg(c, F.lit(LG_K)).alias(f"{name}_sketch") for name, c in _DISTINCT.items()],
    )


def merge(summaries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The summary of all rows of ``summaries`` (per value of ``by``), with
    estimates instead of sketches."""
    counts = [F.sum(c).alias(c) for c in COUNTS]
    estimates = [
        F.hll_sketch_estimate(F.hll_union_agg(f"{name}_sketch")).alias(f"distinct_{name}") for name in _DISTINCT
    ]
    return summaries.groupBy(*by).agg(
        *counts, F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"), *estimates
    )


def add_landing(path: str, landing: str, rows: DataFrame) -> None:
    """Summarises the rows of a landing into the table at ``path``. A landing
    that was summarised before is replaced."""
    summarise(rows).withColumn("landing", F.lit(landing)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("landing").parquet(path)


def landings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)
