"""Row-based lag and rolling features per (Product_Code, Warehouse) series,
calendar indicators and feature-null filling.

Skew: a plain ``Window.partitionBy(series)`` sends a whole series to one
task. Here the rows of a series longer than ``block_rows`` get their position
in the series by a distributed prefix sum: they are range-partitioned and
sorted once, so their order is that of the partitions, and the count of each
series per partition (a small table) gives where each partition begins. Blocks
are cut by position, inside a date where need be; each block also receives the
``lookback`` rows before it (a halo), the window runs per (series, block), and
halo rows are dropped afterwards. Results equal the unsplit window: rows that
share all of the order keep the order of their positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlens.config import FeatureConfig
from demandlens.functions.calendar import is_monday, is_q4
from demandlens.operators.clean import not_null
from demandlens.operators.joins import BROADCAST_BYTES, attach_stats
from demandlens.session import scratch_path, shared_dir

SERIES_KEYS = ("Product_Code", "Warehouse")
# Deterministic order of rows that share a date.
TIE_BREAK = ("Order_Demand", "Product_Category")


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], max_bytes: int) -> DataFrame:
    """Adds ``_pos``, the row's position from 0 in its series. Rows are dealt to
    partitions by all of (keys, order, source row), so equal ones split too."""
    spark, keys = df.sparkSession, list(keys)
    by = [*keys, *order, "_source"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("_source", F.monotonically_increasing_id()).repartitionByRange(parts, *by)
    # the numbers hold for this order of partitions only, so it is written once
    path = scratch_path(spark, "ordered-series")
    numbered = dealt.sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id())
    numbered.drop("_source").write.parquet(path)
    # an id is (partition, row in it), as two parts of one number
    placed = spark.read.parquet(path).withColumn("_part", F.shiftright("_id", 33))
    runs = placed.groupBy(*keys, "_part").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    joined = attach_stats(placed, runs, [*keys, "_part"], max_bytes)
    position = F.col("_before") + F.col("_id") - F.col("_first")
    return joined.select(*df.columns, position.alias("_pos"))


def series_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lookback: int,
    block_rows: int,
    broadcast_max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``_blk`` (block id within the series), ``_halo`` (row is a copy that
    only serves as preceding context of block ``_blk``) and ``_pos``, which
    orders rows of a split series that share all of ``order``."""
    keys = list(keys)
    shared_dir(df.sparkSession)
    sizes = df.filter(not_null(keys)).groupBy(*keys).count()
    hot = sizes.filter(F.col("count") > block_rows).select(*keys, F.lit(True).alias("_hot"))
    hot = hot.checkpoint()  # at most rows / block_rows series, often none
    whole = {"_blk": F.lit(0).cast("long"), "_halo": F.lit(False), "_pos": F.lit(0).cast("long")}
    if hot.isEmpty():
        return df.withColumns(whole)
    marked = attach_stats(df, hot, keys, broadcast_max_bytes)
    cold = marked.filter(F.col("_hot").isNull()).select(*df.columns).withColumns(whole)
    long_ones = marked.filter(F.col("_hot")).select(*df.columns)
    placed = positions(long_ones, keys, order, broadcast_max_bytes)
    own = F.floor(F.col("_pos") / block_rows).cast("long")
    upto = F.floor((F.col("_pos") + lookback) / block_rows).cast("long")
    blocks = placed.select("*", own.alias("_own"), F.explode(F.sequence(own, upto)).alias("_blk"))
    split = blocks.select(*df.columns, "_blk", (F.col("_blk") != F.col("_own")).alias("_halo"), "_pos")
    return cold.unionByName(split)


def add_lag_rolling(
    df: DataFrame,
    cfg: FeatureConfig = FeatureConfig(),
    lag: bool = True,
    rolling: bool = True,
) -> DataFrame:
    """``demand_T_minus_{lag}``, ``rolling_{n}d_stddev`` and
    ``rolling_{n}d_mean`` in one window pass (one shuffle, one sort)."""
    n = cfg.window_size
    cols = df.columns
    frame_lo, frame_hi = (-(n - 1), 0) if cfg.include_current else (-n, -1)
    lookback = max(cfg.lag if lag else 0, -frame_lo if rolling else 0)
    blocked = series_blocks(
        df, SERIES_KEYS, ["Date", *TIE_BREAK], lookback, cfg.block_rows, cfg.broadcast_max_bytes
    )
    w = Window.partitionBy(*SERIES_KEYS, "_blk").orderBy("Date", *TIE_BREAK, "_pos")
    frame = w.rowsBetween(frame_lo, frame_hi)
    x = F.col("Order_Demand")
    new = {}
    if lag:
        new[f"demand_T_minus_{cfg.lag}"] = F.lag(x, cfg.lag).over(w)
    if rolling:
        new[f"rolling_{n}d_stddev"] = F.stddev_samp(x).over(frame)
        new[f"rolling_{n}d_mean"] = F.avg(x).over(frame)
    return blocked.withColumns(new).filter(~F.col("_halo")).select(*cols, *new.keys())


def add_lag_features(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    return add_lag_rolling(df, cfg, lag=True, rolling=False)


def add_rolling_features(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    return add_lag_rolling(df, cfg, lag=False, rolling=True)


def add_binary_indicators(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"is_q4": is_q4(F.col("month")), "is_monday": is_monday(F.col("day_of_week"))}
    )


def handle_feature_nulls(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    made = {f"demand_T_minus_{cfg.lag}", *(f"rolling_{cfg.window_size}d_{s}" for s in ("stddev", "mean"))}
    cols = [c for c in df.columns if c in made]
    return df.fillna(0, subset=cols) if cols else df


def engineer_features(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    df = add_lag_rolling(df, cfg)
    df = add_binary_indicators(df)
    return handle_feature_nulls(df, cfg)
