"""Job parameters as plain dataclasses (no YAML parsing)."""

from __future__ import annotations

from dataclasses import dataclass

# The five raw columns, the key columns and the default date
# patterns (one-or-two digit month/day, tried in this order).
RAW_COLUMNS = ("Product_Code", "Warehouse", "Product_Category", "Date", "Order_Demand")
KEY_COLUMNS = ("Product_Code", "Warehouse", "Product_Category")
DEFAULT_DATE_FORMATS = ("yyyy/M/d", "M/d/yyyy", "yyyy-M-d")

# Flag columns produced by cleaning and dropped at its end.
FLAG_COLUMNS = (
    "date_parse_failed",
    "demand_cast_failed",
    "is_negative_demand",
    "is_zero_demand",
    "is_outlier",
    "is_sparse_product",
    "year_month",
)

# Model inputs in the order the scorer expects them.
FEATURE_COLUMNS = (
    "year",
    "month",
    "day_of_week",
    "week_of_year",
    "demand_T_minus_2",
    "rolling_7d_stddev",
    "rolling_7d_mean",
    "is_q4",
    "is_monday",
)

# Identifiers that never enter a model.
META_COLUMNS = ("Product_Code", "Product_Category", "Warehouse", "Date")

# Contenders of the forecasting tournament, in run order, named for what runs.
DEFAULT_MODELS = (
    "Ridge on log demand",
    "Trend and seasonality",
    "Random forest",
    "Boosted trees by level",
    "Boosted trees, best leaf first",
)


@dataclass(frozen=True)
class CleanConfig:
    date_formats: tuple[str, ...] = DEFAULT_DATE_FORMATS
    lenient_dates: bool = True
    null_demand_strategy: str = "drop"  # drop | zero | median
    impute_before_filter: bool = False
    outlier_strategy: str = "iqr"  # iqr | zscore
    iqr_multiplier: float = 3.0
    zscore_threshold: float = 4.0
    min_records_per_product: int = 10
    quantile_accuracy: int = 10000
    keep_flags: bool = False
    # Statistics (per warehouse / per product) are written, measured and
    # broadcast when they take at most so many bytes.
    broadcast_max_bytes: int = 64 << 20
    # Materialise the parsed base in the shared checkpoint folder before
    # the statistics are computed from it (jobs; avoids recomputation).
    checkpoint_base: bool = False
    output_format: str = "parquet"


@dataclass(frozen=True)
class FeatureConfig:
    window_size: int = 7
    lag: int = 2
    include_current: bool = True
    # Rows per window block: a series longer than this is split into blocks
    # with a halo of preceding rows so no task holds a whole hot series.
    block_rows: int = 2_000_000
    broadcast_max_bytes: int = 64 << 20
    category_first: bool = False


@dataclass(frozen=True)
class TrainConfig:
    test_year: int
    target_warehouse: str = "WHSE_S"
    target_category: str = "CATEGORY_019"
    high_demand_threshold: float = 10000.0
    models: tuple[str, ...] = DEFAULT_MODELS
    num_trees: int = 200
    boost_iters: int = 500
    seed: int = 42
    # One model per group of these columns (run_group_tournament) instead of
    # one slice; empty: the slice.
    group_cols: tuple[str, ...] = ()
    model_dir: str | None = None
    report_dir: str | None = None
