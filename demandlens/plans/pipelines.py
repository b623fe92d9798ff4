"""Composite user entry points: the full cleaning pipeline and the full
feature pipeline, each a plain ``DataFrame -> DataFrame`` function."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlens.config import KEY_COLUMNS, RAW_COLUMNS, CleanConfig, FeatureConfig
from demandlens.functions.parsing import (
    demand_to_long,
    failed_parse,
    multi_format_date,
    normalise_key,
)
from demandlens.operators import clean as C
from demandlens.operators import quality as Q


_RAW = [f"_raw_{c}" for c in RAW_COLUMNS]


def parse_rows(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Every row parsed ONCE, next to its original strings (``_raw_*``):
    normalised keys, demand, date, the two failure flags and the anomaly
    flags. Parsing is a deterministic function of the raw strings, so
    duplicates of a raw row parse identically."""
    df = C.normalise_column_names(df)
    C.validate_schema(df)
    values = df.select(
        *[F.col(c).alias(r) for c, r in zip(RAW_COLUMNS, _RAW)],
        *[normalise_key(F.col(c)).alias(c) for c in KEY_COLUMNS],
        demand_to_long(F.col("Order_Demand")).alias("Order_Demand"),
        multi_format_date(F.col("Date"), cfg.date_formats, cfg.lenient_dates).alias("Date"),
    )
    return values.select(*_RAW, *KEY_COLUMNS, "Order_Demand", "Date", *_flags())


def _flags() -> list[Column]:
    d = F.col("Order_Demand")
    return [
        failed_parse(F.col("Date"), F.col("_raw_Date")).alias("date_parse_failed"),
        failed_parse(d, F.col("_raw_Order_Demand")).alias("demand_cast_failed"),
        (d < 0).alias("is_negative_demand"),
        (d == 0).alias("is_zero_demand"),
    ]


def dedupe_raw(rows: DataFrame) -> DataFrame:
    """Exact-duplicate removal on the ORIGINAL strings (before
    normalisation, so rows equal only after trim/upper both survive).

    The shuffle carries the five raw strings and the two parsed values that
    are costly to make again; both are functions of the raw strings, so the
    grouping equals one on the raw strings and stays a hash aggregate with
    map-side combine. Normalised keys and flags are derived afterwards."""
    distinct = rows.select(*_RAW, "Order_Demand", "Date").dropDuplicates()
    keys = [normalise_key(F.col(f"_raw_{c}")).alias(c) for c in KEY_COLUMNS]
    return distinct.select(*keys, "Order_Demand", "Date", *_flags())


def parse_stage(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Names, schema check, dedupe, keys, date and demand parsing, anomaly
    flags. Rows are not removed yet."""
    return dedupe_raw(parse_rows(df, cfg))


def _keep(df: DataFrame) -> DataFrame:
    return C.drop_null_keys(C.drop_negative_demand(df))


def clean_stages(
    df: DataFrame, cfg: CleanConfig = CleanConfig(), flags: bool = True
) -> dict[str, DataFrame]:
    """The cleaning pipeline with its intermediate frames: ``base`` (parsed,
    filtered, deduplicated), ``flagged`` (with every flag) and ``cleaned``
    (the output). The statistics behind the flags are computed here, so with
    ``checkpoint_base`` rows are cleaned once for them and for the output."""
    rows = parse_rows(df, cfg)
    if cfg.impute_before_filter:
        # null strategies see NULL demand; the median needs deduped rows
        base = C.handle_nulls(
            dedupe_raw(rows),
            cfg.null_demand_strategy,
            accuracy=cfg.quantile_accuracy,
            broadcast_max_bytes=cfg.broadcast_max_bytes,
        )
        base = C.drop_negative_demand(base)
    else:
        if cfg.null_demand_strategy not in ("drop", "zero", "median"):
            raise ValueError(f"no such strategy for null demand: {cfg.null_demand_strategy!r}")
        # after the >= 0 filter no NULL demand is left: every strategy is a no-op
        base = dedupe_raw(_keep(rows))
    if cfg.checkpoint_base:
        # written once to the shared folder; the statistics and the facts
        # below then read it instead of recomputing dedupe and parsing
        base = base.checkpoint(eager=True)
    if cfg.outlier_strategy not in ("iqr", "zscore"):
        raise ValueError(f"Unknown outlier strategy '{cfg.outlier_strategy}'.")
    flagged = base
    if flags:
        # product counts come from the base, not from the flagged rows, so
        # no statistic runs on top of another join
        flagged = Q.flag_outliers(flagged, cfg)
        flagged = Q.flag_sparse_products(
            flagged, cfg.min_records_per_product, cfg.broadcast_max_bytes, counted=base
        )
    flagged = C.add_temporal_columns(flagged)
    # reference column order: keys first (the statistic joins move them)
    lead = ["Product_Code", "Warehouse", "Product_Category", "Order_Demand", "Date"]
    flagged = flagged.select(*lead, *[c for c in flagged.columns if c not in lead])
    cleaned = flagged if cfg.keep_flags else C.drop_flag_columns(flagged)
    return {"base": base, "flagged": flagged, "cleaned": cleaned}


def clean(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Raw all-string rows -> typed, annotated demand rows. Runs a Spark
    action only where flags are kept (their statistics).

    Reference order: dedupe, parse, drop ``Order_Demand < 0`` and NULL
    demand, drop NULL keys/dates, null strategy (nothing left to fill),
    outliers, sparse products, calendar. Row filters commute with the
    dedupe (duplicates parse alike), so they run before its shuffle."""
    return clean_stages(df, cfg, flags=cfg.keep_flags)["cleaned"]


def engineer_features(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    from demandlens.operators.features import engineer_features as _ef

    return _ef(df, cfg)


def build_temporal_features(df: DataFrame) -> DataFrame:
    return engineer_features(df, FeatureConfig())
