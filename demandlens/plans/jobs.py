"""End-to-end jobs: raw -> cleaned table, and cleaned table -> tournament,
leaderboard, saved models, registry entry."""

from __future__ import annotations

import time
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from demandlens.config import CleanConfig, FeatureConfig, TrainConfig
from demandlens.operators import forecast as FC
from demandlens.operators import registry as RG
from demandlens.operators.features import engineer_features
from demandlens.plans.pipelines import clean
from demandlens.session import shared_dir
from demandlens.sources.readers import read_cleaned, read_raw
from demandlens.sources.sinks import write_cleaned, write_leaderboard


def clean_job(
    spark: SparkSession,
    raw_uri: str,
    output_uri: str,
    cfg: CleanConfig = CleanConfig(),
    header: bool = True,
) -> dict:
    """Read the raw CSV (explicit all-string schema), clean, write the
    Warehouse-partitioned table. Row count and date range are observed
    during the write itself (no extra pass)."""
    shared_dir(spark)
    t0 = time.time()
    if cfg.keep_flags:
        # flags need the statistics: materialise the base once in the shared
        # folder; each statistic is then a cheap aggregate over that table,
        # counted and broadcast before the facts are read again, so no fact
        # shuffle is planned for the statistic joins
        cfg = replace(
            cfg,
            checkpoint_base=True,
        )
    cleaned = clean(read_raw(spark, raw_uri, header=header), cfg)
    obs = Observation("clean_job")
    observed = cleaned.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.min("Date").alias("min_date"),
        F.max("Date").alias("max_date"),
    )
    write_cleaned(observed, output_uri, cfg.output_format)
    metrics = dict(obs.get)
    metrics.update(output=output_uri, seconds=round(time.time() - t0, 2))
    return metrics


def train_job(
    spark: SparkSession,
    cleaned_uri: str,
    cfg: TrainConfig,
    features: FeatureConfig = FeatureConfig(),
    registry_name: str = "demand_forecaster",
    fmt: str = "parquet",
) -> dict:
    """Load the cleaned table, build features, run the tournament on the
    configured slice, write the leaderboard (JSON), persist every model
    (winner suffixed ``_best``) and register the winner as Production. With
    ``cfg.group_cols`` every group gets models of its own instead
    (``train_groups``)."""
    base = shared_dir(spark).rstrip("/")
    model_dir = cfg.model_dir or f"{base}/models"
    report_dir = cfg.report_dir or f"{base}/reports"
    t0 = time.time()
    cleaned = read_cleaned(spark, cleaned_uri, fmt)
    if cfg.group_cols:
        result = train_groups(engineer_features(cleaned, features), cfg, model_dir, report_dir)
        return result | {"seconds": round(time.time() - t0, 2)}
    if features.category_first:
        # filter the slice before the windows (prunes Warehouse directories
        # and shrinks the window input); valid only when every product has
        # one category, otherwise lag values change
        cleaned = FC.whale_slice(cleaned, cfg.target_warehouse, cfg.target_category)
    featured = engineer_features(cleaned, features)
    split_obs = Observation("training_slice")
    board, models, _ = FC.run_tournament(featured, cfg, split_obs)
    board = board.persist()
    rows = board.orderBy("rank").collect()  # one row per contender
    winner = rows[0]["model"]
    write_leaderboard(board, f"{report_dir}/leaderboard")
    paths = RG.save_models(models, winner, model_dir)
    RG.register(spark, f"{model_dir}/registry", registry_name, board, paths)
    board.unpersist()
    return {
        "winner": winner,
        "slice": dict(split_obs.get),
        "leaderboard": [r.asDict() for r in rows],
        "model_dir": model_dir,
        "seconds": round(time.time() - t0, 2),
    }


def train_groups(featured: DataFrame, cfg: TrainConfig, model_dir: str, report_dir: str) -> dict:
    """A model per group and contender, as one Parquet table per contender in a
    folder of this run, and the leaderboard of all groups as Parquet."""
    spark = featured.sparkSession
    run = uuid.uuid4().hex[:12]
    board, models, _ = FC.run_group_tournament(featured, cfg, cfg.models)
    paths = {}
    for name, table in models.items():
        paths[name] = f"{model_dir.rstrip('/')}/{run}/groups/{RG.slug(name)}"
        table.write.parquet(paths[name])
    report = f"{report_dir.rstrip('/')}/group-leaderboard-{run}"
    board.write.parquet(report)
    written = spark.read.parquet(report)
    groups = written.select(*cfg.group_cols).distinct().count()
    return {"groups": groups, "leaderboard": report, "models": paths}
