"""Incremental form of the cleaning job for a landing folder that keeps
receiving raw CSV files.

Structured Streaming file source -> exact-duplicate removal on the raw
strings across ALL batches (streaming deduplication; its keys live in the
state store, checkpointed, so a restart or a lost executor resumes without
re-emitting rows) -> row-level parsing and filters -> append to the
Warehouse-partitioned table. Outlier and sparse-product flags depend on
whole-table statistics and stay in the batch query over the landed table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from demandlens.config import RAW_COLUMNS, CleanConfig
from demandlens.operators import clean as C
from demandlens.plans.pipelines import parse_rows
from demandlens.session import scratch_path
from demandlens.sources.readers import RAW_SCHEMA

_RAW = [f"_raw_{c}" for c in RAW_COLUMNS]


def cleaned_stream(
    spark: SparkSession, landing_uri: str, cfg: CleanConfig = CleanConfig(), max_files: int = 64
) -> DataFrame:
    raw = (
        spark.readStream.schema(RAW_SCHEMA)
        .option("header", "true")
        # a file whose header names other columns, or in another order, fails
        # the batch instead of being read by position
        .option("enforceSchema", "false")
        .option("quote", '"')
        .option("escape", '"')
        .option("maxFilesPerTrigger", max_files)
        .csv(landing_uri)
    )
    rows = raw.dropDuplicates(list(RAW_COLUMNS))
    parsed = parse_rows(rows, cfg).drop(*_RAW)
    kept = C.drop_null_keys(C.drop_negative_demand(parsed))
    return C.drop_flag_columns(C.add_temporal_columns(kept))


def start_ingest(
    spark: SparkSession,
    landing_uri: str,
    output_uri: str,
    checkpoint_uri: str | None = None,
    cfg: CleanConfig = CleanConfig(),
    available_now: bool = False,
) -> StreamingQuery:
    """Start the ingest; ``available_now=True`` processes what is there and
    stops (scheduled incremental runs)."""
    checkpoint_uri = checkpoint_uri or scratch_path(spark, "ingest-checkpoint")
    writer = (
        cleaned_stream(spark, landing_uri, cfg)
        .writeStream.format(cfg.output_format)
        .option("checkpointLocation", checkpoint_uri)
        .partitionBy("Warehouse")
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(output_uri)
