"""Shared helpers of the training-data operators.

Conventions of every operator in this subpackage:

* only the columns named by its parameters are read, under internal names,
  so extra columns of any name cannot clash;
* a null text counts as the empty text, a null id stays a row of its own;
* repeated rows stay repeated rows, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that one Arrow batch hands to a Python worker (a longer row is a batch
#: of its own): texts, parts and tiles can be long.
ARROW_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null texts as empty ones."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def arrow_map(
    df: DataFrame,
    fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``mapInArrow`` with batches bounded by bytes."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return df.mapInArrow(fn, schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_buckets(df: DataFrame, key: str, buckets: int, out: str = "bucket") -> DataFrame:
    """Adds an int column that grows with ``key``: equal keys share a bucket,
    buckets hold about equally many rows. The cuts come from one quantile
    sketch of the key column. Null keys go to bucket 0, before all others."""
    probs = [i / buckets for i in range(1, buckets)]
    cuts = df.approxQuantile(key, probs, 0.25 / buckets) if probs else []
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) < 3:
        return df.withColumn(out, F.lit(0))
    cut = Bucketizer(splits=splits, inputCol="__key", outputCol="__bucket", handleInvalid="keep")
    marked = cut.transform(df.withColumn("__key", F.col(key).cast("double")))
    return marked.withColumn(
        out, F.when(F.col(key).isNull(), 0).otherwise(F.col("__bucket").cast("int"))
    ).drop("__key", "__bucket")
