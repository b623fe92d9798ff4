"""The corpus pipeline: stages of training-data operators over documents.

Each stage gets what its predecessor kept, works on all of it and is written
as Parquet in the shared folder before the next one reads it:

1. language identification: documents without any letter (no language) go;
   the others carry the language found;
2. SimHash near-duplicates: of each group one row stays, the one with the
   smallest id (rows without an id come last; of rows that share the smallest
   id, texts and all, any one). Every row is a document of its own, so rows
   that repeat an id in different groups all stay, one for each group;
3. personal data: spans are replaced by the name of their kind;
4. best-fit packing: one row per piece of at most 1024 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm import golay, langid, packing, pii
from demandlens.session import scratch_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents; keeps those with a language."""
    columns = docs.columns
    typed = docs.withColumn("lang", F.col("lang").cast("string"))
    found = langid.predict(typed, langid.train(typed), columns, ("__language", "__score"))
    kept = found.filter(F.col("__language") != langid.UNKNOWN)
    return kept.withColumn("lang", F.col("__language")).select(*columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked fingerprints."""
    row = "__row"
    while row in docs.columns:
        row += "_"
    # rows are numbered once, in a written table: the numbers must not change
    path = scratch_path(spark, "numbered")
    docs.withColumn(row, F.monotonically_increasing_id()).write.parquet(path)
    numbered = spark.read.parquet(path)
    path = scratch_path(spark, "groups")
    golay.near_duplicates(numbered, id_col=row).select(
        F.col("doc_id").alias(row), F.col("component_id").alias("component")
    ).write.parquet(path)
    first = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", row)
    kept = (
        spark.read.parquet(path)
        .join(numbered.select(F.col("doc_id").cast("long"), row), row)
        .groupBy("component")
        .agg(F.min(first).alias("first"))
        .select(F.col("first")[row].alias(row))
    )
    return numbered.join(kept, row, "left_semi").select(*docs.columns)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts and sets their sizes anew."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("pii", personal_data_stage),
    ("best_fit_packing", packing_stage),
]

#: Learned stages have no SQL; tests/llm hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; the pieces of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
