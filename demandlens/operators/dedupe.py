"""Exact duplicate removal that shuffles few rows.

A hash aggregate over all columns sends every row through a shuffle, although
few rows of a raw table repeat. In two phases only 64-bit fingerprints are
shuffled first (with map-side counts); rows whose fingerprint occurs once are
unique for certain and stay where they are, the others, which may repeat, are
compared in full. Two different rows of one fingerprint are just compared, so
the result does not depend on the fingerprints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.operators.joins import BROADCAST_BYTES
from demandlens.session import shared_dir

#: Bytes of a repeated fingerprint in memory.
PRINT_BYTES = 16


def drop_duplicates_in_two_phases(df: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The distinct rows of ``df``, which is read twice. Where so many rows
    repeat that their fingerprints take more than the bound, all rows are
    shuffled once instead."""
    shared_dir(df.sparkSession)
    marked = df.withColumn("_print", F.xxhash64(*df.columns))
    counted = marked.groupBy("_print").count()
    repeated = counted.filter(F.col("count") > 1).select("_print").checkpoint()
    n = repeated.count()
    if not n:
        return df
    if n * PRINT_BYTES > max_broadcast_bytes:
        return df.dropDuplicates()
    few = F.broadcast(repeated)
    unique = marked.join(few, "_print", "left_anti").select(*df.columns)
    candidates = marked.join(few, "_print", "left_semi").select(*df.columns)
    return unique.unionByName(candidates.dropDuplicates())
