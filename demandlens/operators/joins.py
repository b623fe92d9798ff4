"""Attaching small per-key statistics to fact rows.

Every join of the workload is "facts LEFT JOIN per-key statistic". The
statistic is an aggregate, so its size is data dependent (warehouses,
products, series-days). It is written to the shared folder first, so its size
is known before the join is planned: up to a bound of bytes it is broadcast
and the facts are not shuffled; beyond, both sides are shuffled from files
and adaptive execution splits a hot key of the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.session import shared_dir

#: Bytes of a statistic up to which it is broadcast.
BROADCAST_BYTES = 64 << 20


def measured_bytes(table: DataFrame) -> int:
    """Upper estimate of a table's size in memory: its text and 16 bytes for
    every value."""
    text = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in table.dtypes if t == "string"]
    row = sum(text, F.lit(16 * len(table.columns) + 16))
    return table.agg(F.sum(row)).first()[0] or 0


def attach_stats(
    facts: DataFrame,
    stats: DataFrame,
    on: Sequence[str],
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``facts LEFT JOIN stats USING (on)``, the statistic computed once."""
    shared_dir(facts.sparkSession)
    stats = stats.checkpoint()
    if measured_bytes(stats) <= max_broadcast_bytes:
        stats = F.broadcast(stats)
    return facts.join(stats, on=list(on), how="left")
