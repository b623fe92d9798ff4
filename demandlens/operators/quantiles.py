"""Exact quantiles of many groups without a list of a group's values.

A quantile is the value at a rank of its group. Each pass brackets that rank
between two values of the group's quantile sketch, counts exactly how many
rows lie below, at and between them, and goes on with the rows strictly
between the two only: a few hundredths of the rows, or none where the rank
falls on one of the two values (many equal values). As soon as no more than
``small`` rows of a group are left for a rank, they are numbered in order.

What a task holds is a sketch, some counts, or ``small`` rows, whatever the
size of the group. Nulls are left out; a group without any other value has no
row. A NaN counts as the largest value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlens.operators.joins import BROADCAST_BYTES, attach_stats
from demandlens.session import shared_dir

#: Brackets of a sketch, and its accuracy (error in ranks: rows / accuracy).
GRID, ACCURACY = 256, 10_000
#: Rows that are numbered in one task.
SMALL = 100_000


def _grid_at(values: Column, rank: Column, n: Column, grid: int, accuracy: int, up: bool) -> Column:
    """The sketched value that is surely not above (or not below) the rank."""
    share = rank.cast("double") / n * grid
    slack = 1.0 + grid / accuracy
    at = F.ceil(share + slack) if up else F.floor(share - slack)
    return F.element_at(values, F.least(F.greatest(at, F.lit(0)), F.lit(grid)).cast("int") + 1)


def _bracket(
    rows: DataFrame, keys: list[str], grid: int, accuracy: int, max_bytes: int
) -> tuple[DataFrame, DataFrame]:
    """One pass over (keys, x, rank): (found, open). ``found`` are (keys,
    value); ``open`` are (keys, low, high, rank, left): the rank among the rows
    strictly between low and high."""
    ranks = [k / grid for k in range(grid + 1)]
    sketch = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.first("rank").alias("rank"),
        F.percentile_approx("x", ranks, accuracy).alias("values"),
    )
    rank, n = F.col("rank"), F.col("n")
    brackets = sketch.select(
        *keys,
        "rank",
        _grid_at(F.col("values"), rank, n, grid, accuracy, up=False).alias("low"),
        _grid_at(F.col("values"), rank, n, grid, accuracy, up=True).alias("high"),
    )
    x, low, high = F.col("x"), F.col("low"), F.col("high")
    counted = (
        attach_stats(rows.drop("rank"), brackets, keys, max_bytes)
        .groupBy(*keys)
        .agg(
            F.first("rank").alias("rank"),
            F.first("low").alias("low"),
            F.first("high").alias("high"),
            F.count_if(x < low).alias("below"),
            F.count_if(x == low).alias("at_low"),
            F.count_if((x > low) & (x < high)).alias("between"),
            F.count_if((x == high) & (high > low)).alias("at_high"),
        )
        .checkpoint()
    )
    inner = rank - F.col("below") - F.col("at_low")
    # the sketch's error bound puts the rank into the bracket
    value = F.when(inner < 0, low).when(inner >= F.col("between"), high)
    sound = F.when(
        (rank < F.col("below")) | (inner >= F.col("between") + F.col("at_high")),
        F.raise_error(F.lit("a quantile sketch missed its error bound")),
    ).otherwise(value)
    told = counted.withColumn("value", sound)
    found = told.filter(F.col("value").isNotNull()).select(*keys, "value")
    rest = told.filter(F.col("value").isNull())
    return found, rest.select(*keys, "low", "high", inner.alias("rank"), F.col("between").alias("left"))


def at_ranks(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    ranks: dict[str, Column],
    small: int = SMALL,
    grid: int = GRID,
    accuracy: int = ACCURACY,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(keys, n, <names>): per group the number of values and the value at each
    rank (from 0) that ``ranks`` gives as an expression over ``n``."""
    if not keys:
        raise ValueError("quantiles are taken per group: name at least one key")
    shared_dir(df.sparkSession)
    names, by = list(ranks), [*[f"__k{i}" for i in range(len(keys))], "__rank"]
    # null keys are a group like any other: joins on the keys need a stand-in
    marks = [F.to_json(F.struct(F.col(k).alias("k"))) for k in keys]
    rows = df.select(
        *[m.alias(b) for m, b in zip(marks, by)], *keys, value.alias("x")
    ).filter(F.col("x").isNotNull())
    sizes = rows.groupBy(*by[:-1]).agg(
        F.count(F.lit(1)).alias("n"), *[F.first(k).alias(k) for k in keys]
    ).checkpoint()
    wanted = sizes.select(
        *by[:-1],
        F.posexplode(F.array(*[ranks[c].cast("long") for c in names])).alias("__rank", "rank"),
    )
    # each row once per rank: the first pass leaves a few hundredths of them
    current = attach_stats(rows.drop(*keys), wanted, by[:-1], max_bytes)
    results = None
    while True:
        found, rest = _bracket(current, by, grid, accuracy, max_bytes)
        rest = rest.checkpoint()
        results = found if results is None else results.unionByName(found)
        if rest.isEmpty():
            break
        inside = attach_stats(current.drop("rank"), rest, by, max_bytes)
        inside = inside.filter((F.col("x") > F.col("low")) & (F.col("x") < F.col("high")))
        inside = inside.select(*by, "x", "rank", "left").checkpoint()
        order = F.row_number().over(Window.partitionBy(*by).orderBy("x"))
        last = inside.filter(F.col("left") <= small).withColumn("row", order)
        last = last.filter(F.col("row") == F.col("rank") + 1)
        results = results.unionByName(last.select(*by, F.col("x").alias("value")))
        current = inside.filter(F.col("left") > small).drop("left")
        if current.isEmpty():
            break
    per_group = results.groupBy(*by[:-1]).agg(
        *[F.max(F.when(F.col("__rank") == i, F.col("value"))).alias(c) for i, c in enumerate(names)]
    )
    return sizes.join(per_group, by[:-1]).select(*keys, "n", *names)


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: Column, probabilities: dict[str, float], interpolate: bool = False, **how
) -> DataFrame:
    """(keys, n, <names>) at the given probabilities. Discrete quantiles are
    the smallest value with that share of the values at or below; with
    ``interpolate`` they lie between two neighbours in order, as doubles."""
    n = F.col("n")
    if not interpolate:
        ranks = {c: F.greatest(F.ceil(n * p) - 1, F.lit(0)) for c, p in probabilities.items()}
        return at_ranks(df, keys, value, ranks, **how)
    ranks = {}
    for c, p in probabilities.items():
        ranks[f"__low_{c}"] = F.floor((n - 1) * p)
        ranks[f"__high_{c}"] = F.ceil((n - 1) * p)
    got = at_ranks(df, keys, value, ranks, **how)
    out = []
    for c, p in probabilities.items():
        low, high = F.col(f"__low_{c}").cast("double"), F.col(f"__high_{c}").cast("double")
        share = (n - 1) * p - F.floor((n - 1) * p)
        out.append((low * (1 - share) + high * share).alias(c))
    return got.select(*keys, "n", *out)
