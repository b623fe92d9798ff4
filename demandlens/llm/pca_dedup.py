"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors of one label are scaled to length one and rotated to the principal
axes of all vectors, so that leading dimensions carry most of every product.
Each label is cut into tiles of at most ``TILE`` vectors by their leading
coordinate. Two unit vectors whose cosine reaches the threshold are at most
sqrt(2 - 2 threshold) apart in every coordinate, so only tiles whose ranges
come that close are compared. Within a pair of tiles the products of the
leading dimensions are accumulated block by block; what is missing of a
product is at most the product of the suffix norms, so a pair is dropped as
soon as even that cannot reach the threshold. The few pairs left are decided
by the cosine of the original vectors in double precision.

Equal vectors of a label are one node with a count, so copies are never paired.
A pair of tiles returns one row per vector with links: how many, and the
smallest vector it is connected to among the two tiles. Dense groups thus cost
rows in proportion to vectors, not to links.

Results for odd input: vectors that are null, zero or hold null or non-finite
components, and rows with a null label, link with nothing; rows with a null
id count as links of others but have no component of their own (null).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.llm.common import arrow_map
from demandlens.llm.components import components
from demandlens.session import scratch_path

#: Vectors of a tile, and dimensions added at a time.
TILE, BLOCK = 512, 8
#: Slack of the bounds against rounding.
SLACK = 1e-9


def principal_axes(vectors: DataFrame, size: int) -> np.ndarray:
    """(size, size) orthogonal axes, largest variance first, from the second
    moments of all unit vectors, added up on the executors."""

    def run(batches):
        total = np.zeros((size, size))
        for batch in batches:
            x = _matrix(batch.column("v"), size)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            total += x.T @ x
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(np.repeat(np.arange(size), size), pa.int32()),
            "j": pa.array(np.tile(np.arange(size), size), pa.int32()),
            "s": pa.array(total.ravel(), pa.float64()),
        })

    sums = arrow_map(vectors.select("v"), run, "i int, j int, s double")
    sums = sums.groupBy("i", "j").agg(F.sum("s").alias("s"))
    moments = np.zeros((size, size))
    for i, j, s in sums.collect():  # size x size numbers
        moments[i, j] = s
    values, axes = np.linalg.eigh(moments)
    return axes[:, np.argsort(-values)]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.ListArray) else column.combine_chunks().flatten()
    return np.array(flat, np.float64).reshape(-1, size)


def near_pairs(a: np.ndarray, b: np.ndarray, threshold: float, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (into a, into b) of rotated unit vectors whose cosine may
    reach the threshold: leading dimensions first, the rest bounded by the
    suffix norms."""
    size = a.shape[1]
    i = j = None
    dots: np.ndarray = np.zeros(0)
    for at in range(0, size, block):
        span = slice(at, at + block)
        rest_a = np.sqrt((a[:, at + block :] ** 2).sum(1))
        rest_b = np.sqrt((b[:, at + block :] ** 2).sum(1))
        if i is None:
            products = a[:, span] @ b[:, span].T
            i, j = np.nonzero(products + np.outer(rest_a, rest_b) >= threshold - SLACK)
            dots = products[i, j]
        else:
            dots = dots + np.einsum("nd,nd->n", a[i, span], b[j, span])
            keep = dots + rest_a[i] * rest_b[j] >= threshold - SLACK
            i, j, dots = i[keep], j[keep], dots[keep]
        if not len(i):
            break
    return i, j


def _usable(column: str):
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col("label").isNotNull() & finite & F.exists(column, lambda x: x != 0)


def tile_links(ids, vectors, copies, axes, threshold: float, same: bool):
    """(node, links, root) of the vectors of two tiles that have links between
    them; ``same``: both are one tile."""
    (na, nb), (a, b), (ca, cb) = ids, vectors, copies
    la, lb = (np.sqrt((x * x).sum(1)) for x in (a, b))
    i, j = near_pairs(a / la[:, None] @ axes, b / lb[:, None] @ axes, threshold)
    if same:
        i, j = i[i != j], j[i != j]
    hit = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 14):  # bounded memory
        p, q = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
        hit[at : at + (1 << 14)] = (a[p] * b[q]).sum(1) / (la[p] * lb[q]) >= threshold
    i, j = i[hit], j[hit]
    if same:
        nodes, counts = na, np.bincount(i, cb[j], len(na))
    else:
        nodes = np.concatenate([na, nb])
        counts = np.concatenate([np.bincount(i, cb[j], len(na)), np.bincount(j, ca[i], len(nb))])
        j = j + len(na)
    roots = nodes.copy()
    while True:
        lower = roots.copy()
        np.minimum.at(lower, i, roots[j])
        np.minimum.at(lower, j, roots[i])
        if (lower == roots).all():
            break
        roots = lower
    some = counts > 0
    return nodes[some], counts[some].astype(np.int64), roots[some]


def links(nodes: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root) rows of nodes (node, label, v, copies) whose cosine
    with others of their label reaches the threshold. The links of a node add
    up over its rows; (node, root) connect what is linked. Vectors of
    different lengths link with nothing."""
    spark = nodes.sparkSession
    path = scratch_path(spark, "tiles")
    sizes = sorted(r[0] for r in nodes.select(F.size("v")).distinct().collect())
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    out = spark.createDataFrame([], "node long, links long, root long")
    for size in sizes:
        own = nodes.filter(F.size("v") == size)
        axes = spark.sparkContext.broadcast(principal_axes(own, size))  # size x size

        def rotate(batches, size=size, axes=axes):
            for batch in batches:
                x = _matrix(batch.column("v"), size)
                lead = x / np.linalg.norm(x, axis=1, keepdims=True) @ axes.value[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(lead)], [*batch.schema.names, "lead"]
                )

        led = arrow_map(
            own.select("node", "label", "copies", "v"),
            rotate,
            "node long, label string, copies long, v array<double>, lead double",
        )
        led = led.withColumn("cell", F.floor(F.col("lead") / reach).cast("long")).drop("lead")
        here = f"{path}-{size}"
        led.write.parquet(f"{here}-cells")
        led = spark.read.parquet(f"{here}-cells")
        parts = led.groupBy("label", "cell").agg(F.ceil(F.count("*") / TILE).alias("parts"))
        led.join(parts, ["label", "cell"]).withColumn(
            "part", F.pmod(F.xxhash64("node"), F.col("parts"))
        ).groupBy("label", "cell", "part").agg(
            *[F.collect_list(c).alias(c) for c in ("node", "copies", "v")]
        ).write.parquet(f"{here}-tiles")
        tiles = spark.read.parquet(f"{here}-tiles")
        names = ["label", "cell", "part"]
        # a cell's tiles meet each other and those of the next cell
        other = tiles.select("label", F.col("cell").alias("cell2"), F.col("part").alias("part2")).withColumn(
            "cell", F.explode(F.array(F.col("cell2"), F.col("cell2") - 1))
        )
        close = tiles.select(*names).join(other, ["label", "cell"]).filter(
            (F.col("cell2") > F.col("cell")) | (F.col("part2") >= F.col("part"))
        )
        left = tiles.toDF(*names, "na", "ca", "va")
        right = tiles.toDF("label", "cell2", "part2", "nb", "cb", "vb")
        same = (F.col("cell") == F.col("cell2")) & (F.col("part") == F.col("part2"))
        pairs = close.join(left, names).join(right, ["label", "cell2", "part2"])
        pairs = pairs.select(same.alias("same"), "na", "nb", "ca", "cb", "va", "vb")

        def compare(batches, size=size, axes=axes):
            for batch in batches:
                for row in range(batch.num_rows):
                    same, *got = (batch.column(c)[row] for c in ("same", "na", "nb", "ca", "cb", "va", "vb"))
                    na, nb, ca, cb = (x.values.to_numpy() for x in got[:4])
                    vectors = [_matrix(x.values, size) for x in got[4:]]
                    found = tile_links((na, nb), vectors, (ca, cb), axes.value, threshold, same.as_py())
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["node", "links", "root"])

        here = f"{here}-links"
        arrow_map(pairs, compare, "node long, links long, root long").write.parquet(here)
        out = out.union(spark.read.parquet(here))
    return out


def near_duplicates(
    embeddings: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie above 0 and at most at 1")
    spark = embeddings.sparkSession
    root = scratch_path(spark, "vectors")
    rows = embeddings.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("v"),
    )
    good = rows.filter(F.coalesce(_usable("v"), F.lit(False)))
    grouped = good.groupBy("label", "v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    grouped.withColumn("node", F.monotonically_increasing_id()).write.parquet(f"{root}/nodes")
    nodes = spark.read.parquet(f"{root}/nodes")
    found = links(nodes, threshold)
    slim = nodes.select("node", "copies", "least")
    others = found.groupBy("node").agg(F.sum("links").alias("others"))
    labels = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    joined = (
        slim.join(others, "node", "left")
        .join(labels, "node", "left")
        .select(
            "node", F.coalesce("label", "node").alias("label"), "least",
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        )
        .checkpoint()
    )
    least = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    by_node = joined.join(least, "label").select("node", "n_links", "component_id")
    result = nodes.select("node", F.col("label").alias("own_label"), F.col("v").alias("own_v")).join(by_node, "node")
    result = result.drop("node").checkpoint()
    usable = F.coalesce(_usable("v"), F.lit(False))
    named = rows.withColumn("key", F.when(usable, F.xxhash64("label", "v"))).join(
        result.withColumn("own_key", F.xxhash64("own_label", "own_v")),
        (F.col("key") == F.col("own_key")) & (F.col("label") == F.col("own_label")) & (F.col("v") == F.col("own_v")),
        "left",
    )
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return named.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
