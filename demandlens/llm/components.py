"""Connected components of a link table, by minimum labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the undirected links (a, b) with long
    columns; label is the smallest node that is reachable.

    Each round sends labels along the links, takes the minimum per node
    (combined before the shuffle) and then replaces each label by the label of
    that label, so chains shorten by doubling. The state is written with
    ``checkpoint`` every round: lineage stays short, lost executors cost one
    round, and both sides of every join are shuffled from files, so a node
    with very many links is a skewed join that adaptive execution splits. Only
    one number per round reaches the driver."""
    both = links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct()
    both = both.toDF("a", "b").checkpoint()
    labels = (
        both.groupBy(F.col("a").alias("node"))
        .agg(F.min("b").alias("b"))
        .select("node", F.least("node", "b").alias("label"))
        .checkpoint()
    )
    while True:
        sent = (
            both.join(labels, both["a"] == labels["node"])
            .groupBy(F.col("b").alias("to"))
            .agg(F.min("label").alias("got"))
        )
        lower = labels.join(sent, F.col("node") == F.col("to"), "left").select(
            "node", F.col("label").alias("old"), F.least("label", "got").alias("label")
        )
        roots = labels.select(F.col("node").alias("root"), F.col("label").alias("above"))
        new = (
            lower.join(roots, F.col("label") == F.col("root"), "left")
            .select("node", "old", F.least("label", "above").alias("label"))
            .checkpoint()
        )
        changed = new.filter("label <> old").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
