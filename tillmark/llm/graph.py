"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.store import Store


def components(edges: DataFrame, store: Store, name: str) -> DataFrame:
    """node, component (the smallest node that can be reached) of every node with an edge.

    Takes the smallest label among neighbours and then the label's own label, until nothing
    changes; the second step halves paths, so rounds grow with the logarithm of the longest.
    Labels are written after each round. A node with very many edges is a skewed key of joins
    between written tables, which Spark splits, and of a sum with partial results.
    """
    pairs = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    both = store.hold(
        pairs.union(pairs.select(F.col("b"), F.col("a"))).distinct(), f"{name}-edges"
    )
    labels = store.hold(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        .select("node", F.least("node", "m").alias("label"), F.lit(True).alias("changed")),
        f"{name}-0",
    )
    number = 0
    while labels.filter("changed").limit(1).count():
        number += 1
        lowest = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        jump = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        labels = store.hold(
            labels.join(lowest, "node")
            .select("node", "label", F.least("label", "near").alias("near"))
            .join(jump, "near")
            .select("node", F.least("near", "far").alias("label"),
                    (F.least("near", "far") < F.col("label")).alias("changed")),
            f"{name}-{number}",
        )
        store.drop(f"{name}-{number - 1}")
    store.drop(f"{name}-edges")
    return labels.select("node", F.col("label").alias("component"))
