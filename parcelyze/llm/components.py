"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(edges: DataFrame, u="u", v="v") -> DataFrame:
    """(node, label) for every endpoint; the label is the smallest node reachable.

    Each round a node takes the smallest label among its neighbours and then the
    label of that label (pointer jumping), so long chains shrink by doubling. A
    round is written to the shared folder, which cuts lineage. Neighbours are
    combined in every partition before the shuffle, so a hub with very many of
    them sends one row per partition.
    """
    e = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u <> v")
    both = materialize(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "cc-edges")
    labels = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("label"), F.lit(True).alias("moved"))
    labels = materialize(labels, "cc-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("v"), "label"), "v")
                .groupBy("u").agg(F.min("label").alias("near")))
        step = (labels.join(near, labels["node"] == near["u"])
                .select("node", "label", F.least("label", "near").alias("next")))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        step = step.join(jump, "next").select(
            "node", F.least("next", "far").alias("label"), (F.least("next", "far") != F.col("label")).alias("moved"))
        labels = materialize(step, "cc-labels")
        if labels.filter("moved").limit(1).count() == 0:
            return labels.select("node", "label")
