"""Connected components of a graph that is held in tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm.common import discard, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each node of a link with the smallest node it can reach.

    Each round a node takes the smallest label of its neighbours; from the third round on also the label of
    that label, so that long chains shrink fast (stars need two rounds). Rounds end when no label changes.
    Every round is written to the shared folder, and the one before it deleted; only whether one changed
    goes to the driver. Links are summed by node before they are joined.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u") != F.col("v"))
    edges = stored(pairs.union(pairs.select("v", "u")).distinct(), "edges")
    labels = stored(edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("component")), "labels")
    turn = 0
    while True:
        turn += 1
        near = edges.join(labels, edges["v"] == labels["node"]).groupBy("u").agg(F.min("component").alias("m"))
        step = labels.join(near, labels["node"] == near["u"], "left").select("node", F.col("component").alias("was"), F.least("component", F.coalesce("m", "component")).alias("component"))
        step = stored(step, "label-step")
        discard(labels)
        if turn > 2:
            jump = step.select(F.col("node").alias("j"), F.col("component").alias("far"))
            far = stored(step.join(jump, step["component"] == jump["j"], "left").select("node", "was", F.least("component", F.coalesce("far", "component")).alias("component")), "labels")
            discard(step)
            step = far
        labels = step.select("node", "component")
        if step.where(F.col("was") != F.col("component")).isEmpty():
            discard(edges)
            return labels
