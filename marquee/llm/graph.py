"""Connected components of a link table, with all state in shared files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): the smallest node it reaches.

    Each round a node takes the least label among itself and its neighbours,
    then follows that label's own label (paths halve), until nothing changes.
    A node with very many links is a join key whose rows the engine may split,
    and its minimum is combined on the map side.
    """
    # Both directions from one evaluation: links that are chosen among equals may come out otherwise a second time,
    # and a link known from one side only would not join its ends.
    ways = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("_w")
    both = materialize(links.filter("a <> b").select(ways).select("_w.a", "_w.b").distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a"))
                                                                   .alias("component")), "labels")
    while True:
        near = (both.join(labels.withColumnsRenamed({"node": "b", "component": "_c"}), "b")
                    .groupBy(F.col("a").alias("node")).agg(F.min("_c").alias("_near")))
        step = labels.join(near, "node").withColumn("_least", F.least("component", "_near"))
        jump = labels.select(F.col("node").alias("_least"), F.col("component").alias("_jump"))
        moved = materialize(step.join(jump, "_least").select(
            "node", F.least("_least", "_jump").alias("component"),
            (F.least("_least", "_jump") < F.col("component")).alias("moved")), "labels")
        changed = moved.filter("moved").limit(1).count()
        discard(labels)
        labels = moved.drop("moved")
        if not changed:
            discard(both)
            return labels
