"""Connected components of an undirected graph, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, settled


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of edges (u, v): comp is the smallest node reachable.

    Each round takes the least label of the neighbours and then the label of that label, so labels cross a
    component in a number of rounds that is logarithmic in its usual depth. Every round is written to the
    shared folder, which cuts the lineage; the driver sees only whether anything changed.
    """
    one_way = edges.select("u", "v").where("u <> v")
    both = settled(one_way.union(one_way.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = settled(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least")).select("node", F.least("node", "least").alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "comp"), "v").groupBy(F.col("u").alias("node")).agg(F.min("comp").alias("near"))
        step = kept(labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp")))
        root = step.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        jumped = settled(step.join(root, "comp").select("node", "old", F.least("comp", "root").alias("comp")), "labels")
        step.unpersist()
        labels = jumped.select("node", "comp")
        if jumped.where("comp <> old").isEmpty():
            return labels
