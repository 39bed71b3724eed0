"""Connected components as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """``(node, comp)`` for every node of the edges ``(a, b)``; ``comp`` is the
    smallest node reachable.

    Every round a node takes the smallest label among its neighbours, then the
    label of its label, until no label changes.  A round is two joins on narrow
    rows and one partial aggregation, written as a table, so nothing of the
    graph is held in one place.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), "edges")
    labels = written(both.select(F.col("a").alias("node")).distinct().withColumn("comp", F.col("node")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "comp"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near")))
        hooked = labels.join(near, "node").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        roots = labels.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        now = written(hooked.join(roots, "comp").select("node", "was", F.least("comp", "root").alias("comp")), "labels")
        labels = now.select("node", "comp")
        if now.where("was != comp").isEmpty():
            return labels
