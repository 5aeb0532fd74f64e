"""Connected components of an edge table, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable from each node of the edges (a, b).

    Each round every node takes the smallest label among its neighbours' and its own, and
    then its label's label, so that chains halve; the labels of a round are a table in the
    shared folder. It ends when a round changes nothing.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        to = step.select(F.col("node").alias("low"), F.col("low").alias("jump"))
        new = written(step.join(to, "low", "left").select("node", F.least("low", F.coalesce("jump", "low")).alias("label"), (F.least("low", F.coalesce("jump", "low")) < F.col("label")).alias("moved")))
        labels = new.select("node", "label")
        if new.filter("moved").isEmpty():
            return labels
