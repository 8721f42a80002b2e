"""Connected components of links between ids, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.workspace import written


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``label``, the smallest id it can be reached from, for every end of ``links`` (a, b).

    Each round gives a node the smallest label of itself, its neighbours and the node its label names (so long
    chains halve), and is written; it ends when no label changes. An id at many links is summed up before the shuffle.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        ahead = labels.select(F.col("id").alias("label"), F.col("label").alias("ahead"))
        after = (
            labels.join(near, labels["id"] == near["a"])
            .join(ahead, "label")
            .select("id", F.least("label", "near", "ahead").alias("label"), (F.least("label", "near", "ahead") < F.col("label")).alias("moved"))
        )
        after = written(after, "labels")
        labels = after.select("id", "label")
        if after.filter("moved").isEmpty():
            return labels
