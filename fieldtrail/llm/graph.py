"""Connected components of an edge table, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtrail.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(v, label) of every vertex of the undirected ``edges`` (a, b): the smallest vertex it reaches.

    Each round takes the smallest label among the neighbours, then the label of that label, so
    labels travel in doubling steps. Rounds are written tables. A NULL end is no edge.
    """
    edges = edges.filter("a != b").select("a", "b")
    both = stored(edges.union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("v").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        )
        hooked = labels.join(near, "v").select("v", "label", F.least("label", "near").alias("next"))
        ahead = labels.select(F.col("v").alias("next"), F.col("label").alias("jump"))
        moved = stored(
            hooked.join(ahead, "next").select("v", F.least("next", "jump").alias("label"), (F.least("next", "jump") < F.col("label")).alias("moved")),
            "labels",
        )
        labels = moved.select("v", "label")
        if not moved.filter("moved").limit(1).count():
            return labels
