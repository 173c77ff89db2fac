"""Runs of places per document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merged_spans(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Half-open spans (a, b) united into maximal runs: per key a sorted ``spans`` array.

    Touching spans unite. A key's spans lie in one task; they are a document's own, and bounded by it.
    """
    document = Window.partitionBy(*keys).orderBy("a", "b")
    reach = F.max("b").over(document.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("a") <= F.col("reach"), 0).otherwise(1)).over(document)
    return (
        spans.select(*keys, "a", "b").withColumn("reach", reach).withColumn("island", island)
        .groupBy(*keys, "island").agg(F.min("a").alias("a"), F.max("b").alias("b"))
        .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans"))
    )
