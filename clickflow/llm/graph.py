"""Connected components by label propagation with pointer jumping; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """v, c for every end of ``edges`` (a, b): c is the smallest vertex of v's component.

    A round takes the least label among a vertex' neighbours and then the label of its label, so
    long chains shrink by powers of two; rounds end when no label changes. Each round's labels are
    written to the shared folder, which cuts the lineage."""
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                   "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m"))
                     .select(F.col("a").alias("v"), F.least("a", "m").alias("c")), "labels")
    while True:
        near = (both.join(labels.select(F.col("v").alias("b"), "c"), "b")
                .groupBy(F.col("a").alias("v")).agg(F.min("c").alias("m")))
        new = labels.join(near, "v").select("v", F.col("c").alias("old"), F.least("c", "m").alias("c"))
        up = new.select(F.col("v").alias("c"), F.col("c").alias("top"))
        new = written(new.join(up, "c").select("v", "old", F.least("c", "top").alias("c")), "labels")
        if new.where("c <> old").isEmpty():
            return new.select("v", "c")
        labels = new.select("v", "c")
