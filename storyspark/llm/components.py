"""Connected components by smallest labels and pointer jumps, one written table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyspark.session import written


def components(edges: DataFrame) -> DataFrame:
    """``id``, ``label``: the smallest id reachable from every end of an edge ``a``, ``b``.

    A round takes the smallest label among neighbours and then the label of that label, so long
    chains shrink by halves. It ends when a round changes nothing. Nothing reaches the driver but
    the answer to "did a label change".
    """
    pairs = edges.where("a != b").select("a", "b")
    both = written(pairs.union(pairs.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("id", "b"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near")))
        lower = written(labels.join(near, "id").select(
            "id", F.least("label", "near").alias("label"), F.col("label").alias("before")), "lower")
        ends = lower.select(F.col("id").alias("label"), F.col("label").alias("next"))
        after = written(lower.join(ends, "label").select(
            "id", F.col("next").alias("label"), (F.col("next") != F.col("before")).alias("changed")), "labels")
        labels = after.select("id", "label")
        if after.where("changed").isEmpty():
            return labels
