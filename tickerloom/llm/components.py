"""Connected components by minimum labels, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import materialize

#: Labels at least halve their distance each round; this many rounds reach any real graph.
MAX_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of ``edges`` (a, b): the smallest id reachable.

    A round takes the smallest label among neighbours, then the label of that label. Both are
    joins and a minimum that adds up in the map tasks, so hubs cost no more than their edges.
    """
    ends = edges.select("a", "b").filter("a <> b")
    both = ends.union(ends.select("b", "a")).distinct()
    both = materialize(both, "edges")
    labels = both.groupBy("a").agg(F.min("b").alias("_near")).select(
        F.col("a").alias("id"), F.least("a", "_near").alias("component")
    )
    labels = materialize(labels, "labels")
    for _ in range(MAX_ROUNDS):
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("_near"))
        )
        lower = labels.join(near, "id").select(
            "id", F.col("component").alias("_old"), F.least("component", "_near").alias("_new")
        )
        above = labels.select(F.col("id").alias("_new"), F.col("component").alias("_above"))
        jumped = lower.join(above, "_new").select(
            "id", F.least("_new", "_above").alias("component"), "_old"
        )
        jumped = materialize(jumped, "labels")
        moved = jumped.filter("component <> _old").limit(1).count()
        labels = jumped.drop("_old")
        if not moved:
            return labels
    raise RuntimeError("labels did not settle")
