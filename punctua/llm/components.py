"""Connected components of an edge table: smallest id reachable from each vertex, by rounds of Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """v, comp for every vertex of ``edges`` (a, b).

    Each round a vertex takes the smallest label among its neighbours and then the label of that label, so chains
    halve; every round is written to the shared folder, which cuts the lineage. Aggregation is combined map-side,
    so a hub's edges do not meet in one task before they are reduced.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .where("a != b").distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.min("a")).alias("comp")), "labels")
    while True:
        seen = both.join(labels, F.col("b") == F.col("v")).groupBy(F.col("a").alias("n")).agg(F.min("comp").alias("m"))
        step = labels.join(seen, F.col("v") == F.col("n")).select("v", F.least("comp", "m").alias("l"), F.col("comp").alias("old"))
        jump = labels.select(F.col("v").alias("j"), F.col("comp").alias("jc"))
        new = materialize(step.join(jump, F.col("l") == F.col("j"), "left").select(
            "v", F.least("l", F.coalesce("jc", "l")).alias("comp"), "old"), "labels")
        labels = new.select("v", "comp")
        if not new.where("comp != old").limit(1).count():
            return labels
