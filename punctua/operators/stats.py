"""Model-evaluation and drift statistics as distributed aggregates.

* :func:`pr_curve` — precision/recall/F1 per threshold and average precision.
  Thresholds are the distinct scores; cumulative counts are worked out range by range.
* :func:`psi` — population stability index of each feature between a
  reference and a current period: 10 equal-width bins on the reference
  min/max (outer bins open), shares floored at 1e-6, natural log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctua.session import materialize

# Fixed parameters of the drift measure.
PSI_BINS = 10
PSI_FLOOR = 1e-6


def pr_curve(scored: DataFrame, score: str, label: str) -> DataFrame:
    """One row per distinct score. Thresholds are dealt by range; the sums of the (few) ranges give each range what
    lies above it, and a window inside each range the rest, so no task sees the whole curve."""
    pts = (scored.filter(F.col(score).isNotNull())
           .groupBy(F.col(score).alias("threshold"))
           .agg(F.sum(F.col(label)).cast("bigint").alias("pos"),
                F.sum(1 - F.col(label)).cast("bigint").alias("neg")))
    # written, since ranges are found by sampling and have to stay the same in both passes
    pts = materialize(pts.repartitionByRange("threshold").withColumn("part", F.spark_partition_id()), "thresholds")
    higher = Window.orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    parts = pts.groupBy("part").agg(F.sum("pos").alias("part_pos"), F.sum("neg").alias("part_neg"))
    parts = parts.select("part", F.coalesce(F.sum("part_pos").over(higher), F.lit(0)).alias("pos_above"),
                         F.coalesce(F.sum("part_neg").over(higher), F.lit(0)).alias("neg_above"),
                         F.sum("part_pos").over(Window.partitionBy()).alias("all_pos"))
    w = Window.partitionBy("part").orderBy(F.col("threshold").desc()).rowsBetween(Window.unboundedPreceding, 0)
    # one row per shuffle partition: bounded by the partition count
    c = (pts.join(F.broadcast(parts), "part")
         .withColumn("tp", F.col("pos_above") + F.sum("pos").over(w))
         .withColumn("fp", F.col("neg_above") + F.sum("neg").over(w)))
    c = (c.withColumn("precision", F.col("tp") / (F.col("tp") + F.col("fp")))
         .withColumn("recall", F.when(F.col("all_pos") > 0, F.col("tp") / F.col("all_pos"))))
    average = c.agg(F.sum(F.when(F.col("all_pos") > 0, F.col("pos") / F.col("all_pos") * F.col("precision"))))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    return c.select("threshold", "tp", "fp", F.round("precision", 6).alias("precision"),
                    F.round("recall", 6).alias("recall"), F.round(f1, 6).alias("f1"),
                    F.round(average.scalar(), 6).alias("average_precision"))


def psi(df: DataFrame, features: Sequence[str], is_reference, is_current) -> DataFrame:
    """``df`` holds the feature columns plus whatever ``is_reference``/``is_current`` read."""
    stack = ", ".join(f"'{f}', CAST(`{f}` AS DOUBLE)" for f in features)
    long = (df.select(is_reference.alias("_ref"), is_current.alias("_cur"), F.expr(
        f"stack({len(features)}, {stack}) AS (feature, x)"))
        .filter(F.col("x").isNotNull() & (F.col("_ref") | F.col("_cur"))))
    bounds = (long.filter("_ref").groupBy("feature")
              .agg(F.min("x").alias("lo"), F.max("x").alias("hi")))
    width = (F.col("hi") - F.col("lo")) / PSI_BINS
    b = F.when(width > 0, F.floor((F.col("x") - F.col("lo")) / width)).otherwise(F.lit(0))
    b = F.least(F.greatest(b, F.lit(0)), F.lit(PSI_BINS - 1)).cast("int")
    # bounds is one row per feature (bounded by the feature list)
    binned = long.join(F.broadcast(bounds), "feature").withColumn("bin", b)
    counts = (binned.groupBy("feature", "bin")
              .agg(F.count_if("_ref").alias("n_ref"), F.count_if("_cur").alias("n_cur")))
    grid = bounds.select("feature", F.explode(F.sequence(F.lit(0), F.lit(PSI_BINS - 1))).alias("bin"))
    per = grid.join(counts, ["feature", "bin"], "left").fillna(0, ["n_ref", "n_cur"])
    wf = Window.partitionBy("feature")
    per = (per.withColumn("ref_share", F.greatest(F.col("n_ref") / F.sum("n_ref").over(wf), F.lit(PSI_FLOOR)))
           .withColumn("cur_share", F.greatest(F.col("n_cur") / F.sum("n_cur").over(wf), F.lit(PSI_FLOOR))))
    per = per.withColumn("psi_part", (F.col("cur_share") - F.col("ref_share"))
                         * F.log(F.col("cur_share") / F.col("ref_share")))
    per = per.withColumn("psi", F.sum("psi_part").over(wf))
    return per.select("feature", "bin", F.col("n_ref").cast("bigint").alias("n_ref"),
                      F.col("n_cur").cast("bigint").alias("n_cur"),
                      F.round("ref_share", 6).alias("ref_share"), F.round("cur_share", 6).alias("cur_share"),
                      F.round("psi_part", 6).alias("psi_part"), F.round("psi", 6).alias("psi"))
