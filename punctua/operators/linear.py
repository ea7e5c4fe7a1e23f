"""Logistic models as expressions: a fit by Newton steps on aggregated sums, and importance by permutation.

Nothing here trains inside a library: each step is an ordinary aggregate, so a fit, its scores and a feature's importance can
be checked against the same sums in SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def linear_score(weights: Sequence[float], features: Sequence[str]) -> Column:
    """Probability by a logistic formula: ``weights`` has the intercept first; a NULL feature counts 0."""
    z = F.lit(float(weights[0]))
    for w, f in zip(weights[1:], features):
        z = z + F.lit(float(w)) * F.coalesce(F.col(f).cast("double"), F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def newton_logistic(df: DataFrame, features: Sequence[str], label: str, steps: int = 6, ridge: float = 1e-6) -> list[float]:
    """Logistic regression by Newton steps: weights, intercept first.

    Each step is one aggregate of sums over all rows (gradient and second derivatives, (p + 1)(p + 4) / 2 numbers for p
    features), combined on the map side; only these reach the driver, which solves a system of p + 1 unknowns. The number of
    steps is fixed, so the result is that of the same sums in any other engine, up to their rounding.
    """
    import numpy as np

    p = len(features) + 1
    x = [F.lit(1.0)] + [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]
    rows = df.where(F.col(label).isNotNull())
    weights = np.zeros(p)
    for _ in range(steps):
        score = linear_score(weights.tolist(), features)
        scored = rows.select(*[c.alias(f"_x{i}") for i, c in enumerate(x)], (F.col(label).cast("double") - score).alias("_r"),
                             (score * (1 - score)).alias("_v"))
        sums = [F.sum(F.col("_r") * F.col(f"_x{i}")) for i in range(p)]
        sums += [F.sum(F.col("_v") * F.col(f"_x{i}") * F.col(f"_x{j}")) for i in range(p) for j in range(i, p)]
        got = [0.0 if v is None else v for v in scored.agg(*[c.alias(f"s{k}") for k, c in enumerate(sums)]).first()]
        second = np.zeros((p, p))
        second[np.triu_indices(p)] = got[p:]
        second = second + np.triu(second, 1).T + ridge * np.eye(p)
        weights = weights + np.linalg.solve(second, np.array(got[:p]) - ridge * weights)
    return weights.tolist()


def hash_order(key: Sequence[str], feature: str) -> Column:
    """A row's place in the random order of a feature's permutation: hexadecimal digits of a hash of key and feature."""
    return F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in key], F.lit(feature)))


def permuted(df: DataFrame, feature: str, key: Sequence[str], digits: int = 2) -> DataFrame:
    """``df`` with ``feature`` permuted: each row gets the value of the row before it in hash order, the first one the last's.

    The order is cut into 16^digits ranges of the hash; a window shifts values inside each, and a small table of the ranges' last
    values hands them on to the next range, so no task sees the whole order. The same keys always give the same permutation.
    """
    place = [F.col("_h"), *[F.col(k) for k in key]]
    rows = df.withColumn("_h", hash_order(key, feature)).withColumn("_range", F.substring("_h", 1, digits))
    inside = Window.partitionBy("_range").orderBy(*place)
    boxed = F.struct(F.col(feature).alias("v"))  # so that a NULL value differs from no row
    rows = rows.withColumn("_before", F.lag(boxed).over(inside))
    ends = rows.groupBy(F.col("_range").alias("_e")).agg(F.max_by(boxed, F.struct(*place)).alias("_last"))
    every = Window.orderBy("_e")  # 16^digits rows at most
    ends = ends.select("_e", F.coalesce(F.lag("_last").over(every), F.last("_last").over(
        every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_carry"))
    out = rows.join(F.broadcast(ends), F.col("_range") == F.col("_e"))
    return out.withColumn(feature, F.coalesce("_before", "_carry")["v"]).drop("_h", "_range", "_before", "_e", "_last", "_carry")


def log_loss(score: Column, label: Column) -> Column:
    p = F.least(F.greatest(score, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.avg(-(label * F.log(p) + (1 - label) * F.log(1 - p)))


def permutation_importance(df: DataFrame, score: Callable[[], Column], features: Sequence[str], label: str, key: Sequence[str]) -> DataFrame:
    """feature, loss (with the feature permuted), base_loss, importance (their difference): how much worse a model's mean log loss
    gets when a feature says nothing about its row. Any model that is an expression of the features will do.

    One window and one aggregate per feature; ``df`` is best written beforehand.
    """
    rows = df.where(F.col(label).isNotNull())
    base = rows.agg(log_loss(score(), F.col(label)).alias("base_loss"))
    out = None
    for f in features:
        one = permuted(rows, f, key).agg(log_loss(score(), F.col(label)).alias("loss")).select(F.lit(f).alias("feature"), "loss")
        out = one if out is None else out.unionByName(one)
    return out.select("feature", "loss", F.lit(base.scalar()).alias("base_loss")).withColumn("importance", F.col("loss") - F.col("base_loss"))
