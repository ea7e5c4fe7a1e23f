"""Declarative data-quality rules with quarantine.

``Expectation(name, condition, action)`` with action ``warn`` (count only),
``drop`` (row leaves the valid output and goes to quarantine) or ``fail``
(the run must stop if any row violates it).

NULL rule: a condition passes only when it is TRUE.  The valid and
quarantine outputs are therefore an exact partition of the input.

Metrics are one aggregate (``count_if`` per rule) — a single pass with
map-side partial aggregation, or ``DataFrame.observe`` when the rows are
written anyway.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ACTIONS = ("warn", "drop", "fail")


@dataclass(frozen=True)
class Expectation:
    name: str
    condition: str
    action: str = "drop"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"unknown action {self.action!r}")

    @property
    def passed(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


@dataclass
class QualityResult:
    valid: DataFrame
    quarantine: DataFrame
    rules: Sequence[Expectation]

    def metrics(self) -> DataFrame:
        return expectation_metrics(self.valid.unionByName(self.quarantine.drop("_failed_rules")), self.rules)


def _blocking(rules: Sequence[Expectation]) -> list[Expectation]:
    return [r for r in rules if r.action in ("drop", "fail")]


def all_pass(rules: Sequence[Expectation]) -> Column:
    cond = F.lit(True)
    for r in _blocking(rules):
        cond = cond & r.passed
    return cond


def failed_rules(rules: Sequence[Expectation]) -> Column:
    """array<string> of the blocking rules a row violates."""
    names = [F.when(~r.passed, F.lit(r.name)) for r in _blocking(rules)]
    if not names:
        return F.array().cast("array<string>")
    return F.filter(F.array(*names), lambda x: x.isNotNull())


def apply_expectations(df: DataFrame, rules: Sequence[Expectation]) -> QualityResult:
    ok = all_pass(rules)
    valid = df.filter(ok)
    quarantine = df.filter(~ok).withColumn("_failed_rules", failed_rules(rules))
    return QualityResult(valid, quarantine, list(rules))


def expect_or_drop(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    return df.filter(all_pass(rules))


def quarantine(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    return df.filter(~all_pass(rules))


def guarded(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """``df``, whose job ends at the first row that violates a ``fail`` rule: the check is part of the plan that writes the
    rows, so they are read once and nothing is counted beforehand."""
    fail = [r for r in rules if r.action == "fail"]
    if not fail:
        return df
    broken = F.concat_ws(", ", *[F.when(~r.passed, F.lit(r.name)) for r in fail])
    return df.where(F.when(broken == "", True).otherwise(F.raise_error(F.concat(F.lit("fail expectations violated: "), broken)).cast("boolean")))


def expectation_metrics(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """One row per rule: name, action, passed, failed (BIGINT)."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, r in enumerate(rules):
        aggs.append(F.count_if(~r.passed).alias(f"_f{i}"))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{r.name}', '{r.action}', _f{i}" for i, r in enumerate(rules))
    long = wide.selectExpr("_total", f"stack({len(rules)}, {stack}) as (rule, action, failed)")
    return long.select(
        "rule", "action",
        (F.col("_total") - F.col("failed")).cast("bigint").alias("passed"),
        F.col("failed").cast("bigint").alias("failed"),
    )


def observe_expectations(df: DataFrame, rules: Sequence[Expectation], name: str = "dq") -> tuple[DataFrame, Observation]:
    """Attach rule counters to a frame that is written anyway (no extra pass).

    Caveat (Spark 4.1): after an ``Observation`` has been used in a session,
    ``pyspark.ml`` training in that same session fails with "Task not
    serializable"; train models in :func:`punctua.operators.ml.ml_session`.
    """
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(~r.passed).alias(r.name) for r in rules]
    return df.observe(obs, *exprs), obs


def enforce_fail_rules(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Rows pass through unchanged; a violated ``fail`` rule raises at execution."""
    fail = [r for r in rules if r.action == "fail"]
    if not fail:
        return df
    cond = F.lit(True)
    for r in fail:
        cond = cond & r.passed
    msg = "expectation failed: " + ", ".join(r.name for r in fail)
    return df.filter(F.when(cond, F.lit(True)).otherwise(F.raise_error(F.lit(msg)).cast("boolean")))
