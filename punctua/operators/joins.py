"""Dimension lookups: bounded broadcasts, role-playing joins, unknown members,
unmatched-key reports and point-in-time lookups.

Broadcast policy: only frames whose size is bounded *by definition*
(code tables, calendar/hour dimensions, nation/region lists) are hinted with
``broadcast``; everything else is left to the planner, which broadcasts only
when the measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise shuffles (AQE re-plans with runtime sizes and splits skewed
partitions).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.operators.timeseries import asof_join

UNKNOWN_MEMBER_KEY = -1


def bounded_broadcast(dim: DataFrame) -> DataFrame:
    """Broadcast hint for a dimension whose row count is fixed by its domain."""
    return F.broadcast(dim)


def lookup_keys(dim: DataFrame, wanted: DataFrame, dim_key: str, wanted_key: str,
                cols: Sequence[str]) -> DataFrame:
    """Rows of ``dim`` whose key is in the ``wanted`` key set (semi join, no collect)."""
    return dim.join(wanted, dim[dim_key] == wanted[wanted_key], "left_semi").select(*cols)


def role_playing(fact: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, str],
                 attrs: Sequence[str], bounded: bool = False) -> DataFrame:
    """Join one dimension once per role (e.g. origin and destination airport).

    ``roles`` maps a fact foreign-key column to the prefix given to the
    dimension attributes of that role.  Left joins: a fact row is never lost.
    """
    out = fact
    for fk, prefix in roles.items():
        d = dim.select(F.col(dim_key).alias(f"_{prefix}_k"),
                       *[F.col(a).alias(f"{prefix}_{a}") for a in attrs])
        d = bounded_broadcast(d) if bounded else d
        out = out.join(d, out[fk] == d[f"_{prefix}_k"], "left").drop(f"_{prefix}_k")
    return out


def surrogate_key(*natural: Column | str) -> Column:
    """Deterministic 64-bit surrogate key from the natural key (same on every run)."""
    return F.xxhash64(*natural)


def with_unknown_member(dim: DataFrame, sk: str, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Append the ``-1`` unknown member row to a dimension."""
    defaults = defaults or {}
    row = dim.sparkSession.range(1).select(*[
        (F.lit(UNKNOWN_MEMBER_KEY).cast(t) if c == sk else F.lit(defaults.get(c)).cast(t)).alias(c)
        for c, t in dim.dtypes])
    return dim.unionByName(row)


def resolve_surrogate(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, sk: str,
                      carried: Mapping[str, object] | None = None) -> DataFrame:
    """Fact foreign key -> dimension surrogate key; orphans get ``-1``.

    ``carried`` names dimension columns (the natural key among them, if wanted) that come along in the same
    join, with the value of the unknown member: no second join on the surrogate key, which a hash collision or
    the many orphans on ``-1`` would spoil.
    """
    carried = carried or {}
    d = dim.select(F.col(dim_key).alias("_nk"), F.col(sk).alias("_sk"), *[F.col(c).alias(f"_d_{c}") for c in carried])
    j = fact.join(d, fact[fact_key] == d["_nk"], "left")
    found = F.col("_sk").isNotNull()
    return (j.withColumns({sk: F.coalesce("_sk", F.lit(UNKNOWN_MEMBER_KEY).cast("bigint")),
                           **{c: F.when(found, F.col(f"_d_{c}")).otherwise(F.lit(v)) for c, v in carried.items()}})
            .drop("_nk", "_sk", *[f"_d_{c}" for c in carried]))


def keys_missing_from(left: DataFrame, right: DataFrame, key: str, label: str) -> DataFrame:
    """Distinct keys of ``left`` absent from ``right``, tagged with ``label``."""
    return (left.select(key).distinct().join(right.select(key), key, "left_anti")
            .withColumn("side", F.lit(label)))


def unmatched_report(left: DataFrame, right: DataFrame, key: str,
                     left_label: str, right_label: str) -> DataFrame:
    """Keys present on one side only, with the side they were found on.

    Two ``left_anti`` joins (each a shuffle on the key, or a broadcast when a
    side is measured small) and a union; distinct keys per side first so the
    report has one row per key.
    """
    return (keys_missing_from(left, right, key, left_label)
            .unionByName(keys_missing_from(right, left, key, right_label)))


def point_in_time(fact: DataFrame, dim: DataFrame, fact_key: str, fact_ts: str, dim_key: str,
                  valid_from: str, valid_to: str, bucket_days: float | None = 1.0,
                  bucket_size: float | None = None) -> DataFrame:
    """Left join to the dimension version valid at ``fact_ts``:
    ``valid_from <= ts AND (valid_to IS NULL OR ts < valid_to)``.

    Versions of one key do not overlap (type-2 history), so the valid version
    is the latest one starting at or before ``ts`` — an as-of join — kept only
    if ``ts`` is before its end.  This is linear in the rows: no fact row is
    compared with every version of its key (a hot key with many versions
    would make an equi-join with a range residual quadratic), and the as-of
    join splits hot keys by ``ts`` bucket.  Unmatched rows get NULLs.
    """
    dim_cols = [c for c in dim.columns if c != dim_key]
    renamed = dim.select(F.col(dim_key).alias("_pit_k"), *dim_cols)
    j = asof_join(fact.withColumn("_pit_k", F.col(fact_key)), renamed, "_pit_k", fact_ts, valid_from, dim_cols,
                  strict=False, bucket_days=bucket_days, bucket_size=bucket_size, prefix="_pit_")
    inside = F.col("_pit_" + valid_from).isNotNull() & (
        F.col("_pit_" + valid_to).isNull() | (F.col(fact_ts) < F.col("_pit_" + valid_to)))
    return j.select(*fact.columns, *[F.when(inside, F.col("_pit_" + c)).alias(c) for c in dim_cols])
