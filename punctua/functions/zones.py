"""Local wall-clock times with their folds and gaps.

Offsets of a zone change at few instants. :func:`zone_changes` finds them with Spark's own zone rules and keeps them as sorted
arrays, one row per zone. A local time is then placed among them by halving, inside an expression: between changes it has
one instant, in the repeated part after a change backwards two, in the part skipped by a change forwards none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR = 3_600 * 1_000_000


def _offset(utc: Column, zone: Column) -> Column:
    return F.unix_micros(F.from_utc_timestamp(utc, zone)) - F.unix_micros(utc)


def zone_changes(zones: DataFrame, zone: str, start: str, end: str) -> DataFrame:
    """z_zone, z_first (offset at ``start``), z_changes: array of (begin, finish, before, after) in microseconds.

    ``begin``/``finish`` are the local times between which a change repeats or skips; offsets are looked at once a day, and
    once a minute on days on which they change. One row per zone, a few changes a year.
    """
    names = zones.select(F.col(zone).alias("z_zone")).where("z_zone IS NOT NULL").distinct()
    z = F.col("z_zone")
    day = names.select("z_zone", F.explode(F.sequence(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"), F.expr("interval 1 day"))).alias("u"))
    at = _offset(F.col("u"), z)
    moved = day.where(at != _offset(F.col("u") + F.expr("interval 1 day"), z))
    minute = moved.select("z_zone", F.explode(F.sequence(
        F.col("u") + F.expr("interval 1 minute"), F.col("u") + F.expr("interval 1 day"), F.expr("interval 1 minute"))).alias("u"))
    before, u = _offset(F.col("u") - F.expr("interval 1 minute"), z), F.unix_micros("u")
    change = F.struct((u + F.least(before, at)).alias("begin"), (u + F.greatest(before, at)).alias("finish"),
                      before.alias("before"), at.alias("after"))
    found = minute.where(before != at).groupBy(F.col("z_zone").alias("c_zone")).agg(F.sort_array(F.collect_list(change)).alias("z_changes"))
    none = F.array().cast("array<struct<begin:bigint,finish:bigint,before:bigint,after:bigint>>")
    return names.join(found, F.col("z_zone") == F.col("c_zone"), "left").select(
        "z_zone", _offset(F.lit(start).cast("timestamp"), z).alias("z_first"), F.coalesce("z_changes", none).alias("z_changes"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def instants(local: Column, first: Column, changes: Column) -> Column:
    """struct(first_utc, second_utc, is_repeated, is_gap) of a local time (a zone-less TIMESTAMP read as UTC).

    In a repeated part both instants are given, else they are equal; a skipped time is moved forward by what was skipped.
    """
    t = F.unix_micros(local)

    def halve(low: Column, k: Column) -> Column:
        step = F.pow(F.lit(2), F.lit(20) - k).cast("int")
        fits = (step <= F.size(changes) - low) & (F.get(changes, low + step - 1)["begin"] <= t)
        return F.when(fits, low + step).otherwise(low)

    behind = F.aggregate(F.sequence(F.lit(0), F.lit(20)), F.lit(0), halve)  # changes that begin by then

    def placed(n: Column) -> Column:
        c = F.get(changes, n - 1)
        inside = (n > 0) & (t < c["finish"])
        offset = F.when(n == 0, first).when(inside, c["before"]).otherwise(c["after"])
        back = F.coalesce(inside & (c["after"] < c["before"]), F.lit(False))
        second = F.when(back, c["after"]).otherwise(offset)
        return F.struct(F.timestamp_micros(t - offset).alias("first_utc"), F.timestamp_micros(t - second).alias("second_utc"),
                        back.alias("is_repeated"), F.coalesce(inside & ~back, F.lit(False)).alias("is_gap"))

    return F.when(local.isNotNull() & changes.isNotNull(), _let(behind, placed))


def resolve_folds(df: DataFrame, key: str, local: str, order: str, zone: str, changes: DataFrame) -> DataFrame:
    """``df`` with utc_ts, is_repeated, is_gap: rows of a key come in the given ``order``, so in a repeated part the clock has
    been set back once a later local time of that part came before; from then on the second instant holds.

    ``changes``: see :func:`zone_changes`; its few rows are broadcast.
    """
    j = df.join(F.broadcast(changes), F.col(zone) == F.col("z_zone"), "left")
    j = j.withColumn("_at", instants(F.col(local), F.col("z_first"), F.col("z_changes"))).drop(*changes.columns)
    repeated = F.coalesce(F.col("_at.is_repeated"), F.lit(False))
    # only rows of a repeated part meet: a key and that part (its two offsets lie an hour or so apart, parts half a year)
    part = F.date_trunc("week", F.col("_at.first_utc"))
    w = Window.partitionBy(key, part).orderBy(order)
    seen = F.max(local).over(w.rowsBetween(Window.unboundedPreceding, -1))
    folded = j.where(repeated).withColumn("utc_ts", F.when(seen > F.col(local), F.col("_at.second_utc")).otherwise(F.col("_at.first_utc")))
    # once set back, set back for the rest of the part
    back = F.max((F.col("utc_ts") != F.col("_at.first_utc")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    folded = folded.withColumn("_back", back).withColumn(
        "utc_ts", F.when(F.col("_back") == 1, F.col("_at.second_utc")).otherwise(F.col("_at.first_utc"))).drop("_back")
    plain = j.where(~repeated).withColumn("utc_ts", F.col("_at.first_utc"))
    return folded.unionByName(plain).withColumns({"is_repeated": F.coalesce("_at.is_repeated", F.lit(False)),
                                                  "is_gap": F.coalesce("_at.is_gap", F.lit(False))}).drop("_at")
