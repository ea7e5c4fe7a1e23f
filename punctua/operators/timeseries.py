"""Time-series operators: as-of join, trailing windows, forward fill, hourly/daily roll-ups.

Skew: a key (airport, user, route) may hold a third of all rows.  A window
partitioned by the key alone would sort that third in one task, so both the
as-of join and the trailing window split each key by time bucket:

* as-of: last value inside ``(key, bucket)``; rows without a match in their
  bucket take the carry from earlier buckets, computed on the per-bucket
  summary (size keys x buckets, independent of rows per bucket).
* trailing sums of N: running sums to which a row adds at its time and from
  which it is taken off N later; buckets of any width, totals carried over.
* trailing window of N: every row is also copied, as context only, into the
  next ceil(N / bucket width) buckets, so each ``(key, bucket)`` partition
  holds every row its frames can reach.  Exact; with the default bucket width
  N the rows cross one shuffle twice, narrower buckets split a hot key finer
  at the cost of more copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.session import materialize, materialize_by

MICROS_PER_DAY = 86_400 * 1_000_000


def _bucket(ts: Column, width_micros: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(width_micros)).cast("bigint")


def order_bucket(c: Column, dtype: str, bucket_days: float | None, bucket_size: float | None) -> Column | None:
    """Bucket of an ordering value: days for TIMESTAMP/DATE, ``bucket_size`` units for numbers."""
    if dtype.startswith("timestamp"):
        return None if bucket_days is None else _bucket(c.cast("timestamp"), int(bucket_days * MICROS_PER_DAY))
    if dtype == "date":
        return None if bucket_days is None else F.floor(F.unix_date(c) / F.lit(bucket_days)).cast("bigint")
    return None if bucket_size is None else F.floor(c / F.lit(bucket_size)).cast("bigint")


def asof_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
              right_cols: Sequence[str], tie: str | None = None, strict: bool = True,
              bucket_days: float | None = 1.0, prefix: str = "", bucket_size: float | None = None) -> DataFrame:
    """For each ``left`` row, the latest ``right`` row of the same key before it.

    ``strict=True``: right.ts < left.ts (equal times never match); otherwise
    right.ts <= left.ts.  Among right rows with equal time the highest
    ``tie`` wins.  Every left row is kept (left as-of join); unmatched rows get
    NULLs.  The ordering columns may be TIMESTAMP/DATE (buckets of
    ``bucket_days``) or numeric, e.g. sequence numbers (buckets of
    ``bucket_size``); without a bucket width one window per key is used (fine
    when no key is hot), with one each key is split by bucket as described in
    the module docstring.
    """
    rc = list(right_cols)
    tie_col = (F.col(tie) if tie else F.lit(0)).cast("long")
    payload = F.struct(*[F.col(c).alias(c) for c in rc])
    fact_side, feat_side = (0, 1) if strict else (1, 0)
    lcols = left.columns
    right = right.filter(F.col(key).isNotNull())  # a NULL key matches nothing
    l = left.select(*[F.col(c) for c in lcols], F.col(key).alias("_k"), F.col(left_ts).alias("_t"),
                    F.lit(fact_side).alias("_side"), F.lit(None).cast("long").alias("_tie"),
                    F.lit(None).cast(payload_type(right, rc)).alias("_p"))
    r = right.select(*[F.lit(None).cast(t).alias(c) for c, t in left.dtypes],
                     F.col(key).alias("_k"), F.col(right_ts).alias("_t"), F.lit(feat_side).alias("_side"),
                     tie_col.alias("_tie"), payload.alias("_p"))
    u = l.unionByName(r)
    order = [F.col("_t"), F.col("_side"), F.col("_tie")]
    ts_type = dict(left.dtypes)[left_ts]
    bucket = order_bucket(F.col("_t"), ts_type, bucket_days, bucket_size)
    if bucket is None:
        w = Window.partitionBy("_k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        out = (u.withColumn("_m", F.last("_p", ignorenulls=True).over(w))
               .filter(F.col("_side") == fact_side))
    else:
        part = Window.partitionBy("_k", "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        rows = (u.withColumn("_b", bucket).withColumn("_m", F.last("_p", ignorenulls=True).over(part))
                .filter(F.col("_side") == fact_side))
        # what earlier buckets hand over: the last right row per bucket, and the buckets that left rows ask for;
        # both are aggregated on the map side, so only keys x buckets rows are shuffled
        asked = (left.filter(F.col(key).isNotNull())
                 .select(F.col(key).alias("_k"), order_bucket(F.col(left_ts), ts_type, bucket_days, bucket_size)
                         .alias("_b"), F.lit(None).cast(f"struct<t:{dict(right.dtypes)[right_ts]},i:bigint>").alias("_o"),
                         F.lit(None).cast(payload_type(right, rc)).alias("_p")))
        given = right.select(F.col(key).alias("_k"), order_bucket(F.col(right_ts), ts_type, bucket_days, bucket_size)
                             .alias("_b"), F.struct(F.col(right_ts).alias("t"), tie_col.alias("i")).alias("_o"),
                             payload.alias("_p"))
        before = Window.partitionBy("_ck").orderBy("_cb").rowsBetween(Window.unboundedPreceding, -1)
        carry = (asked.unionByName(given).groupBy(F.col("_k").alias("_ck"), F.col("_b").alias("_cb"))
                 .agg(F.max_by("_p", "_o").alias("_last"))
                 .select("_ck", "_cb", F.last("_last", ignorenulls=True).over(before).alias("_carry")))
        out = (rows.join(carry, (F.col("_k") == F.col("_ck")) & (F.col("_b") == F.col("_cb")), "left")
               .withColumn("_m", F.coalesce("_m", "_carry")))
    return out.select(*lcols, *[F.col("_m")[c].alias(prefix + c) for c in rc])


def payload_type(df: DataFrame, cols: Sequence[str]) -> str:
    types = dict(df.dtypes)
    return "struct<" + ",".join(f"`{c}`:{types[c]}" for c in cols) + ">"


def trailing_window(df: DataFrame, key: str | Sequence[str], ts: str, aggs: dict[str, Column], days: float,
                    include_current: bool = False, bucket_days: float | None = None) -> DataFrame:
    """Add ``aggs`` evaluated over the key's rows in ``[ts - days, ts)``.

    ``include_current=False`` ends the frame 1 microsecond before the row, so
    the row itself and rows at the same instant are excluded (no leakage).
    An empty frame gives the aggregate of no rows (``avg`` -> NULL, not 0).
    """
    width = int(days * MICROS_PER_DAY)
    upper = 0 if include_current else -1
    bw = int((bucket_days or days) * MICROS_PER_DAY)
    halo = -(-width // bw)          # context copies needed so that halo * bucket width >= window width
    b = _bucket(F.col(ts), bw)
    # one pass: each row yields itself (target, bucket b) and context copies in buckets b+1 .. b+halo
    copies = F.explode(F.array(*[F.struct((b + i).alias("b"), F.lit(i == 0).alias("t")) for i in range(halo + 1)]))
    u = (df.withColumn("_us", F.unix_micros(F.col(ts))).withColumn("_c", copies)
         .withColumn("_b", F.col("_c.b")).withColumn("_target", F.col("_c.t")).drop("_c"))
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys, "_b").orderBy("_us").rangeBetween(-width, upper)
    out = u.withColumns({name: agg.over(w) for name, agg in aggs.items()})
    return out.filter("_target").drop("_us", "_b", "_target")


def trailing_sums(targets: DataFrame, facts: DataFrame | None, keys: str | Sequence[str], ts: str, fact_ts: str,
                  values: dict[str, Column], days: float, bucket_days: float | None = None) -> DataFrame:
    """``targets`` with, per name in ``values``, the sum over the key's ``facts`` in ``[ts - days, ts)``.

    Without ``facts`` the targets are the facts as well (each then crosses the shuffle twice, not three times).

    Running sums instead of frames: a fact adds its values from its own time on and takes them off again ``days``
    later, so a target reads the sum of everything before it.  Inside ``(key, bucket)`` that is one window; whole
    earlier buckets come from their totals (aggregated on the map side, keys x buckets rows).  Buckets are as wide as the
    window and may be as narrow as a hot key needs, at no further copies but more totals.  ``values`` are integers (counts, flags; cast to BIGINT), so taking off is
    exact; a NULL value counts 0, an empty frame sums to 0, and a NULL key or time has nothing before it.
    """
    kc = [keys] if isinstance(keys, str) else list(keys)
    names = list(values)
    width, bw = int(days * MICROS_PER_DAY), int((bucket_days or days) * MICROS_PER_DAY)
    own = facts is None
    facts, fact_ts = (targets, ts) if own else (facts, fact_ts)
    kn, vn = [f"_k{i}" for i in range(len(kc))], [f"_v{i}" for i in range(len(names))]
    known = F.col(fact_ts).isNotNull()
    for k in kc:
        known = known & F.col(k).isNotNull()
    zero = F.lit(0).cast("bigint")
    amounts = [F.coalesce(F.when(known, v.cast("bigint")), zero) for v in values.values()]
    moves_of = F.explode(F.array(*[
        F.struct((F.unix_micros(F.col(fact_ts)) + shift).alias("us"), *[(v * sign).alias(n) for n, v in zip(vn, amounts)])
        for shift, sign in ([] if own else [(0, 1)]) + [(width, -1)]]))
    moves = (facts.filter(known).select(*[F.col(k).alias(n) for k, n in zip(kc, kn)], moves_of.alias("_e"))
             .select(*kn, F.col("_e.us").alias("_us"), *[F.col(f"_e.{n}").alias(n) for n in vn]))
    tgt = targets.select(*[F.col(k).alias(n) for k, n in zip(kc, kn)], F.unix_micros(F.col(ts)).alias("_us"),
                         *[(v if own else zero).alias(n) for n, v in zip(vn, amounts)],
                         F.struct(*targets.columns).alias("_row"))
    u = (tgt.unionByName(moves, allowMissingColumns=True)
         .withColumn("_b", F.floor(F.col("_us") / F.lit(bw)).cast("bigint")))
    w = Window.partitionBy(*kn, "_b").orderBy("_us").rangeBetween(Window.unboundedPreceding, -1)
    rows = u.withColumns({f"_s{i}": F.sum(v).over(w) for i, v in enumerate(vn)}).filter(F.col("_row").isNotNull())
    # totals of earlier buckets, for the buckets that targets or moves are in
    spots = (tgt.drop("_row").unionByName(moves).dropna(subset=[*kn, "_us"])
             .groupBy(*[F.col(k).alias(f"_c{k}") for k in kn], F.floor(F.col("_us") / F.lit(bw)).cast("bigint").alias("_cb"))
             .agg(*[F.sum(v).alias(v) for v in vn]))
    before = Window.partitionBy(*[f"_c{k}" for k in kn]).orderBy("_cb").rowsBetween(Window.unboundedPreceding, -1)
    carry = spots.select(*[f"_c{k}" for k in kn], "_cb",
                         *[F.sum(v).over(before).alias(f"_c{v}") for v in vn])
    on = F.col("_b") == F.col("_cb")
    for k in kn:
        on = on & (F.col(k) == F.col(f"_c{k}"))
    return (rows.join(carry, on, "left")
            .select("_row.*", *[(F.coalesce(f"_s{i}", zero) + F.coalesce(f"_c{v}", zero)).alias(n)
                                for i, (n, v) in enumerate(zip(names, vn))]))


def trailing_grains(targets: DataFrame, facts: DataFrame, grains: dict[str, Sequence[str]], ts: str, fact_ts: str,
                    values: dict[str, Column], days: float, bucket_days: float | None = None,
                    rates: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """``targets`` with, per grain and name in ``values``, the sum over that grain's ``facts`` in ``[ts - days, ts)``.

    ``grains``: name -> key columns, which both sides have; columns are named ``<grain>_<name>``. All grains share one
    pass: facts and the instants that targets ask for are summed per (grain, key, instant), combined on the map side, so what
    is shuffled and sorted is bounded by the instants of each key, however many rows one of them has. Running sums over
    these (see :func:`trailing_sums`) are then looked up by key and instant. NULL keys and times have nothing before them;
    values are integers. ``rates``: name -> (upper, lower) of ``values``, their quotient rounded to six digits and NULL where
    the lower is 0, worked out once per key and instant.
    """
    width, bw = int(days * MICROS_PER_DAY), int((bucket_days or days) * MICROS_PER_DAY)
    names, zero = list(values), F.lit(0).cast("bigint")
    vn = [f"_v{i}" for i in range(len(names))]
    kn = {c: f"_k{i}" for i, c in enumerate(dict.fromkeys(c for cols in grains.values() for c in cols))}
    # grains of the same columns share a grouping set; a set has the columns that its grains lack as NULL
    sets = list(dict.fromkeys(tuple(n for c, n in kn.items() if c in cols) for cols in grains.values()))
    at_set = {g: sets.index(tuple(n for c, n in kn.items() if c in cols)) for g, cols in grains.items()}

    def dated(df: DataFrame, at: str, amounts: Sequence[Column], asked: bool) -> DataFrame:
        return df.where(F.col(at).isNotNull()).select(F.unix_micros(F.col(at)).alias("_us"), *[F.col(c).alias(n) for c, n in kn.items()],
                                                      *[a.alias(n) for n, a in zip(vn, amounts)], F.lit(asked).alias("_asked"))

    sums = [F.sum(v).alias(v) for v in vn]
    both = dated(facts, fact_ts, [F.coalesce(v.cast("bigint"), zero) for v in values.values()], False).unionByName(
        dated(targets, ts, [zero] * len(vn), True))
    groups = [*kn.values(), "_us"]
    instants = both.groupingSets([[F.col(n) for n in (*s, "_us")] for s in sets], *[F.col(n) for n in groups]).agg(
        *sums, F.max("_asked").alias("_asked"), F.grouping_id().alias("_gid"))
    which, whole = F.lit(None).cast("int"), F.lit(False)
    for i, s in enumerate(sets):
        # the bits of a grouping id tell, first column first, which columns are not in the set
        here = F.col("_gid") == int("".join("0" if n in (*s, "_us") else "1" for n in groups), 2)
        keyed = here
        for n in s:
            keyed = keyed & F.col(n).isNotNull()
        which, whole = F.when(here, i).otherwise(which), whole | keyed
    instants = materialize(instants.where(whole).select(which.alias("_g"), F.struct(*kn.values()).alias("_k"), "_us", *vn, "_asked"),
                           "instants")
    moves = instants.select("_g", "_k", F.explode(F.array(
        F.struct("_us", *vn, "_asked"),
        F.struct((F.col("_us") + width).alias("_us"), *[(-F.col(v)).alias(v) for v in vn], F.lit(False).alias("_asked")))).alias("_e"))
    moves = moves.select("_g", "_k", "_e.*").where("_asked OR " + " OR ".join(f"{v} <> 0" for v in vn))
    moves = moves.withColumn("_b", F.floor(F.col("_us") / F.lit(bw)).cast("bigint"))
    w = Window.partitionBy("_g", "_k", "_b").orderBy("_us").rangeBetween(Window.unboundedPreceding, -1)
    rows = moves.withColumns({f"_s{i}": F.sum(v).over(w) for i, v in enumerate(vn)}).where("_asked")
    before = Window.partitionBy("_cg", "_ck").orderBy("_cb").rowsBetween(Window.unboundedPreceding, -1)
    carry = moves.groupBy(F.col("_g").alias("_cg"), F.col("_k").alias("_ck"), F.col("_b").alias("_cb")).agg(*sums).select(
        "_cg", "_ck", "_cb", *[F.sum(v).over(before).alias(f"_c{i}") for i, v in enumerate(vn)])
    known = rows.join(carry, (F.col("_g") == F.col("_cg")) & (F.col("_k") == F.col("_ck")) & (F.col("_b") == F.col("_cb")))
    known = known.select("_g", "_k.*", "_us", *[(F.coalesce(f"_s{i}", zero) + F.coalesce(f"_c{i}", zero)).alias(v)
                                                for i, v in enumerate(vn)])
    of = dict(zip(names, vn))
    known = known.withColumns({f"_r{i}": F.round(F.when(F.col(of[low]) > 0, F.col(of[up]) / F.col(of[low])), 6)
                               for i, (up, low) in enumerate((rates or {}).values())})
    known = materialize_by(known, "running-sums", "_g", range(len(sets)))
    out = targets
    for grain, cols in grains.items():
        here = known[at_set[grain]]
        got = {**{f"{grain}_{n}": F.coalesce(F.col(f"_j{v}"), zero) for n, v in of.items()},
               **{f"{grain}_{n}": F.col(f"_j_r{i}") for i, n in enumerate(rates or {})}}
        here = here.select(*[F.col(c).alias(f"_j{c}") for c in here.columns])
        on = F.unix_micros(F.col(ts)) == F.col("_j_us")
        for c in cols:
            on = on & (F.col(c) == F.col(f"_j{kn[c]}"))
        out = out.join(here, on, "left").withColumns(got).drop(*here.columns)
    return out


def held_values(daily: DataFrame, key: str, day: str, value: str, end) -> DataFrame:
    """Each value of a daily series on every day from its own to the one before the key's next value, the last to ``end``.

    One window over the series (a key has a row per day at most) and a generator; no calendar is joined.
    """
    seen = daily.where(F.col(key).isNotNull() & F.col(day).isNotNull() & F.col(value).isNotNull())
    until = F.coalesce(F.date_sub(F.lead(day).over(Window.partitionBy(key).orderBy(day)), 1), F.lit(end).cast("date"))
    rows = seen.select(key, F.col(day).alias("_from"), until.alias("_until"), value).where("_until >= _from")
    return rows.select(key, F.explode(F.sequence("_from", "_until")).alias(day), value)


def day_spine(keys: DataFrame, key: str, start, end, day_col: str = "day") -> DataFrame:
    """One row per key and calendar day in ``[start, end]`` (a generator, not a join)."""
    s = F.lit(str(start)).cast("date")
    e = F.lit(str(end)).cast("date")
    return keys.select(key).distinct().select(key, F.explode(F.sequence(s, e)).alias(day_col))


def forward_fill(daily: DataFrame, key: str, day: str, value: str, start=None, end=None,
                 keys: DataFrame | None = None) -> DataFrame:
    """Daily series on a full calendar spine with last-observation-carried-forward.

    The input is already one row per (key, day) — e.g. a daily aggregate — so
    each key's window holds at most one row per calendar day (bounded).
    The calendar runs from ``start`` to ``end``; where one is None, from the first or to the last day of the data
    (a one-row aggregate, run when called). A leading gap stays NULL; ``is_filled`` marks carried values. With the data's own
    range and keys no calendar is joined: each row yields the days up to the key's next one, the first also those before it.
    """
    if start is None and end is None and keys is None:
        return _filled_from_rows(daily.where(F.col(day).isNotNull()), key, day, value)
    if start is None or end is None:
        lo, hi = daily.agg(F.min(day), F.max(day)).first()
        # without any day there is nothing to fill
        start, end = start or lo or end or "1970-01-01", end or hi or start or "1970-01-01"
    spine = day_spine(keys if keys is not None else daily, key, start, end, day)
    j = spine.join(daily.select(key, day, value), [key, day], "left")
    w = Window.partitionBy(key).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.last(F.col(value), ignorenulls=True).over(w)
    return (j.withColumn(f"{value}_filled", filled)
            .withColumn("is_filled", F.col(value).isNull() & F.col(f"{value}_filled").isNotNull()))


def _filled_from_rows(daily: DataFrame, key: str, day: str, value: str) -> DataFrame:
    lo, hi = daily.agg(F.min(day), F.max(day)).first()
    w = Window.partitionBy(key).orderBy(day)
    held = F.last(F.col(value), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    begin = F.when(F.lag(day).over(w).isNull(), F.lit(lo).cast("date")).otherwise(F.col(day))
    until = F.coalesce(F.date_sub(F.lead(day).over(w), 1), F.lit(hi).cast("date"))
    rows = daily.select(key, F.col(day).alias("_own"), F.col(value).alias("_v"), held.alias("_held"), begin.alias("_begin"), until.alias("_until"))
    spread = rows.select(key, F.explode(F.sequence("_begin", "_until")).alias(day), "_own", "_v", "_held")
    out = spread.select(key, day, F.when(F.col(day) == F.col("_own"), F.col("_v")).alias(value),
                        F.when(F.col(day) >= F.col("_own"), F.col("_held")).alias(f"{value}_filled"))
    return out.withColumn("is_filled", F.col(value).isNull() & F.col(f"{value}_filled").isNotNull())


def hourly(df: DataFrame, key: str, ts: str, aggs: Sequence[Column], hour_col: str = "hour_ts") -> DataFrame:
    return df.groupBy(key, F.date_trunc("hour", F.col(ts)).alias(hour_col)).agg(*aggs)


def daily_from_hourly(h: DataFrame, key: str, hour_col: str, aggs: Sequence[Column],
                      day_col: str = "day") -> DataFrame:
    return h.groupBy(key, F.to_date(F.col(hour_col)).alias(day_col)).agg(*aggs)
