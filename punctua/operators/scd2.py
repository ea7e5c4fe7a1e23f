"""Type-2 history from change events (CDC), current view and point-in-time lookup.

Rules:
1. duplicate ``(key, seq)`` events are dropped (deterministically);
2. events are ordered by ``seq``, never by arrival;
3. the state of an event is its tracked attributes; a delete has NULL state;
4. an event is kept only if its state differs (NULL-safe) from the previous
   event's state — unchanged updates and repeated deletes collapse;
5. a version is valid on ``[seq, next kept seq)``, the last one is open (NULL);
6. a kept delete closes the previous version and opens none.

The result depends only on the set of events, not on their arrival order or
partitioning.  Event times are carried along (``valid_from_ts``/``valid_to_ts``)
so a non-monotonic clock cannot invert ranges.

Skew: with ``seq_bucket`` set, the lag/lead windows run per ``(key, seq
bucket)`` and only the first/last row of each bucket looks across the
boundary, through a per-bucket summary (keys x buckets rows) — a key holding
a third of all events is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.session import materialize


def scd2_from_cdc(cdc: DataFrame, key: str, seq: str, ts: str, state_cols: Sequence[str],
                  is_delete: Column, seq_bucket: int | None = None) -> DataFrame:
    sc = list(state_cols)
    state = F.when(~F.coalesce(is_delete, F.lit(False)), F.struct(*[F.col(c) for c in sc]))
    ev = cdc.select(F.col(key).alias("_k"), F.col(seq).alias("_seq"), F.col(ts).alias("_ts"),
                    state.alias("_s"))
    part = ["_k"]
    if seq_bucket:
        ev = ev.withColumn("_b", F.floor(F.col("_seq") / F.lit(seq_bucket)).cast("bigint"))
        part = ["_k", "_b"]
    # one shuffle on (key, bucket): the dedup aggregate, both windows and the
    # per-bucket summaries all reuse this partitioning.  With buckets, a group
    # holds at most ``seq_bucket`` events, so a hot key cannot overload a task.
    ev = ev.repartition(*part)
    # (1) one event per (key, seq): the smallest (state, ts) wins, order independent
    ev = (ev.groupBy(*part, "_seq").agg(F.min(F.struct("_s", "_ts")).alias("_r"))
          .select(*part, "_seq", F.col("_r._s").alias("_s"), F.col("_r._ts").alias("_ts")))
    w = Window.partitionBy(*part).orderBy("_seq")
    # wrap the state so "no previous event" (NULL) differs from "previous was a delete" (struct(NULL))
    prev = F.lag(F.struct(F.col("_s").alias("s")), 1).over(w)
    ev = ev.withColumn("_prev", prev)
    if seq_bucket:
        last_in_b = (ev.groupBy("_k", "_b").agg(F.max_by(F.struct(F.col("_s").alias("s")), "_seq").alias("_lb"))
                     .withColumn("_carry", F.lag("_lb", 1).over(Window.partitionBy("_k").orderBy("_b")))
                     .select("_k", "_b", "_carry"))
        ev = (ev.join(last_in_b, ["_k", "_b"], "left")
              .withColumn("_prev", F.coalesce("_prev", "_carry")).drop("_carry"))
    changed = ~F.col("_prev.s").eqNullSafe(F.col("_s"))
    kept = ev.filter(changed)
    nxt = F.lead(F.struct(F.col("_seq").alias("seq"), F.col("_ts").alias("ts")), 1).over(
        Window.partitionBy(*part).orderBy("_seq"))
    kept = kept.withColumn("_next", nxt)
    if seq_bucket:
        first_in_b = (kept.groupBy("_k", "_b")
                      .agg(F.min(F.struct(F.col("_seq").alias("seq"), F.col("_ts").alias("ts"))).alias("_fb"))
                      .withColumn("_after", F.lead("_fb", 1).over(Window.partitionBy("_k").orderBy("_b")))
                      .select("_k", "_b", "_after"))
        kept = (kept.join(first_in_b, ["_k", "_b"], "left")
                .withColumn("_next", F.coalesce("_next", "_after")).drop("_after"))
    versions = kept.filter(F.col("_s").isNotNull())
    return versions.select(
        F.col("_k").alias(key),
        *[F.col("_s")[c].alias(c) for c in sc],
        F.col("_seq").alias("valid_from_seq"),
        F.col("_next.seq").alias("valid_to_seq"),
        F.col("_ts").alias("valid_from_ts"),
        F.col("_next.ts").alias("valid_to_ts"),
        F.col("_next").isNull().alias("is_current"),
    )


def scd2_current_state(cdc: DataFrame, key: str, seq: str, ts: str, state_cols: Sequence[str], is_delete: Column) -> DataFrame:
    """The open versions of :func:`scd2_from_cdc` without its history: no window, no sort of a key's events.

    A key's last state, the last event that differs from it, and the first event after that are aggregates, combined on the
    map side, so a hot key costs its tasks a row each. Keys whose last event is a delete have no row.
    """
    sc = list(state_cols)
    state = F.when(~F.coalesce(is_delete, F.lit(False)), F.struct(*[F.col(c) for c in sc]))
    ev = cdc.select(F.col(key).alias("_k"), F.col(seq).alias("_seq"), F.col(ts).alias("_ts"), state.alias("_s")).where("_seq IS NOT NULL")
    # one event per (key, seq), as in the history
    once = ev.groupBy("_k", "_seq").agg(F.min(F.struct("_s", "_ts")).alias("_r"))
    ev = materialize(once.select("_k", "_seq", F.col("_r._s").alias("_s"), F.col("_r._ts").alias("_ts")), "events-once")
    # tables of their own, a row per key: small ones are broadcast by their size, and a hot key can be split in the joins
    last = ev.groupBy(F.col("_k").alias("_lk")).agg(F.max_by(F.struct(F.col("_s").alias("s")), "_seq").alias("_last"))
    last = materialize(last.where("_last.s IS NOT NULL"), "last-states")
    same_key = F.col("_k").eqNullSafe(F.col("_lk"))
    differs = F.when(~F.col("_s").eqNullSafe(F.col("_last.s")), F.col("_seq"))
    turn = materialize(ev.join(last, same_key).groupBy("_lk").agg(F.max(differs).alias("_turn")), "last-changes")
    start = (ev.join(turn, same_key).where("_turn IS NULL OR _seq > _turn").groupBy("_lk")
             .agg(F.min(F.struct("_seq", "_ts")).alias("_from"), F.any_value("_s").alias("_s")))
    types = dict(cdc.dtypes)
    return start.select(
        F.col("_lk").alias(key), *[F.col("_s")[c].alias(c) for c in sc], F.col("_from._seq").alias("valid_from_seq"),
        F.lit(None).cast(types[seq]).alias("valid_to_seq"), F.col("_from._ts").alias("valid_from_ts"),
        F.lit(None).cast(types[ts]).alias("valid_to_ts"), F.lit(True).alias("is_current"))


def current_view(versions: DataFrame) -> DataFrame:
    """SCD1-style current row per key (open versions only)."""
    return versions.filter(F.col("is_current"))


def scd2_rebuild_touched(log: DataFrame, versions: DataFrame, batch: DataFrame, key: str, seq: str, ts: str,
                         state_cols: Sequence[str], is_delete, seq_bucket: int | None = None) -> DataFrame:
    """Incremental step for a CDC stream (use inside ``foreachBatch``).

    Only keys present in the new batch are recomputed, from the full event log
    of those keys (so late, out-of-order events re-open closed ranges
    correctly); all other keys keep their versions.
    """
    touched = batch.select(key).distinct()
    relog = log.join(touched, key, "left_semi")
    fresh = scd2_from_cdc(relog, key, seq, ts, state_cols, is_delete(relog) if callable(is_delete) else is_delete,
                          seq_bucket)
    return versions.join(touched, key, "left_anti").unionByName(fresh)
