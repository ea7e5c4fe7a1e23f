"""Deduplication on business keys, batch and streaming.

Batch: ``row_number() = 1`` per key with an explicit, total order.  Catalyst
turns the rank-1 filter into a partial ``WindowGroupLimit`` *before* the
shuffle, so a hot key is cut to one row per map task first — a key holding
a third of all rows never reaches one reducer whole.

Streaming: ``withWatermark`` + ``dropDuplicatesWithinWatermark`` (first
arrival wins, state bounded by the watermark delay).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per key under ``order`` (e.g. ``F.col('dt').desc()``)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_batch(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Batch twin of the streaming dedup; ``order`` plays the arrival order."""
    return latest_by(df, keys, order)


def dedup_stream(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Incremental dedup within an event-time watermark (streaming frames only).

    Rows whose event time is at or below (max seen in earlier batches - delay)
    are dropped as late.  A DATE event time is watermarked through a helper
    TIMESTAMP column that is removed afterwards.
    """
    dtype = dict(df.dtypes)[event_time]
    if dtype == "date":
        helper = f"_{event_time}_ts"
        return (df.withColumn(helper, F.col(event_time).cast("timestamp"))
                .withWatermark(helper, delay)
                .dropDuplicatesWithinWatermark(list(keys))
                .drop(helper))
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
