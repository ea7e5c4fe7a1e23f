"""Landing-zone writers (the layouts the bronze scans expect)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json_lines(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "append") -> None:
    """JSON Lines files under ``key=value/`` folders (one object per line)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def write_daily_snapshot(df: DataFrame, path: str, day, fmt: str = "csv") -> None:
    """Store a full snapshot under ``dt=YYYY-MM-DD/``; re-writing the same day
    replaces only that day (dynamic partition overwrite)."""
    snap = df.withColumn("dt", F.lit(str(day)))
    (snap.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", "true")
     .partitionBy("dt").format(fmt).save(path))
