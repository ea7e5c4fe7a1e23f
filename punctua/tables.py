"""Load the driver tables.

Parquet scans stay lazy so Catalyst prunes columns and pushes filters into
the scan.  TIMESTAMP_NTZ columns are re-typed as (UTC) TIMESTAMP so that
epoch arithmetic, watermarks and range frames work; with a UTC session clock
this keeps the wall-clock value unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.session import ensure_utc

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return to_utc_timestamps(df)


def to_utc_timestamps(df: DataFrame) -> DataFrame:
    ntz = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    if not ntz:
        return df
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz})


def to_wall_clock(df: DataFrame) -> DataFrame:
    """Inverse of :func:`to_utc_timestamps` for result frames (naive datetimes)."""
    ts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    if not ts:
        return df
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ts})


class Tables:
    """Attribute access to the driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return load(self.spark, self.sf_dir, name)
        raise AttributeError(name)
