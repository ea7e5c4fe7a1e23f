"""What the operators on ``embeddings`` share: which rows count, padding, and Arrow lists as matrices.

A vector counts if it is not null and holds no null and no non-finite component. A shorter vector counts as
padded with zeros to the longest one. A null ``vec_id`` sorts after every other one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.llm.common import LAST_ID


def finite(vector: Column) -> Column:
    """True for a vector without null, NaN and infinite components; false for a null vector."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad, F.lit(False))


def vector(df: DataFrame) -> tuple[Column, str]:
    """The vector column as floats or doubles, and which of them."""
    kind = df.schema["embedding"].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    return F.col("embedding").cast(f"array<{kind}>"), kind


def key() -> Column:
    return F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST_ID)).alias("k_id")


def left_out(df: DataFrame) -> DataFrame:
    """k_id of the rows whose vector does not count."""
    return df.where(~finite(vector(df)[0])).select(key())


def dense(df: DataFrame, *keep: str, multiple: int = 1) -> tuple[DataFrame, int]:
    """k_id (null last), the ``keep`` columns and ``v`` (padded) of the rows whose vector counts; the common length.

    The length is rounded up to a ``multiple``.
    """
    v, kind = vector(df)
    rows = df.where(finite(v)).select(key(), *keep, v.alias("v"))
    least, most = rows.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    width = -(-max(most or 0, 1) // multiple) * multiple
    if least != width:
        rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast(kind), F.lit(width) - F.size("v"))))
    return rows, width


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Arrow lists of ``width`` numbers as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, width)
