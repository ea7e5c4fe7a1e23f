"""Array helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zip_parallel_arrays(df: DataFrame, driver: str, others: Sequence[str],
                        keep: Sequence[str] = (), pos_col: str | None = None) -> DataFrame:
    """Turn parallel arrays into rows, one per element of ``driver``.

    The ``driver`` array decides the row count; a shorter or missing companion
    array yields NULL for the positions it lacks (``get`` is NULL-safe out of
    range).  ``arrays_zip`` is deliberately not used: it pads to the *longest*
    array and would invent rows.
    """
    pos = pos_col or "_pos"
    exploded = df.select(*keep, *others, F.posexplode(F.col(driver)).alias(pos, driver))
    out = exploded.select(
        *keep,
        *([pos] if pos_col else []),
        driver,
        *[F.get(F.col(o), F.col(pos)).alias(o) for o in others],
    )
    return out
