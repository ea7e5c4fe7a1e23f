"""Physical layout of gold tables for partition and file pruning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_clustered(df: DataFrame, path: str, partition_by: Sequence[str], cluster_by: Sequence[str],
                    max_records_per_file: int = 5_000_000, mode: str = "overwrite") -> None:
    """Write a fact partitioned by ``partition_by`` (e.g. month) and clustered by
    ``cluster_by`` (e.g. route) inside each file.

    ``repartitionByRange`` samples the keys, so a hot month is split across
    several tasks instead of landing in one; sorting inside partitions keeps
    parquet min/max statistics tight, so filters on the clustering columns
    skip row groups.  Dynamic partition overwrite replaces only the months
    present in ``df``.
    """
    keys = list(partition_by) + list(cluster_by)
    (df.repartitionByRange(*keys)
     .sortWithinPartitions(*keys)
     .write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*partition_by)
     .parquet(path))


def quantile_place(c: Column, splits: Sequence[float]) -> Column:
    """How many of the sorted ``splits`` are at most ``c``, by halving: nested conditions, as deep as the splits have bits."""
    def place(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c >= F.lit(splits[mid]), place(mid + 1, hi)).otherwise(place(lo, mid))

    return F.coalesce(place(0, len(splits)), F.lit(0))


def interleaved(places: Sequence[Column], bits: int) -> Column:
    """The bits of all ``places`` in turn, highest first: rows near in every dimension get near numbers."""
    out, n = F.lit(0).cast("long"), len(places)
    for b in range(bits):
        for i, p in enumerate(places):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(p.cast("long"), b).bitwiseAND(F.lit(1)), b * n + n - 1 - i))
    return out


def write_interleaved(df: DataFrame, path: str, dimensions: Sequence[Column], files: int, bits: int = 5, partition_by: Sequence[str] = (),
                      max_records_per_file: int = 5_000_000, mode: str = "overwrite") -> None:
    """Write ``df`` so that filters on any one of the numeric ``dimensions`` skip files and row groups.

    Each dimension is cut at 2^bits - 1 approximate quantiles (a bounded aggregate, so skew does not empty cells), the cell
    numbers are bit-interleaved, and files are ranges of that number; hot cells are split by the dimensions themselves.
    """
    names = [f"_d{i}" for i in range(len(dimensions))]
    rows = df.withColumns({n: d.cast("double") for n, d in zip(names, dimensions)})
    at = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = rows.agg(*[F.percentile_approx(n, at, 10_000).alias(n) for n in names]).first()
    places = [quantile_place(F.col(n), sorted(set(cuts[n] or []))) for n in names]
    rows = rows.withColumn("_cell", interleaved(places, bits))
    keys = [*partition_by, "_cell", *names]
    out = rows.repartitionByRange(files, *keys).sortWithinPartitions(*keys).drop("_cell", *names)
    writer = out.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_records_per_file)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
