"""Continuous change-data-capture into a type-2 history table, partition by partition.

Keys are dealt by hash to ``parts`` partitions, and the event log and the history lie in one folder each per partition
(``<root>/log/part=<p>/batch=<id>``, ``<root>/history/part=<p>``). A streaming query reads change events; each micro-batch
(``foreachBatch``)

1. writes its events to the log of the partitions they belong to (dynamic partition overwrite, so a retried batch
   replaces its own events and nothing else);
2. builds the history of these partitions anew from their log, so late and out-of-order events re-open closed ranges;
3. overwrites these partitions of the history and no other: what a batch reads and writes follows the partitions it
   touches, not the table. Choose ``parts`` so that a partition's log is small next to a batch.

The log alone decides the history, so a batch that fails half-way leaves nothing that its retry does not replace. A
partition with a hot key is split over tasks by sequence buckets when it is built (``seq_bucket``) and by size when it is
written (``REBALANCE``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from punctua.operators.scd2 import scd2_from_cdc
from punctua.sources import hadoopfs as hfs

#: Partitions of a log and its history.
PARTS = 64


def part_of(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(parts)).cast("int")


def read_parts(spark: SparkSession, folder: str, parts: Iterable[int], schema: T.StructType | None = None) -> DataFrame:
    """The given partitions of a table, whose other folders are not even listed."""
    reader = spark.read.option("basePath", folder)
    return (reader.schema(schema) if schema is not None else reader).parquet(*[f"{folder}/part={p}" for p in sorted(parts)])


def overwrite_parts(df: DataFrame, folder: str, *by: str) -> None:
    df.write.partitionBy(*by).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(folder)


def apply_batch(spark: SparkSession, batch: DataFrame, batch_id: int, root: str, key: str, seq: str, ts: str,
                state_cols: Sequence[str], is_delete: Callable[[], Column], seq_bucket: int | None = None,
                parts: int = PARTS) -> list[int]:
    """Take one micro-batch of events into log and history; returns the partitions it touched."""
    log, history = f"{root}/log", f"{root}/history"
    overwrite_parts(batch.withColumns({"part": part_of(key, parts), "batch": F.lit(batch_id).cast("long")}), log, "part", "batch")
    schema = T.StructType([*batch.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("batch", T.LongType())])
    # what the batch touched is read back: the source is evaluated once
    here = [p for p in range(parts) if hfs.exists(spark, f"{log}/part={p}/batch={batch_id}")]
    if not here:
        return []
    events = read_parts(spark, log, here, schema).select(*batch.columns)
    fresh = scd2_from_cdc(events, key, seq, ts, state_cols, is_delete(), seq_bucket)
    fresh = fresh.withColumns({"part": part_of(key, parts), "batch": F.lit(batch_id).cast("long")})
    overwrite_parts(fresh.hint("rebalance", "part"), history, "part")
    # a partition that has no version any more was not overwritten
    left = [p for p in here if hfs.exists(spark, f"{history}/part={p}")]
    if left:
        for r in read_parts(spark, history, left).where(F.col("batch") != batch_id).select("part").distinct().collect():
            hfs.delete(spark, f"{history}/part={r['part']}")
    return here


def run_cdc_stream(spark: SparkSession, events: DataFrame, root: str, checkpoint: str, key: str, seq: str,
                   ts: str, state_cols: Sequence[str], is_delete: Callable[[], Column],
                   trigger: dict | None = None, seq_bucket: int | None = None, wait: bool = True,
                   parts: int = PARTS) -> StreamingQuery:
    root = root.rstrip("/")

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_batch(spark, batch, batch_id, root, key, seq, ts, state_cols, is_delete, seq_bucket, parts)

    w = events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    q = w.start()
    if wait:
        q.awaitTermination()
    return q


def read_history(spark: SparkSession, root: str) -> DataFrame | None:
    """The history of all partitions; none before the first version."""
    folder = f"{root.rstrip('/')}/history"
    if not hfs.list_files(spark, folder, "*.parquet"):
        return None
    return spark.read.parquet(folder).drop("part", "batch")
