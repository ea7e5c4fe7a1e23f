"""Bronze -> silver with a side output for late rows, written as they arrive.

The state-store path (:mod:`punctua.streaming.silver`) drops rows below the watermark and only counts them. Here every
micro-batch is split in ``foreachBatch`` by a watermark of its own making, so no row is lost on the way:

* the watermark of a batch is the largest event time of all batches before it minus the table's delay; what the batches
  have seen is a small table (one row per batch), so a restart or a retry finds the same watermark;
* rows at or below it go to ``<table>_late``, as they are;
* of the others the first one per business key and validity is kept, if no earlier batch wrote that key within the delay
  (``left_anti`` on the outputs, whose files below the horizon are skipped by their statistics);
* valid rows go to ``<table>``, failing ones to ``<table>_quarantine``; a row without an event time cannot be placed
  against the watermark and is quarantined under ``event_time_known``, once per key and batch;
* ``<table>_flow`` has the counts of each batch: rows = late + duplicates + valid + quarantine.

All outputs are ``batch=<id>`` folders in overwrite mode, so a retried batch replaces its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from punctua.operators.quality import all_pass, failed_rules
from punctua.operators.standardize import standardize
from punctua.session import materialize
from punctua.sources import hadoopfs as hfs
from punctua.sources.ingest import bronze_schema
from punctua.streaming.silver import VALID_FLAG, SilverTable

NO_TIME_RULE = "event_time_known"


def event_time(table: SilverTable) -> Column:
    return F.col(table.event_time).cast("timestamp")


def before(df: DataFrame, batch_id: int) -> DataFrame:
    """What batches other than this one wrote (a retry may find its own first attempt)."""
    return df.where(F.col("batch").cast("string") != F.lit(str(batch_id)))


def watermark_of(spark: SparkSession, seen: str, batch_id: int, delay: str) -> Column:
    """The watermark of a batch as a literal; null before any event time was seen."""
    top = None
    if hfs.exists(spark, seen):
        schema = T.StructType([T.StructField("top", T.TimestampType()), T.StructField("batch", T.LongType())])
        # one row per batch; a micros value keeps the driver's time zone out
        top = spark.read.schema(schema).parquet(seen).where(F.col("batch") < batch_id).agg(F.max(F.unix_micros("top"))).first()[0]
    return F.timestamp_micros(F.lit(top).cast("long")) - F.expr(f"interval {delay}")


def first_per_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """First arrival of the batch per key and validity: by ingest time, then file, then a hash of the row."""
    order = [F.col(c) for c in ("_ingested_at", "_source_file") if c in rows.columns] + [F.xxhash64(*rows.columns)]
    place = F.row_number().over(Window.partitionBy(*keys, VALID_FLAG).orderBy(*order))
    return rows.withColumn("_rn", place).where("_rn = 1").drop("_rn")


def unseen(spark: SparkSession, rows: DataFrame, table: SilverTable, out: str, batch_id: int, horizon: Column) -> DataFrame:
    """``rows`` whose key no earlier batch wrote with the same validity and an event time after ``horizon``."""
    keys = list(table.keys)
    types = {f.name: f for f in rows.schema.fields}
    wanted = list(dict.fromkeys([*keys, table.event_time]))
    schema = T.StructType([*[types[c] for c in wanted], T.StructField("batch", T.StringType())])
    for name, valid in ((table.name, True), (table.quarantine_name, False)):
        if hfs.list_files(spark, f"{out}/{name}", "*.parquet"):
            old = before(spark.read.schema(schema).parquet(f"{out}/{name}"), batch_id)
            old = old.where(event_time(table) > horizon).select(*[F.col(k).alias(f"_seen{i}") for i, k in enumerate(keys)])
            same = F.col(VALID_FLAG) == F.lit(valid)
            for i, k in enumerate(keys):
                same = same & F.col(k).eqNullSafe(F.col(f"_seen{i}"))
            rows = rows.join(old, same, "left_anti")
    return rows


def apply_split(spark: SparkSession, batch: DataFrame, batch_id: int, table: SilverTable, out: str) -> None:
    """Split one micro-batch of bronze rows into valid, quarantined and late ones."""
    path = lambda name: f"{out}/{name}/batch={batch_id}"
    seen = f"{out}/{table.name}_seen"
    watermark = watermark_of(spark, seen, batch_id, table.watermark)
    t = event_time(table)
    std = standardize(batch, table.spec)
    flagged = std.withColumns({VALID_FLAG: all_pass(table.rules) & t.isNotNull(), "_late": F.coalesce(t <= watermark, F.lit(False))})
    rows = materialize(flagged, f"{table.name}-batch")  # the split, the outputs and the counts read the same rows
    on_time = rows.where("not _late").drop("_late")
    kept = first_per_key(on_time, list(table.keys))
    horizon = F.coalesce(watermark - F.expr(f"interval {table.watermark}"), F.timestamp_micros(F.lit(-(2**62))))
    kept = materialize(unseen(spark, kept, table, out, batch_id, horizon), f"{table.name}-kept")
    no_time = F.when(t.isNull(), F.array(F.lit(NO_TIME_RULE))).otherwise(F.array().cast("array<string>"))
    bad = kept.where(~F.col(VALID_FLAG)).drop(VALID_FLAG).withColumn(
        "_failed_rules", F.concat(F.coalesce(failed_rules(table.rules), F.array().cast("array<string>")), no_time))
    kept.where(VALID_FLAG).drop(VALID_FLAG).write.mode("overwrite").parquet(path(table.name))
    bad.write.mode("overwrite").parquet(path(table.quarantine_name))
    rows.where("_late").drop("_late", VALID_FLAG).write.mode("overwrite").parquet(path(f"{table.name}_late"))
    came = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("_late").alias("late"), F.max(t).alias("top"))
    went = kept.agg(F.count_if(VALID_FLAG).alias("valid"), F.count_if(~F.col(VALID_FLAG)).alias("quarantine"))
    both = came.unionByName(went, allowMissingColumns=True)  # one row and one row
    flow = materialize(both.agg(*[F.max(c).alias(c) for c in both.columns]), f"{table.name}-flow")
    flow.select("rows", "late", (F.col("rows") - F.col("late") - F.col("valid") - F.col("quarantine")).alias("duplicates"),
                "valid", "quarantine").write.mode("overwrite").parquet(path(f"{table.name}_flow"))
    # last: a batch whose outputs are not complete is run again under the same watermark anyway
    flow.select("top").write.mode("overwrite").parquet(f"{seen}/batch={batch_id}")


def run_split_stream(spark: SparkSession, bronze_path: str, table: SilverTable, out_root: str, checkpoint: str,
                     max_files_per_trigger: int | None = None, wait: bool = True) -> StreamingQuery:
    """Stream ``bronze_path`` into the outputs of ``table``, new files once, then stop."""
    reader = spark.readStream.schema(bronze_schema(spark, bronze_path))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = out_root.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            apply_split(spark, batch, batch_id, table, out)

    q = (reader.parquet(bronze_path).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


def read_output(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """An output of :func:`run_split_stream`, with the batch that wrote each row as text."""
    df = spark.read.option("mergeSchema", "true").parquet(f"{out_root.rstrip('/')}/{name}")
    return df.withColumn("batch", F.col("batch").cast("string"))
