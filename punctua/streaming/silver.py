"""Bronze -> silver as Structured Streaming: standardise, validate, dedup
within an event-time watermark, and write valid + quarantine outputs from one
query (one scan, one dedup state) with ``foreachBatch``.

Order: by default rows are validated first and deduplicated on
``keys + validity``, so an invalid first arrival cannot hide a later valid
row with the same key (``dedup_first=True`` reproduces the dedup-then-validate
order, where it can).  Late rows (event time at or below the watermark of
earlier batches) are dropped from both outputs; their count is reported.

Idempotence: each micro-batch writes ``<out>/<table>/batch=<id>`` in
overwrite mode, so a retried batch replaces its own output; the checkpoint
makes the whole run exactly-once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from punctua.operators.dedup import dedup_stream, latest_by
from punctua.operators.quality import Expectation, all_pass, expectation_metrics, failed_rules
from punctua.operators.standardize import StandardizeSpec, as_column, standardize
from punctua.session import materialize
from punctua.sources.ingest import bronze_schema, read_bronze

VALID_FLAG = "_valid"


@dataclass(frozen=True)
class SilverTable:
    name: str
    spec: StandardizeSpec
    keys: Sequence[str]
    rules: Sequence[Expectation]
    event_time: str | None = None
    watermark: str | None = None
    # batch tables keep the first row per key by this order (Columns or callables returning one)
    latest_order: Sequence = field(default_factory=tuple)
    dedup_first: bool = False

    @property
    def quarantine_name(self) -> str:
        return f"{self.name}_quarantine"

    @property
    def metrics_name(self) -> str:
        return f"{self.name}_dq_metrics"


def silver_frame(df: DataFrame, table: SilverTable) -> DataFrame:
    """Standardised, flagged (``_valid``) and deduplicated frame (stream or batch)."""
    std = standardize(df, table.spec)
    ok = all_pass(table.rules)
    keys = list(table.keys)
    if df.isStreaming:
        if table.dedup_first:
            return dedup_stream(std, keys, table.event_time, table.watermark).withColumn(VALID_FLAG, ok)
        return dedup_stream(std.withColumn(VALID_FLAG, ok), keys + [VALID_FLAG], table.event_time, table.watermark)
    # batch order: the table's own "latest" order (e.g. snapshot date), else first
    # arrival like the stream (ingest time, then file path)
    order = [as_column(o) for o in table.latest_order]
    if order and "_source_file" in std.columns:
        order.append(F.col("_source_file").desc())
    if not order:
        order = [F.col(c).asc() for c in ("_ingested_at", "_source_file") if c in std.columns]
    if not order:
        raise ValueError(f"{table.name}: rows have neither lineage columns nor a latest_order to choose the first by")
    if table.dedup_first:
        return latest_by(std, keys, order).withColumn(VALID_FLAG, ok)
    return latest_by(std.withColumn(VALID_FLAG, ok), keys + [VALID_FLAG], order)


def check_fail_rules(frame: DataFrame, table: SilverTable) -> None:
    """Stop before anything is written when a ``fail`` rule is violated (one aggregate)."""
    fail = [r for r in table.rules if r.action == "fail"]
    if not fail:
        return
    row = frame.agg(*[F.count_if(~r.passed).alias(r.name) for r in fail]).first()
    broken = {r.name: row[r.name] for r in fail if row[r.name]}
    if broken:
        raise ValueError(f"{table.name}: fail expectations violated {broken}")


def write_metrics(frame: DataFrame, table: SilverTable, path: str) -> None:
    """Rows passing / failing each rule (warn rules included), one small aggregate per write."""
    expectation_metrics(frame, table.rules).write.mode("overwrite").parquet(path)


def split_outputs(frame: DataFrame, table: SilverTable) -> tuple[DataFrame, DataFrame]:
    valid = frame.filter(F.col(VALID_FLAG)).drop(VALID_FLAG)
    quarantine = (frame.filter(~F.col(VALID_FLAG)).drop(VALID_FLAG)
                  .withColumn("_failed_rules", failed_rules(table.rules)))
    return valid, quarantine


def run_silver_stream(spark: SparkSession, bronze_path: str, table: SilverTable, out_root: str,
                      checkpoint: str, wait: bool = True) -> StreamingQuery:
    src = spark.readStream.schema(bronze_schema(spark, bronze_path)).parquet(bronze_path)
    frame = silver_frame(src, table)
    out = out_root.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():          # no-data batches only move the watermark
                return
            check_fail_rules(batch, table)
            valid, quarantine = split_outputs(batch, table)
            valid.write.mode("overwrite").parquet(f"{out}/{table.name}/batch={batch_id}")
            quarantine.write.mode("overwrite").parquet(f"{out}/{table.quarantine_name}/batch={batch_id}")
            write_metrics(batch.drop(VALID_FLAG), table, f"{out}/{table.metrics_name}/batch={batch_id}")
        finally:
            batch.unpersist()

    q = (frame.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    if wait:
        q.awaitTermination()
    return q


def dropped_late_rows(q: StreamingQuery) -> int:
    """Rows dropped by the watermark over the progress history of a query."""
    total = 0
    for p in q.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else []:
            total += int(op.get("numRowsDroppedByWatermark", 0))
    return total


def run_silver_batch(spark: SparkSession, bronze_path: str, table: SilverTable, out_root: str) -> None:
    """Full-refresh silver table (e.g. a daily snapshot dimension)."""
    # written once: the rules, both outputs and the metrics read the same rows
    frame = materialize(silver_frame(read_bronze(spark, bronze_path), table), table.name)
    check_fail_rules(frame, table)
    valid, quarantine = split_outputs(frame, table)
    out = out_root.rstrip("/")
    valid.write.mode("overwrite").parquet(f"{out}/{table.name}")
    quarantine.write.mode("overwrite").parquet(f"{out}/{table.quarantine_name}")
    write_metrics(frame.drop(VALID_FLAG), table, f"{out}/{table.metrics_name}")


def backfill_silver(spark: SparkSession, bronze_path: str, table: SilverTable, out_root: str,
                    bronze_filter: Column | str, label: str) -> tuple[int, int]:
    """Re-process an older period that the stream's watermark would drop as late.

    Batch path over the selected bronze rows: standardise, validate, dedup
    (first file wins), then insert only keys the silver table does not hold
    yet (``left_anti`` on the business key), so stream and backfill never
    duplicate a key.  Writes ``batch=backfill-<label>`` folders, which no stream
    batch id equals and Spark reads as text; re-running with the same label
    replaces them (idempotent).  Returns (valid, quarantined) rows.
    """
    src = read_bronze(spark, bronze_path)
    src = src.filter(F.expr(bronze_filter) if isinstance(bronze_filter, str) else bronze_filter)
    frame = materialize(silver_frame(src, table), table.name)
    check_fail_rules(frame, table)
    valid, quarantine = split_outputs(frame, table)
    out = out_root.rstrip("/")
    keys = list(table.keys)
    batch = f"backfill-{label}"
    folder = f"batch={quote(batch, safe='')}"
    existing_path = f"{out}/{table.name}"
    from punctua.sources import hadoopfs as hfs
    if hfs.exists(spark, existing_path):
        existing = (spark.read.option("mergeSchema", "true").parquet(existing_path)
                    .filter(F.col("batch").cast("string") != F.lit(batch)).select(*keys))
        valid = valid.join(existing, keys, "left_anti")
        # cut from the table that is about to be written to
        valid = materialize(valid, f"{table.name}-new")
    valid.write.mode("overwrite").parquet(f"{out}/{table.name}/{folder}")
    n_valid = spark.read.parquet(f"{out}/{table.name}/{folder}").count()
    quarantine.write.mode("overwrite").parquet(f"{out}/{table.quarantine_name}/{folder}")
    n_q = spark.read.parquet(f"{out}/{table.quarantine_name}/{folder}").count()
    return n_valid, n_q


def late_rows(spark: SparkSession, bronze_path: str, table: SilverTable, out_root: str) -> DataFrame:
    """Bronze rows the stream did not write to either output (dropped as late, or not
    yet processed): standardised rows whose business key is in neither the valid nor
    the quarantine table.  Two ``left_anti`` joins on the key; nothing is collected."""
    keys = list(table.keys)
    std = standardize(read_bronze(spark, bronze_path), table.spec)
    out = out_root.rstrip("/")
    from punctua.sources import hadoopfs as hfs
    for name in (table.name, table.quarantine_name):
        if hfs.exists(spark, f"{out}/{name}"):
            seen = spark.read.option("mergeSchema", "true").parquet(f"{out}/{name}").select(*keys)
            std = std.join(seen, [std[k].eqNullSafe(seen[k]) for k in keys], "left_anti")
    return std


def read_silver(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(f"{out_root.rstrip('/')}/{name}")
