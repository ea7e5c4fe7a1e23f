"""Feeds and streams end to end on whole driver tables: preamble CSV, silver streams, backfill, change streams, merges."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from punctua.operators.upsert import upsert_sql
from punctua.plans.domain import WEATHER
from punctua.plans.domain_q import weather_bronze
from punctua.plans.history_q import _VERSIONS_SQL, SEQ_BUCKET
from punctua.plans.ingest_q import _scratch
from punctua.plans.registry import query
from punctua.session import materialize
from punctua.sources.ingest import feed, read_bronze, run_bronze
from punctua.streaming.cdc import read_history, run_cdc_stream
from punctua.streaming.late import read_output, run_split_stream
from punctua.streaming.silver import backfill_silver, read_silver, run_silver_stream
from punctua.tables import Tables

# Query parameters: the line before each header, and the day from which the silver stream runs.
PREAMBLE = "Updated daily"
STREAM_FROM = "2024-01-16T00:00"
CDC_FILES, CDC_PARTS = 3, 16
# Files of the late-rows query, and the days that one covers.
ARRIVALS, ARRIVAL_DAYS = 4, 8


@query("bronze_preamble_csv", sql=f"""
SELECT CAST(c_nationkey AS VARCHAR) AS nation, CAST(c_custkey AS VARCHAR) AS customer_key, c_name AS name,
       CASE WHEN c_custkey % 10 = 0 THEN '["' || c_mktsegment || '","x"]' END AS rescued FROM customer
UNION ALL SELECT DISTINCT CAST(c_nationkey AS VARCHAR), '{PREAMBLE}', NULL, NULL FROM customer
""")
def q_bronze_preamble_csv(spark: SparkSession, sf_dir: str):
    """customer as one CSV file per nation: a preamble line, a header, rows of which some have surplus fields, and a
    data row that equals the preamble. Lines go by their place, surplus fields to the rescued column."""
    root = _scratch(spark, "ingest-preamble")
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    surplus = F.when(F.col("c_custkey") % 10 == 0, F.concat(F.lit(";"), "c_mktsegment", F.lit(";x"))).otherwise("")
    data = c.select("c_nationkey", F.lit(2).alias("place"), F.concat(F.col("c_custkey").cast("string"), F.lit(";"), "c_name",
                                                                     surplus).alias("line"))
    frame = [(0, PREAMBLE), (1, "Customer Key;Name"), (3, PREAMBLE)]
    head = c.select("c_nationkey").distinct().select("c_nationkey", F.inline(F.array(*[
        F.struct(F.lit(i).alias("place"), F.lit(x).alias("line")) for i, x in frame])))
    (head.unionByName(data).repartition("c_nationkey").sortWithinPartitions("c_nationkey", "place")
     .select("c_nationkey", "line").write.partitionBy("c_nationkey").text(f"{root}/landing/customer"))
    cfg = feed(f"{root}/landing/customer", f"{root}/system/customer", f"{root}/bronze/customer", "csv",
                       files="*.txt", options={"sep": ";"}, preamble=1)
    run_bronze(spark, cfg)
    b = read_bronze(spark, cfg.places.bronze)
    return b.select(F.col("c_nationkey").alias("nation"), "customer_key", "name", F.col("_rescued_data").alias("rescued"))


_WEATHER_SQL = """
s AS (SELECT CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN NULL ELSE 'U' || CAST(user_id AS VARCHAR) END AS icao,
             date_trunc('hour', ts) AS data_hora FROM events)"""


def _weather_table(spark: SparkSession, sf_dir: str, root: str) -> str:
    path = f"{root}/bronze/weather"
    weather_bronze(Tables(spark, sf_dir)).write.parquet(path)
    return path


@query("silver_stream", sql=f"""
WITH {_WEATHER_SQL}
SELECT DISTINCT CASE WHEN icao IS NULL THEN 'tem_icao' ELSE '' END AS failed, icao, data_hora FROM s
""")
def q_silver_stream(spark: SparkSession, sf_dir: str):
    """Hourly weather as a silver stream: one row per key and verdict, valid and quarantined rows from one query."""
    root = _scratch(spark, "silver-stream")
    path = _weather_table(spark, sf_dir, root)
    run_silver_stream(spark, path, WEATHER, f"{root}/silver", f"{root}/checkpoint")
    valid = read_silver(spark, f"{root}/silver", WEATHER.name).select(F.lit("").alias("failed"), "icao", "data_hora")
    bad = read_silver(spark, f"{root}/silver", WEATHER.quarantine_name)
    return valid.unionByName(bad.select(F.concat_ws(",", "_failed_rules").alias("failed"), "icao", "data_hora"))


@query("silver_backfill", sql=f"""
WITH {_WEATHER_SQL}
SELECT DISTINCT icao, data_hora, CASE WHEN data_hora < TIMESTAMP '{STREAM_FROM.replace("T", " ")}:00'
                                      THEN 'backfill-007' ELSE 'stream' END AS origin
FROM s WHERE icao IS NOT NULL
""")
def q_silver_backfill(spark: SparkSession, sf_dir: str):
    """A stream over the later days, then the older ones by backfill, run twice under one numeric label; the second run
    takes the whole table, so keys that the stream has written must stay its own."""
    root = _scratch(spark, "silver-backfill")
    path = _weather_table(spark, sf_dir, root)
    later = f"{root}/bronze/later"
    spark.read.parquet(path).where(F.col("time") >= STREAM_FROM).write.parquet(later)
    run_silver_stream(spark, later, WEATHER, f"{root}/silver", f"{root}/checkpoint")
    backfill_silver(spark, path, WEATHER, f"{root}/silver", F.col("time") < STREAM_FROM, "007")
    backfill_silver(spark, path, WEATHER, f"{root}/silver", "true", "007")
    batch = F.col("batch").cast("string")
    return read_silver(spark, f"{root}/silver", WEATHER.name).select(
        "icao", "data_hora", F.when(batch.startswith("backfill-"), batch).otherwise("stream").alias("origin"))


_ARRIVAL_SQL = f"""
s AS (SELECT CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN NULL ELSE 'U' || CAST(user_id AS VARCHAR) END AS icao,
             CASE WHEN event_id % 41 <> 0 THEN date_trunc('hour', ts) END AS data_hora,
             least({ARRIVALS - 1}, (day(ts) - 1) // {ARRIVAL_DAYS} + CASE WHEN event_id % 37 = 0 THEN 2
                                                                       WHEN event_id % 10 = 0 THEN 1 ELSE 0 END) AS a FROM events),
m AS (SELECT a, max(data_hora) AS top FROM s GROUP BY a),
w AS (SELECT a, max(top) OVER (ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 3 DAY AS mark FROM m),
x AS (SELECT s.*, coalesce(data_hora <= mark, false) AS late, icao IS NOT NULL AND data_hora IS NOT NULL AS valid
      FROM s JOIN w ON s.a = w.a),
k AS (SELECT CASE WHEN valid THEN 'valid' ELSE 'quarantine' END AS verdict, icao, data_hora, min(a) AS a FROM x
      WHERE NOT late GROUP BY valid, icao, data_hora, CASE WHEN data_hora IS NULL THEN a END),
o AS (SELECT verdict, a, icao, data_hora, count(*) AS n FROM k GROUP BY ALL
      UNION ALL SELECT 'late', a, icao, data_hora, count(*) FROM x WHERE late GROUP BY ALL
      UNION ALL SELECT 'rows', a, NULL, NULL, count(*) FROM x GROUP BY a
      UNION ALL SELECT 'duplicates', x.a, NULL, NULL, count(*) - coalesce(any_value(kept), 0) FROM x
        LEFT JOIN (SELECT a, count(*) AS kept FROM k GROUP BY a) c ON c.a = x.a WHERE NOT late GROUP BY x.a)"""


@query("silver_late_split", sql=f"""
WITH {_ARRIVAL_SQL}
SELECT verdict, CAST(a AS VARCHAR) AS batch, icao, data_hora, CAST(n AS BIGINT) AS n FROM o
""")
def q_silver_late_split(spark: SparkSession, sf_dir: str):
    """Hourly weather in ARRIVALS files, a micro-batch each; some rows come one or two files late, some without a time. Valid,
    quarantined and late rows by batch, and the rows and duplicates of each batch, which account for all of bronze."""
    root = _scratch(spark, "silver-late")
    t = Tables(spark, sf_dir)
    when = F.least(F.lit(ARRIVALS - 1), F.floor((F.dayofmonth("ts") - 1) / ARRIVAL_DAYS)
                   + F.when(F.col("event_id") % 37 == 0, 2).when(F.col("event_id") % 10 == 0, 1).otherwise(0))
    rows = weather_bronze(t, when.alias("arrival"), F.col("event_id").alias("event"))
    rows = materialize(rows.withColumn("time", F.when(F.col("event") % 41 != 0, F.col("time")).otherwise("n/d")), "arrivals")
    for k in range(ARRIVALS):
        rows.where(F.col("arrival") == k).drop("arrival", "event").coalesce(1).write.mode("append").parquet(f"{root}/bronze/weather")
    run_split_stream(spark, f"{root}/bronze/weather", WEATHER, f"{root}/silver", f"{root}/checkpoint", max_files_per_trigger=1)
    out = lambda name: read_output(spark, f"{root}/silver", name)
    written = [out(name).select(F.lit(verdict).alias("verdict"), "batch", "icao", "data_hora") for name, verdict in (
        (WEATHER.name, "valid"), (WEATHER.quarantine_name, "quarantine"), (f"{WEATHER.name}_late", "late"))]
    counted = (written[0].unionByName(written[1]).unionByName(written[2])
               .groupBy("verdict", "batch", "icao", "data_hora").agg(F.count(F.lit(1)).alias("n")))
    flow = out(f"{WEATHER.name}_flow")
    totals = [flow.select(F.lit(c).alias("verdict"), "batch", F.lit(None).cast("string").alias("icao"),
                          F.lit(None).cast("timestamp").alias("data_hora"), F.col(c).alias("n")) for c in ("rows", "duplicates")]
    return counted.unionByName(totals[0]).unionByName(totals[1])


@query("cdc_stream_history", sql=f"WITH {_VERSIONS_SQL} SELECT * FROM versions")
def q_cdc_stream_history(spark: SparkSession, sf_dir: str):
    """``events`` as a change stream into the type-2 history table: CDC_FILES files, each a micro-batch with events between
    those of the batches before, so closed ranges open again."""
    root = _scratch(spark, "cdc")
    e = Tables(spark, sf_dir).events.select("user_id", "event_id", "ts", "event_type")
    for k in range(CDC_FILES):
        e.where(F.col("event_id") % CDC_FILES == (k * 5 + 3) % CDC_FILES).coalesce(1).write.parquet(f"{root}/in/f{k}")
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/f*")
    run_cdc_stream(spark, stream, f"{root}/cdc", f"{root}/checkpoint", "user_id", "event_id", "ts", ["event_type"],
                   lambda: F.col("event_type") == "error", seq_bucket=SEQ_BUCKET, parts=CDC_PARTS)
    return read_history(spark, f"{root}/cdc")


@query("merge_views", sql="""
WITH t AS (SELECT CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_custkey END AS k, 'old' AS version, c_acctbal AS v FROM customer
           WHERE c_nationkey < 15),
s AS (SELECT CASE WHEN c_custkey % 70 = 0 THEN NULL ELSE c_custkey END AS k, 'new' AS version, c_acctbal + 1 AS v FROM customer
      WHERE c_nationkey >= 10)
SELECT k, version, round(v, 6) AS v FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.k = t.k)
UNION ALL SELECT k, version, round(v, 6) FROM s
""")
def q_merge_views(spark: SparkSession, sf_dir: str):
    """The SQL upsert over two views; NULL keys match nothing."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_nationkey", "c_acctbal")

    def side(rows, every, version, add):
        return rows.select(F.when(F.col("c_custkey") % every != 0, F.col("c_custkey")).alias("k"), F.lit(version).alias("version"),
                           (F.col("c_acctbal") + add).alias("v"))

    sides = {f"merge_{name}_{uuid.uuid4().hex}": rows for name, rows in (
        ("target", side(c.where("c_nationkey < 15"), 50, "old", 0)), ("source", side(c.where("c_nationkey >= 10"), 70, "new", 1)))}
    for name, rows in sides.items():  # names of their own: the caller's session may have views
        rows.createTempView(name)
    out = upsert_sql(spark, *sides, ["k"]).withColumn("v", F.round("v", 6))
    for name in sides:  # the result is analysed and does not need them any more
        spark.catalog.dropTempView(name)
    return out
