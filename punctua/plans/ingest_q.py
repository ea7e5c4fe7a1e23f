"""End-to-end ingestion and streaming queries on the driver tables.

Each query lands a table as files (JSON Lines under ``key=value/`` folders, or
';'-separated CSV with raw header names), ingests them with the bronze stream
(header discovery, registry, lineage) or runs a watermarked streaming dedup,
and returns what the stream wrote.  Scratch data goes under the shared
checkpoint folder of the session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from punctua.operators.dedup import dedup_stream
from punctua.plans.registry import query
from punctua.session import checkpoint_dir
from punctua.sources.ingest import feed, read_bronze, run_bronze
from punctua.sources.landing import write_json_lines
from punctua.tables import Tables


# The nations whose customers land first.
EVOLVES_AT = 13


def _scratch(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@query("bronze_json_ingest", sql="""
SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority,
       o_orderstatus,
       sha256(concat_ws('||', CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), o_orderpriority,
                        o_orderstatus)) AS row_hash
FROM orders
""")
def q_bronze_json_ingest(spark: SparkSession, sf_dir: str):
    """orders -> JSON Lines under o_orderstatus=<s>/ -> bronze (all text, partition column, row hash)."""
    root = _scratch(spark, "ingest-json")
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    write_json_lines(o, f"{root}/landing/orders", ["o_orderstatus"])
    cfg = feed(f"{root}/landing/orders", f"{root}/system/orders", f"{root}/bronze/orders", "json")
    run_bronze(spark, cfg)
    b = read_bronze(spark, cfg.places.bronze)
    return b.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus",
                    F.col("_row_hash").alias("row_hash"))


@query("bronze_csv_ingest", sql="""
SELECT CAST(c_custkey AS VARCHAR) AS customer_key, c_name AS nome_cliente, CAST(c_nationkey AS VARCHAR) AS "nação",
       c_mktsegment AS segmento_mercado,
       sha256(concat_ws('||', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment)) AS row_hash
FROM customer
""")
def q_bronze_csv_ingest(spark: SparkSession, sf_dir: str):
    """customer -> ';' CSV with raw header names -> bronze with sanitised names and row hash."""
    root = _scratch(spark, "ingest-csv")
    c = Tables(spark, sf_dir).customer.select(
        F.col("c_custkey").alias("Customer Key"), F.col("c_name").alias("Nome (Cliente)"),
        F.col("c_nationkey").alias("Nação"), F.col("c_mktsegment").alias("Segmento;Mercado"))
    c.write.option("header", "true").option("sep", ";").csv(f"{root}/landing/customer")
    cfg = feed(f"{root}/landing/customer", f"{root}/system/customer", f"{root}/bronze/customer", "csv",
                       files="*.csv", options={"sep": ";", "quote": '"'})
    run_bronze(spark, cfg)
    b = read_bronze(spark, cfg.places.bronze)
    return b.select("customer_key", "nome_cliente", "nação", "segmento_mercado",
                    F.col("_row_hash").alias("row_hash"))


@query("bronze_evolution", sql=f"""
SELECT 'csv' AS kind, CAST(c_custkey AS VARCHAR) AS customer_key, c_name AS name,
       CASE WHEN c_nationkey < {EVOLVES_AT} THEN CAST(c_nationkey AS VARCHAR) END AS nation, CASE WHEN c_nationkey >= {EVOLVES_AT} THEN c_mktsegment END AS segment,
       CAST(NULL AS VARCHAR) AS rescued FROM customer
UNION ALL
SELECT 'json', CAST(c_custkey AS VARCHAR), c_name, CASE WHEN c_nationkey < {EVOLVES_AT} THEN CAST(c_nationkey AS VARCHAR) END, NULL,
       CASE WHEN c_nationkey >= {EVOLVES_AT} THEN '{{"segment":"' || c_mktsegment || '"}}' END FROM customer
""")
def q_bronze_evolution(spark: SparkSession, sf_dir: str):
    """customer in two landings with a run after each: the second brings a column, lacks one and has them in another order. CSV
    adds the column, JSON rescues it; the second run takes the new files only."""
    root = _scratch(spark, "ingest-evolution")
    c = Tables(spark, sf_dir).customer
    key, name = F.col("c_custkey").alias("Customer Key"), F.col("c_name").alias("Name")
    landings = [c.where(F.col("c_nationkey") < EVOLVES_AT).select(key, name, F.col("c_nationkey").alias("Nation")),
                c.where(F.col("c_nationkey") >= EVOLVES_AT).select(F.col("c_mktsegment").alias("Segment"), name, key)]
    feeds = {kind: feed(f"{root}/landing/{kind}", f"{root}/system/{kind}", f"{root}/bronze/{kind}", kind,
                        files=f"*.{kind}", options={"sep": ";"} if kind == "csv" else {}, new_columns=kind == "csv") for kind in ("csv", "json")}
    for run, rows in enumerate(landings):
        rows.write.option("header", "true").option("sep", ";").csv(f"{root}/landing/csv/{run}")
        rows.write.json(f"{root}/landing/json/{run}")
        for f in feeds.values():
            run_bronze(spark, f)
    out = [read_bronze(spark, f.places.bronze).withColumn("kind", F.lit(kind)) for kind, f in feeds.items()]
    both = out[0].unionByName(out[1].withColumn("segment", F.lit(None).cast("string")))
    return both.select("kind", "customer_key", "name", "nation", "segment", F.col("_rescued_data").alias("rescued"))


@query("stream_dedup_keys", sql="SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def q_stream_dedup_keys(spark: SparkSession, sf_dir: str):
    """lineitem read as a file stream, deduplicated on the business key within a
    3-day watermark on the ship time, written by a parquet sink and read back."""
    root = _scratch(spark, "stream-dedup")
    # as a pattern the table may be a file or a folder of part files; a stream takes a plain path for a folder
    root_dir = sf_dir.rstrip("/")
    src = (spark.readStream.schema(spark.read.parquet(f"{root_dir}/lineitem.parquet").schema)
           .parquet(f"{root_dir}/lineitem.parque[t]")
           .select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp").alias("l_shipdate")))
    d = dedup_stream(src, ["l_orderkey", "l_linenumber"], "l_shipdate", "3 days")
    q = (d.writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out").select("l_orderkey", "l_linenumber")
