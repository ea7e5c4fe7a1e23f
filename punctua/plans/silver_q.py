"""Silver-layer queries: naming, typing, parsing, hashing, dedup and data quality."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from punctua.functions.arrays import zip_parallel_arrays
from punctua.functions.columns import (
    code_label, filename_period, flag_equals, minutes_between, parse_date, parse_timestamp, row_hash,
    sentinel_null,
)
from punctua.operators.dedup import dedup_batch, latest_by
from punctua.operators.quality import Expectation, apply_expectations, expect_or_drop, expectation_metrics
from punctua.operators.standardize import StandardizeSpec, standardize, unify_layouts
from punctua.plans.registry import query
from punctua.sources.naming import sanitize_columns
from punctua.tables import Tables

# Fixed values of the source systems.
NOT_SPECIFIED = "4-NOT SPECIFIED"
SERIES_LABELS = {1: "dolar_venda", 10813: "dolar_compra", 433: "ipca"}


# --------------------------------------------------------------------------- naming
@query("sanitize_columns", sql="""
SELECT s_suppkey AS s_suppkey, s_name AS "número_voo", s_nationkey AS s_nation_key,
       s_acctbal AS "_Keep_Me"
FROM supplier
""")
def q_sanitize_columns(spark: SparkSession, sf_dir: str):
    raw = Tables(spark, sf_dir).supplier.select(
        F.col("s_suppkey").alias(" S_SuppKey "),
        F.col("s_name").alias("Número (Voo)"),
        F.col("s_nationkey").alias("s_nation;key"),
        F.col("s_acctbal").alias("_Keep_Me"),
    )
    return sanitize_columns(raw)


# --------------------------------------------------------------------------- standardise
ORDERS_SPEC = StandardizeSpec(
    renames={"o_orderkey": "order_key", "o_custkey": "customer_key", "o_orderstatus": "status",
             "o_orderdate": "planned_ts", "o_orderpriority": "carrier", "o_not_there": "ignored"},
    drops=("o_totalprice", "no_such_column"),
)


@query("standardize_orders", sql="""
SELECT o_orderkey AS order_key, o_custkey AS customer_key, o_orderstatus AS status,
       o_orderdate AS planned_ts, o_orderpriority AS carrier
FROM orders
""")
def q_standardize_orders(spark: SparkSession, sf_dir: str):
    return standardize(Tables(spark, sf_dir).orders, ORDERS_SPEC)


@query("unify_layouts", sql="""
SELECT o_orderkey AS order_key, o_orderpriority AS carrier, o_orderdate AS planned_ts FROM orders
""")
def q_unify_layouts(spark: SparkSession, sf_dir: str):
    """Old layout (even keys) and new layout (odd keys) land with different names.

    The frame has the shape of ``old.unionByName(new, allowMissingColumns=True)``:
    each row carries only the columns of its own layout.
    """
    o = Tables(spark, sf_dir).orders
    old = F.col("o_orderkey") % 2 == 0
    both = o.select(
        F.col("o_orderkey").alias("order_key"),
        F.when(old, F.col("o_orderpriority")).alias("prioridade"),
        F.when(old, F.col("o_orderdate")).alias("data_prevista"),
        F.when(~old, F.col("o_orderpriority")).alias("carrier"),
        F.when(~old, F.col("o_orderdate")).alias("planned_ts"))
    return unify_layouts(both, {"carrier": ["carrier", "prioridade"],
                                "planned_ts": ["planned_ts", "data_prevista"]})


@query("sentinel_null", sql=f"""
SELECT o_orderkey AS order_key, nullif(o_orderpriority, '{NOT_SPECIFIED}') AS carrier,
       nullif(o_orderstatus, 'O') AS status
FROM orders
""")
def q_sentinel_null(spark: SparkSession, sf_dir: str):
    o = Tables(spark, sf_dir).orders
    return o.select(F.col("o_orderkey").alias("order_key"),
                    sentinel_null("o_orderpriority", NOT_SPECIFIED).alias("carrier"),
                    sentinel_null("o_orderstatus", "O").alias("status"))


@query("flag_cancelled", sql=f"""
SELECT order_key, status, status = 'P' AS cancelled FROM (
  SELECT o_orderkey AS order_key,
         CASE WHEN o_orderpriority = '{NOT_SPECIFIED}' THEN NULL ELSE o_orderstatus END AS status
  FROM orders)
""")
def q_flag_cancelled(spark: SparkSession, sf_dir: str):
    o = Tables(spark, sf_dir).orders
    s = o.select(F.col("o_orderkey").alias("order_key"),
                 F.when(F.col("o_orderpriority") != NOT_SPECIFIED, F.col("o_orderstatus")).alias("status"))
    return s.withColumn("cancelled", flag_equals("status", "P"))


@query("code_label_case", sql=f"""
SELECT order_key, code_text,
       CASE TRY_CAST(code_text AS INTEGER) WHEN 1 THEN 'dolar_venda' WHEN 10813 THEN 'dolar_compra'
            WHEN 433 THEN 'ipca' ELSE CAST(TRY_CAST(code_text AS INTEGER) AS VARCHAR) END AS series_name
FROM (SELECT o_orderkey AS order_key,
             CASE WHEN o_orderpriority = '{NOT_SPECIFIED}' THEN 'zz' ELSE CAST(o_custkey AS VARCHAR) END AS code_text
      FROM orders)
""")
def q_code_label_case(spark: SparkSession, sf_dir: str):
    o = Tables(spark, sf_dir).orders
    s = o.select(F.col("o_orderkey").alias("order_key"),
                 F.when(F.col("o_orderpriority") == NOT_SPECIFIED, F.lit("zz"))
                 .otherwise(F.col("o_custkey").cast("string")).alias("code_text"))
    return s.withColumn("series_name", code_label("code_text", SERIES_LABELS))


@query("typed_cast", sql="""
SELECT part_key, TRY_CAST(size_text AS INTEGER) AS size, TRY_CAST(price_text AS DOUBLE) AS price FROM (
  SELECT p_partkey AS part_key,
         CASE WHEN p_partkey % 7 = 0 THEN CAST(p_size AS VARCHAR) || 'x' ELSE CAST(p_size AS VARCHAR) END AS size_text,
         CASE WHEN p_partkey % 11 = 0 THEN 'n/a' ELSE CAST(p_retailprice AS VARCHAR) END AS price_text
  FROM part)
""")
def q_typed_cast(spark: SparkSession, sf_dir: str):
    p = Tables(spark, sf_dir).part
    raw = p.select(
        F.col("p_partkey").alias("part_key"),
        F.when(F.col("p_partkey") % 7 == 0, F.concat(F.col("p_size").cast("string"), F.lit("x")))
        .otherwise(F.col("p_size").cast("string")).alias("size"),
        F.when(F.col("p_partkey") % 11 == 0, F.lit("n/a"))
        .otherwise(F.col("p_retailprice").cast("string")).alias("price"))
    return standardize(raw, StandardizeSpec(casts={"size": "int", "price": "double"}))


@query("parse_timestamps", sql="""
SELECT order_key, planned_text,
       try_strptime(planned_text, '%Y-%m-%d %H:%M:%S') AS planned_ts,
       TRY_CAST(replace(planned_text, ' ', 'T') AS TIMESTAMP) AS planned_iso_ts
FROM (SELECT o_orderkey AS order_key,
             CASE WHEN o_custkey % 13 = 0 THEN '2024-13-45 99:00:00'
                  ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS planned_text
      FROM orders)
""")
def q_parse_timestamps(spark: SparkSession, sf_dir: str):
    o = Tables(spark, sf_dir).orders
    s = o.select(F.col("o_orderkey").alias("order_key"),
                 F.when(F.col("o_custkey") % 13 == 0, F.lit("2024-13-45 99:00:00"))
                 .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("planned_text"))
    return s.select("order_key", "planned_text",
                    parse_timestamp("planned_text").alias("planned_ts"),
                    F.regexp_replace("planned_text", " ", "T").try_cast("timestamp").alias("planned_iso_ts"))


@query("parse_dates", sql="""
SELECT order_key, date_text, CAST(try_strptime(date_text, '%d/%m/%Y') AS DATE) AS order_date
FROM (SELECT o_orderkey AS order_key,
             CASE WHEN o_custkey % 17 = 0 THEN '31/02/' || CAST(year(o_orderdate) AS VARCHAR)
                  ELSE strftime(o_orderdate, '%d/%m/%Y') END AS date_text
      FROM orders)
""")
def q_parse_dates(spark: SparkSession, sf_dir: str):
    o = Tables(spark, sf_dir).orders
    s = o.select(F.col("o_orderkey").alias("order_key"),
                 F.when(F.col("o_custkey") % 17 == 0,
                        F.concat(F.lit("31/02/"), F.year("o_orderdate").cast("string")))
                 .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("date_text"))
    return s.withColumn("order_date", parse_date("date_text"))


# --------------------------------------------------------------------------- derived
@query("delay_minutes", sql="""
SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_partkey AS part_key,
       (floor(epoch(l_shipdate)) - floor(epoch(o_orderdate))) / 60.0 AS delay_min
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def q_delay_minutes(spark: SparkSession, sf_dir: str):
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_number"),
                    F.col("l_partkey").alias("part_key"),
                    minutes_between("l_shipdate", "o_orderdate").alias("delay_min"))


@query("row_hash", sql=f"""
SELECT 'orders' AS source, o_orderkey AS row_key,
       sha256(concat_ws('||', o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR),
                        nullif(o_orderpriority, '{NOT_SPECIFIED}'))) AS row_hash
FROM orders
UNION ALL
SELECT 'nation', CAST(n_nationkey AS BIGINT), sha256(concat_ws('||', n_nationkey, n_name, n_regionkey)) FROM nation
""")
def q_row_hash(spark: SparkSession, sf_dir: str):
    t = Tables(spark, sf_dir)
    o = t.orders
    oh = o.select(F.lit("orders").alias("source"), F.col("o_orderkey").alias("row_key"),
                  row_hash(["o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate"),
                            sentinel_null("o_orderpriority", NOT_SPECIFIED)]).alias("row_hash"))
    n = t.nation
    nh = n.select(F.lit("nation").alias("source"), F.col("n_nationkey").cast("bigint").alias("row_key"),
                  row_hash(["n_nationkey", "n_name", "n_regionkey"]).alias("row_hash"))
    return oh.unionByName(nh)


# File names made from each document's source and id: separators, single-digit
# months, month 13 and 0, and years outside 20xx all occur.
_NAME_SQL = """
  CASE doc_id % 4
    WHEN 0 THEN upper(source) || '_' || CAST(2015 + doc_id % 12 AS VARCHAR) || '_' || lpad(CAST(doc_id % 14 AS VARCHAR), 2, '0') || '.csv'
    WHEN 1 THEN source || '-' || CAST(2015 + doc_id % 12 AS VARCHAR) || '-' || CAST(doc_id % 14 AS VARCHAR) || '.csv'
    WHEN 2 THEN 'vra/' || source || '/VRA_' || CAST(2015 + doc_id % 12 AS VARCHAR) || CAST(doc_id % 14 AS VARCHAR) || '.csv'
    ELSE source || '_' || CAST(1990 + doc_id % 40 AS VARCHAR) || '.csv' END"""


@query("filename_period", sql=f"""
SELECT doc_id, file_name,
       CASE WHEN regexp_extract(base, '(20[0-9]{{2}})[_-]?(0?[1-9]|1[0-2])([^0-9]|$)', 1) = '' THEN 'unparsed'
            ELSE regexp_extract(base, '(20[0-9]{{2}})[_-]?(0?[1-9]|1[0-2])([^0-9]|$)', 1) || '/' ||
                 lpad(CAST(CAST(regexp_extract(base, '(20[0-9]{{2}})[_-]?(0?[1-9]|1[0-2])([^0-9]|$)', 2) AS INTEGER) AS VARCHAR), 2, '0')
       END AS period
FROM (SELECT doc_id, file_name, regexp_extract(file_name, '([^/]*)$', 1) AS base
      FROM (SELECT doc_id, {_NAME_SQL} AS file_name FROM documents))
""")
def q_filename_period(spark: SparkSession, sf_dir: str):
    d = Tables(spark, sf_dir).documents.select("doc_id", "source")
    name = F.expr(_NAME_SQL.replace("VARCHAR", "STRING"))
    return d.select("doc_id", name.alias("file_name")).withColumn("period", filename_period("file_name"))


# --------------------------------------------------------------------------- arrays
_PAYLOAD_SQL = """
payload AS (
  SELECT event_id // 24 AS payload_id,
         list(strftime(ts, '%Y-%m-%dT%H:%M:%S') ORDER BY event_id) AS time,
         CASE WHEN (event_id // 24) % 5 = 0
              THEN list(value ORDER BY event_id)[1:count(*) - 1]
              ELSE list(value ORDER BY event_id) END AS value,
         CASE WHEN (event_id // 24) % 7 = 0 THEN NULL ELSE list(event_type ORDER BY event_id) END AS event_type
  FROM events GROUP BY 1
)"""


@query("zip_parallel_arrays", sql=f"""
WITH {_PAYLOAD_SQL}
SELECT payload_id, CAST(i - 1 AS INTEGER) AS pos, time[i] AS time, value[i] AS value, event_type[i] AS event_type
FROM payload, LATERAL (SELECT unnest(range(1, len(time) + 1)) AS i)
""")
def q_zip_parallel_arrays(spark: SparkSession, sf_dir: str):
    """Hourly payloads of 24 readings (time[], value[], event_type[]) back to rows.

    Payloads are built from ``events`` in groups of 24 consecutive ids (bounded
    arrays); every 5th payload has a value array one short, every 7th lacks
    the type array.
    """
    e = Tables(spark, sf_dir).events
    pid = (F.col("event_id") / 24).cast("bigint")
    g = (e.groupBy(pid.alias("payload_id"))
         .agg(F.array_sort(F.collect_list(F.struct("event_id",
                                                    F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("t"),
                                                    "value", "event_type"))).alias("r")))
    p = g.select(
        "payload_id",
        F.transform("r", lambda x: x["t"]).alias("time"),
        F.when(F.col("payload_id") % 5 == 0, F.slice(F.transform("r", lambda x: x["value"]), 1, F.size("r") - 1))
        .otherwise(F.transform("r", lambda x: x["value"])).alias("value"),
        F.when(F.col("payload_id") % 7 != 0, F.transform("r", lambda x: x["event_type"])).alias("event_type"),
    )
    return zip_parallel_arrays(p, "time", ["value", "event_type"], keep=["payload_id"], pos_col="pos")


# --------------------------------------------------------------------------- dedup
@query("latest_snapshot", sql="""
SELECT customer_key, order_key, planned_ts, carrier FROM (
  SELECT o_custkey AS customer_key, o_orderkey AS order_key, o_orderdate AS planned_ts, o_orderpriority AS carrier,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1
""")
def q_latest_snapshot(spark: SparkSession, sf_dir: str):
    o = Tables(spark, sf_dir).orders.select(
        F.col("o_custkey").alias("customer_key"), F.col("o_orderkey").alias("order_key"),
        F.col("o_orderdate").alias("planned_ts"), F.col("o_orderpriority").alias("carrier"))
    return latest_by(o, ["customer_key"], [F.col("planned_ts").desc(), F.col("order_key").desc()])


@query("dedup_business_key", sql="""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey) AS rn
  FROM lineitem) WHERE rn = 1
""")
def q_dedup_business_key(spark: SparkSession, sf_dir: str):
    li = Tables(spark, sf_dir).lineitem
    return dedup_batch(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"])


# --------------------------------------------------------------------------- quality
FLIGHT_DQ_RULES = [
    Expectation("has_carrier", "carrier IS NOT NULL", "drop"),
    Expectation("has_origin", "origin IS NOT NULL", "drop"),
    Expectation("has_planned", "planned_ts IS NOT NULL", "drop"),
    Expectation("delay_plausible", "delay_min IS NULL OR delay_min BETWEEN -120 AND 1440", "warn"),
]

_DQ_FRAME_SQL = f"""
x AS (
  SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_partkey AS part_key,
         nullif(o_orderpriority, '{NOT_SPECIFIED}') AS carrier, nullif(s_nationkey, 0) AS origin,
         o_orderdate AS planned_ts,
         (floor(epoch(l_shipdate)) - floor(epoch(o_orderdate))) / 60.0 AS delay_min
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
)"""


def dq_frame(t: Tables):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(s, li.l_suppkey == s.s_suppkey)
    return j.select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("part_key"),
        sentinel_null("o_orderpriority", NOT_SPECIFIED).alias("carrier"),
        F.nullif(F.col("s_nationkey"), F.lit(0)).alias("origin"),
        F.col("o_orderdate").alias("planned_ts"),
        minutes_between("l_shipdate", "o_orderdate").alias("delay_min"))


@query("expect_or_drop", sql=f"""
WITH {_DQ_FRAME_SQL}
SELECT * FROM x WHERE coalesce(carrier IS NOT NULL, false) AND coalesce(origin IS NOT NULL, false)
  AND coalesce(planned_ts IS NOT NULL, false)
""")
def q_expect_or_drop(spark: SparkSession, sf_dir: str):
    return expect_or_drop(dq_frame(Tables(spark, sf_dir)), FLIGHT_DQ_RULES)


@query("quarantine_split", sql=f"""
WITH {_DQ_FRAME_SQL}
SELECT *, concat_ws(',', CASE WHEN carrier IS NULL THEN 'has_carrier' END,
                         CASE WHEN origin IS NULL THEN 'has_origin' END,
                         CASE WHEN planned_ts IS NULL THEN 'has_planned' END) AS failed_rules
FROM x WHERE NOT (coalesce(carrier IS NOT NULL, false) AND coalesce(origin IS NOT NULL, false)
  AND coalesce(planned_ts IS NOT NULL, false))
""")
def q_quarantine_split(spark: SparkSession, sf_dir: str):
    res = apply_expectations(dq_frame(Tables(spark, sf_dir)), FLIGHT_DQ_RULES)
    return res.quarantine.withColumn("failed_rules", F.concat_ws(",", "_failed_rules")).drop("_failed_rules")


@query("expect_warn_metrics", sql=f"""
WITH {_DQ_FRAME_SQL}
SELECT 'has_carrier' AS rule, 'drop' AS action, CAST(count_if(carrier IS NOT NULL) AS BIGINT) AS passed,
       CAST(count_if(carrier IS NULL) AS BIGINT) AS failed FROM x
UNION ALL SELECT 'has_origin', 'drop', CAST(count_if(origin IS NOT NULL) AS BIGINT),
       CAST(count_if(origin IS NULL) AS BIGINT) FROM x
UNION ALL SELECT 'has_planned', 'drop', CAST(count_if(planned_ts IS NOT NULL) AS BIGINT),
       CAST(count_if(planned_ts IS NULL) AS BIGINT) FROM x
UNION ALL SELECT 'delay_plausible', 'warn',
       CAST(count_if(coalesce(delay_min IS NULL OR delay_min BETWEEN -120 AND 1440, false)) AS BIGINT),
       CAST(count_if(NOT coalesce(delay_min IS NULL OR delay_min BETWEEN -120 AND 1440, false)) AS BIGINT) FROM x
""")
def q_expect_warn_metrics(spark: SparkSession, sf_dir: str):
    return expectation_metrics(dq_frame(Tables(spark, sf_dir)), FLIGHT_DQ_RULES)
