"""Incremental planning and keyed-table queries."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from punctua.operators.planning import next_windows, split_windows, year_range
from punctua.operators.upsert import upsert
from punctua.plans.registry import query
from punctua.tables import Tables

# Parameters of the planning queries ("today" is an input, never the wall clock).
DEFAULT_START = "1996-01-01"
TODAY = "2001-06-01"
LAG_DAYS = 7
HWM_CUT = "1999-01-01"
# Fixed value: date format of the series API request parameters.
REQUEST_DATE_FORMAT = "dd/MM/yyyy"


def control_table(t: Tables):
    """High-water mark per customer: last order date before the cut."""
    return (t.orders.filter(F.col("o_orderdate") < F.lit(HWM_CUT).cast("timestamp"))
            .groupBy(F.col("o_custkey").alias("key"))
            .agg(F.to_date(F.max("o_orderdate")).alias("last_date")))


@query("incremental_plan", sql=f"""
WITH ctl AS (SELECT o_custkey AS key, CAST(max(o_orderdate) AS DATE) AS last_date FROM orders
             WHERE o_orderdate < TIMESTAMP '{HWM_CUT}' GROUP BY 1)
SELECT * FROM (
  SELECT c_custkey AS key, ctl.last_date AS last_fetched,
         coalesce(ctl.last_date + 1, DATE '{DEFAULT_START}') AS start_date,
         DATE '{TODAY}' - {LAG_DAYS} AS end_date
  FROM customer LEFT JOIN ctl ON c_custkey = ctl.key)
WHERE start_date <= end_date
""")
def q_incremental_plan(spark: SparkSession, sf_dir: str):
    t = Tables(spark, sf_dir)
    keys = t.customer.select(F.col("c_custkey").alias("key"))
    return next_windows(keys, control_table(t), "key", "last_date", DEFAULT_START, TODAY, LAG_DAYS)


_SPANS_SQL = """
spans AS (
  SELECT c_custkey AS key,
         CASE WHEN c_custkey % 3 = 0 THEN make_date(1960 + 4 * CAST(c_custkey % 10 AS INTEGER), 2, 29)
              ELSE DATE '1960-01-01' + CAST((c_custkey * 37) % 15000 AS INTEGER) END AS start_date,
         CAST(max(o_orderdate) AS DATE) AS end_date
  FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2
)"""


def spans(t: Tables):
    c = t.customer.select(
        F.col("c_custkey").alias("key"),
        F.when(F.col("c_custkey") % 3 == 0,
               F.make_date(1960 + 4 * (F.col("c_custkey") % 10).cast("int"), F.lit(2), F.lit(29)))
        .otherwise(F.date_add(F.lit("1960-01-01").cast("date"), ((F.col("c_custkey") * 37) % 15000).cast("int")))
        .alias("start_date"))
    last = t.orders.groupBy(F.col("o_custkey").alias("key")).agg(F.to_date(F.max("o_orderdate")).alias("end_date"))
    return c.join(last, "key")


@query("request_windows", sql=f"""
WITH {_SPANS_SQL},
w AS (
  SELECT key, start_date, end_date, CAST(k AS INTEGER) AS window_no,
         CASE WHEN k = 0 THEN start_date
              ELSE CAST(start_date + INTERVAL 120 MONTH + INTERVAL (120 * (k - 1)) MONTH AS DATE) END AS window_start,
         least(CAST(start_date + INTERVAL 120 MONTH + INTERVAL (120 * k) MONTH AS DATE) - 1, end_date) AS window_end
  FROM spans, LATERAL (SELECT unnest(range(0, 60)) AS k)
)
SELECT *, strftime(window_start, '%d/%m/%Y') AS request_from, strftime(window_end, '%d/%m/%Y') AS request_to
FROM w WHERE window_start <= end_date
""")
def q_request_windows(spark: SparkSession, sf_dir: str):
    """Each customer's span (start made from the key, end = last order) in <=10-year pieces,
    with the request parameters formatted as the API expects (dd/MM/yyyy)."""
    w = split_windows(spans(Tables(spark, sf_dir)))
    return w.withColumns({"request_from": F.date_format("window_start", REQUEST_DATE_FORMAT),
                          "request_to": F.date_format("window_end", REQUEST_DATE_FORMAT)})


@query("year_range", sql="""
SELECT o_custkey AS key, CAST(min(year(o_orderdate)) AS INTEGER) AS first_year,
       CAST(max(year(o_orderdate)) AS INTEGER) AS last_year,
       CAST(unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1)) AS INTEGER) AS year
FROM orders GROUP BY 1
""")
def q_year_range(spark: SparkSession, sf_dir: str):
    o = Tables(spark, sf_dir).orders
    r = o.groupBy(F.col("o_custkey").alias("key")).agg(
        F.min(F.year("o_orderdate")).alias("first_year"), F.max(F.year("o_orderdate")).alias("last_year"))
    return year_range(r, "first_year", "last_year")


@query("upsert_merge", sql=f"""
WITH tgt AS (SELECT o_custkey AS key, CAST(max(o_orderdate) AS DATE) AS last_date FROM orders
             WHERE o_orderdate < TIMESTAMP '{HWM_CUT}' GROUP BY 1),
src AS (SELECT o_custkey AS key, CAST(max(o_orderdate) AS DATE) AS last_date FROM orders
        WHERE o_orderdate >= TIMESTAMP '{HWM_CUT}' GROUP BY 1)
SELECT coalesce(src.key, tgt.key) AS key, coalesce(src.last_date, tgt.last_date) AS last_date
FROM tgt FULL OUTER JOIN src ON tgt.key = src.key
""")
def q_upsert_merge(spark: SparkSession, sf_dir: str):
    """High-water marks: the control table is upserted with the max date observed per key."""
    t = Tables(spark, sf_dir)
    src = (t.orders.filter(F.col("o_orderdate") >= F.lit(HWM_CUT).cast("timestamp"))
           .groupBy(F.col("o_custkey").alias("key"))
           .agg(F.to_date(F.max("o_orderdate")).alias("last_date")))
    return upsert(control_table(t), src, ["key"])


@query("reprocess_idempotent", sql="SELECT * FROM orders")
def q_reprocess_idempotent(spark: SparkSession, sf_dir: str):
    """Re-landing one month twice through the keyed upsert leaves the table unchanged."""
    o = Tables(spark, sf_dir).orders
    # the month as a range on the raw column, so the filter reaches the parquet scan
    month = o.filter((F.col("o_orderdate") >= F.lit("1996-03-01").cast("timestamp"))
                     & (F.col("o_orderdate") < F.lit("1996-04-01").cast("timestamp")))
    once = upsert(o, month, ["o_orderkey"])
    return upsert(once, month, ["o_orderkey"])
