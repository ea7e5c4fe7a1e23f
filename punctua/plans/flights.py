"""The flight model over the driver tables.

Role mapping (fixed so that queries compose):

* flight            = one ``lineitem`` row joined to its ``orders`` row
* business key      = (l_orderkey, l_linenumber); duplicates exist, the
                      first by (l_shipdate, l_partkey) wins (arrival order)
* carrier           = o_orderpriority
* planned departure = o_orderdate,  actual = l_shipdate
* cancelled         = o_orderstatus = 'P'
* origin            = supplier nation, destination = customer nation
* "rain" at an airport-day = sum of l_quantity shipped to that nation that
  day; a rain day has more than 40.

Scale notes: lineitem x orders is the one big-big join (sort-merge on the
order key).  The dedup window is a rank-1 filter, which Catalyst runs as a
partial ``WindowGroupLimit`` before its shuffle.  supplier/customer joins are
left to the planner: they are broadcast only when their measured size is
under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at runtime),
otherwise they shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.functions.columns import minutes_between
from punctua.operators.dedup import dedup_batch
from punctua.operators.quality import Expectation, apply_expectations
from punctua.tables import Tables

# Fixed values of the role mapping.
CANCELLED_STATUS = "P"
RAIN_THRESHOLD = 40.0
FLIGHT_KEY = ["l_orderkey", "l_linenumber"]
ARRIVAL_ORDER = ["l_shipdate", "l_partkey"]

FLIGHT_RULES = [
    Expectation("has_carrier", "carrier IS NOT NULL", "drop"),
    Expectation("has_origin", "origin IS NOT NULL", "drop"),
    Expectation("has_planned", "planned_ts IS NOT NULL", "drop"),
    Expectation("delay_plausible", "delay_min IS NULL OR delay_min BETWEEN -120 AND 1440", "warn"),
]


def deduped_lineitem(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    return dedup_batch(li, FLIGHT_KEY, ARRIVAL_ORDER)


def flights(t: Tables, dedup: bool = True) -> DataFrame:
    """Standardised flight rows (before quality rules)."""
    li = deduped_lineitem(t) if dedup else t.lineitem
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority",
                        "o_totalprice")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(s, li.l_suppkey == s.s_suppkey)
         .join(c, o.o_custkey == c.c_custkey))
    return j.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("part_key"),
        F.col("o_orderpriority").alias("carrier"),
        F.col("s_nationkey").alias("origin"),
        F.col("c_nationkey").alias("destination"),
        F.col("o_orderdate").alias("planned_ts"),
        F.col("l_shipdate").alias("real_ts"),
        minutes_between("l_shipdate", "o_orderdate").alias("delay_min"),
        (F.col("o_orderstatus") == F.lit(CANCELLED_STATUS)).alias("cancelled"),
        F.col("l_quantity").alias("quantity"),
        F.col("o_totalprice").alias("fare"),
        F.col("o_orderstatus").alias("status"),
    )


def valid_flights(t: Tables) -> DataFrame:
    return apply_expectations(flights(t), FLIGHT_RULES).valid


FLIGHTS_SQL = """
li AS (
  SELECT * FROM (
    SELECT l.*, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey) AS rn_
    FROM lineitem l) WHERE rn_ = 1
),
f AS (
  SELECT li.l_orderkey AS order_key, li.l_linenumber AS line_number, li.l_partkey AS part_key,
         o.o_orderpriority AS carrier, s.s_nationkey AS origin, c.c_nationkey AS destination,
         o.o_orderdate AS planned_ts, li.l_shipdate AS real_ts,
         (floor(epoch(li.l_shipdate)) - floor(epoch(o.o_orderdate))) / 60.0 AS delay_min,
         o.o_orderstatus = 'P' AS cancelled, li.l_quantity AS quantity, o.o_totalprice AS fare
  FROM li JOIN orders o ON li.l_orderkey = o.o_orderkey
  JOIN supplier s ON li.l_suppkey = s.s_suppkey
  JOIN customer c ON o.o_custkey = c.c_custkey
)"""
