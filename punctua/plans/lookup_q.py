"""Lookup and reconciliation queries: key sets, code tables, role-playing
dimensions, unknown members, unmatched reports, new-file detection, links."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.functions.links import HREF_PATTERN, QUOTES, extract_links
from punctua.operators.contract import conformed, contract_report
from punctua.operators.joins import (
    bounded_broadcast, keys_missing_from, lookup_keys, resolve_surrogate, role_playing, surrogate_key,
)
from punctua.plans.flights import FLIGHTS_SQL, flights
from punctua.plans.registry import query
from punctua.plans.silver_q import _NAME_SQL
from punctua.tables import Tables


@query("in_list_lookup", sql="""
SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier
WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R')
""")
def q_in_list_lookup(spark: SparkSession, sf_dir: str):
    """Coordinates-style lookup for a key set computed by Spark (no collect)."""
    t = Tables(spark, sf_dir)
    wanted = t.lineitem.filter(F.col("l_returnflag") == "R").select("l_suppkey").distinct()
    return lookup_keys(t.supplier, wanted, "s_suppkey", "l_suppkey", ["s_suppkey", "s_nationkey", "s_acctbal"])


@query("code_lookup", sql="""
SELECT c_custkey, code, n_name AS description FROM (
  SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_nationkey + 100 ELSE c_nationkey END AS code FROM customer)
LEFT JOIN nation ON code = n_nationkey
""")
def q_code_lookup(spark: SparkSession, sf_dir: str):
    """Code -> description through a bounded code table; unknown codes keep a NULL text."""
    t = Tables(spark, sf_dir)
    c = t.customer.select("c_custkey", F.when(F.col("c_acctbal") < 0, F.col("c_nationkey") + 100)
                          .otherwise(F.col("c_nationkey")).alias("code"))
    codes = bounded_broadcast(t.nation.select(F.col("n_nationkey").alias("_code"),
                                              F.col("n_name").alias("description")))
    return c.join(codes, c.code == codes._code, "left").drop("_code")


@query("role_playing_dim", sql=f"""
WITH {FLIGHTS_SQL}
SELECT order_key, line_number, carrier, origin, o.n_name AS origin_n_name, o.n_regionkey AS origin_n_regionkey,
       destination, d.n_name AS destination_n_name, d.n_regionkey AS destination_n_regionkey
FROM f LEFT JOIN nation o ON f.origin = o.n_nationkey LEFT JOIN nation d ON f.destination = d.n_nationkey
""")
def q_role_playing_dim(spark: SparkSession, sf_dir: str):
    t = Tables(spark, sf_dir)
    f = flights(t).select("order_key", "line_number", "carrier", "origin", "destination")
    return role_playing(f, t.nation, "n_nationkey", {"origin": "origin", "destination": "destination"},
                        ["n_name", "n_regionkey"])


@query("unmatched_report", sql="""
SELECT key, side FROM (
  SELECT DISTINCT c_custkey AS key, 'no_orders' AS side FROM customer
  WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
  UNION ALL
  SELECT DISTINCT o_custkey, 'unknown_customer' FROM orders
  WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0))
""")
def q_unmatched_report(spark: SparkSession, sf_dir: str):
    """Customers (with a non-negative balance) vs finished orders: keys on one side only."""
    t = Tables(spark, sf_dir)
    cust = t.customer.filter(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("key"))
    allc = t.customer.select(F.col("c_custkey").alias("key"))
    fin = t.orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("key"))
    return (keys_missing_from(allc, fin, "key", "no_orders")
            .unionByName(keys_missing_from(fin, cust, "key", "unknown_customer")))


@query("unknown_member", sql="""
SELECT o_orderkey AS order_key, o_custkey AS customer_key,
       CASE WHEN c_custkey IS NULL THEN -1 ELSE c_custkey END AS dim_customer_key,
       c_custkey IS NULL AS is_unknown
FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey
""")
def q_unknown_member(spark: SparkSession, sf_dir: str):
    """Orders -> customer dimension (accounts in good standing) with a ``-1`` member."""
    t = Tables(spark, sf_dir)
    dim = (t.customer.filter(F.col("c_acctbal") >= 0)
           .select(surrogate_key("c_custkey").alias("customer_sk"), F.col("c_custkey").alias("dim_customer_key")))
    o = t.orders.select(F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer_key"))
    r = resolve_surrogate(o, dim, "customer_key", "dim_customer_key", "customer_sk", {"dim_customer_key": -1})
    return r.select("order_key", "customer_key", "dim_customer_key", (F.col("customer_sk") == -1).alias("is_unknown"))


@query("new_files_anti", sql=f"""
WITH listing AS (SELECT DISTINCT {_NAME_SQL} AS file_name FROM documents),
manifest AS (SELECT DISTINCT {_NAME_SQL} AS file_name FROM documents
             WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT file_name FROM listing WHERE file_name NOT IN (SELECT file_name FROM manifest)
""")
def q_new_files_anti(spark: SparkSession, sf_dir: str):
    """Listed files not yet in the landing manifest (``left_anti``)."""
    t = Tables(spark, sf_dir)
    name = F.expr(_NAME_SQL.replace("VARCHAR", "STRING")).alias("file_name")
    docs = t.documents.select("doc_id", "source")
    listing = docs.select(name).distinct()
    manifest = docs.join(t.labels.select("doc_id"), "doc_id", "left_semi").select(name).distinct()
    return listing.join(manifest, "file_name", "left_anti")


_RESOLVE_SQL = """
CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN href
     WHEN starts_with(href, '//') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1) || ':' || href
     WHEN starts_with(href, '/') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1) || href
     ELSE regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1)
          || coalesce(nullif(regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1),
                                            '^(.*/)', 1), ''), '/') || href END"""


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


@query("extract_links", sql=f"""
WITH h AS (SELECT page_id, url, list_transform(regexp_extract_all(html, '{_quoted(HREF_PATTERN)}', 1),
                                               lambda x: regexp_replace(x, '{_quoted(QUOTES)}', '', 'g')) AS hs FROM pages),
u AS (SELECT page_id, url, unnest(hs) AS href, unnest(range(0, len(hs))) AS link_pos FROM h)
SELECT page_id, link_pos, href, {_RESOLVE_SQL} AS link_url,
       CASE WHEN ends_with(href, '/') THEN 'folder' WHEN ends_with(lower(href), '.csv') THEN 'file'
            ELSE 'other' END AS kind
FROM u WHERE href NOT IN ('../', './') AND NOT starts_with(href, '?') AND NOT starts_with(href, '#')
""")
def q_extract_links(spark: SparkSession, sf_dir: str):
    return extract_links(Tables(spark, sf_dir).pages)


def orders_feed(t: Tables):
    """``orders`` as a feed that has left its contract: a column short, one of another type, one too many, some NULLs."""
    k = F.col("o_orderkey")
    return t.orders.select(
        k.alias("order_key"), F.when(k % 10 != 0, F.col("o_custkey")).alias("customer_key"),
        F.when(k % 7 == 0, F.concat(F.lit("R$ "), F.col("o_totalprice").cast("string"))).when(k % 11 != 0, F.col("o_totalprice").cast("string"))
        .alias("total"), F.col("o_orderstatus").alias("note"))


#: What the feed is to hold.
ORDERS_CONTRACT = T.StructType([
    T.StructField("order_key", T.LongType(), False), T.StructField("customer_key", T.LongType(), False),
    T.StructField("total", T.DoubleType()), T.StructField("status", T.StringType())])

_FEED_SQL = """
feed AS (SELECT o_orderkey AS order_key, CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS customer_key,
                CASE WHEN o_orderkey % 7 = 0 THEN 'R$ ' || CAST(o_totalprice AS VARCHAR)
                     WHEN o_orderkey % 11 <> 0 THEN CAST(o_totalprice AS VARCHAR) END AS total FROM orders)"""


@query("contract_report", sql=f"""
WITH {_FEED_SQL}
SELECT 'order_key' AS column, 'null' AS problem, 'not null' AS expected, 'nullable' AS actual, count(*) FILTER (order_key IS NULL) AS bad_rows FROM feed
UNION ALL SELECT 'customer_key', 'null', 'not null', 'nullable', count(*) FILTER (customer_key IS NULL) FROM feed
UNION ALL SELECT 'total', 'type', 'double', 'string', count(*) FILTER (total IS NOT NULL AND TRY_CAST(total AS DOUBLE) IS NULL) FROM feed
UNION ALL SELECT 'status', 'missing', 'string', NULL, count(*) FROM feed
UNION ALL SELECT 'note', 'extra', NULL, 'string', 0 FROM feed GROUP BY 1
""")
def q_contract_report(spark: SparkSession, sf_dir: str):
    """Where a feed differs from its contract, and in how many rows it matters."""
    return contract_report(orders_feed(Tables(spark, sf_dir)), ORDERS_CONTRACT)


@query("contract_conformed", sql=f"""
WITH {_FEED_SQL}
SELECT order_key, customer_key, TRY_CAST(total AS DOUBLE) AS total FROM feed
WHERE customer_key IS NOT NULL AND (total IS NULL OR TRY_CAST(total AS DOUBLE) IS NOT NULL)
""")
def q_contract_conformed(spark: SparkSession, sf_dir: str):
    """The rows of the feed that keep the contract for the columns it has, in the contract's types."""
    have = T.StructType([f for f in ORDERS_CONTRACT.fields if f.name != "status"])
    return conformed(orders_feed(Tables(spark, sf_dir)), have)
