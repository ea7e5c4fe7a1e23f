"""Gold layer: facts, dimensions and BI aggregates over the flight model."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from punctua.functions.columns import local_to_utc
from punctua.operators.calendar import day_period, date_key, dim_date as build_dim_date, is_high_season, \
    is_holiday, iso_weekday
from punctua.functions.zones import instants, zone_changes
from punctua.operators.joins import bounded_broadcast
from punctua.session import checkpoint_dir, materialize
from punctua.sources.sheets import read_wide_sheet
from punctua.plans.flights import FLIGHTS_SQL, RAIN_THRESHOLD, valid_flights
from punctua.plans.registry import query
from punctua.tables import Tables

TOP_K = 10


def top_routes(f, k: int = TOP_K, threshold: float = RAIN_THRESHOLD):
    """Top-k routes by mean delay per carrier on rain days (cancelled excluded).

    One pass over the flights: they are pre-aggregated (map-side partial
    sums) to the (destination, day, carrier, origin) grain; the day's rain is
    a window over that small grain (at most carriers x origins rows per
    destination-day), so the fact is scanned once and no group can hold more
    than a bounded number of rows.
    """
    ok = ~F.col("cancelled")
    grain = (f.groupBy("destination", F.to_date("real_ts").alias("day"), "carrier", "origin")
             .agg(F.sum("quantity").alias("q"),
                  F.sum(F.when(ok, F.col("delay_min"))).alias("delay_sum"),
                  F.count(F.when(ok, F.lit(1))).alias("n")))
    rain = F.sum("q").over(Window.partitionBy("destination", "day"))
    on_rain = grain.withColumn("rain_mm", rain).filter((F.col("rain_mm") > F.lit(threshold)) & (F.col("n") > 0))
    agg = (on_rain.groupBy("carrier", "origin", "destination")
           .agg(F.round(F.sum("delay_sum") / F.sum("n"), 6).alias("avg_delay_min"),
                F.sum("n").alias("flights")))
    w = Window.partitionBy("carrier").orderBy(F.col("avg_delay_min").desc(), "origin", "destination")
    return (agg.withColumn("rank", F.row_number().over(w).cast("bigint"))
            .filter(F.col("rank") <= k))


@query("top_routes_delay", sql=f"""
WITH {FLIGHTS_SQL},
rain AS (
  SELECT destination, CAST(real_ts AS DATE) AS day FROM f GROUP BY ALL HAVING sum(quantity) > 40
),
agg AS (
  SELECT carrier, origin, destination, round(avg(delay_min), 6) AS avg_delay_min, count(*) AS flights
  FROM f WHERE NOT cancelled
    AND (destination, CAST(real_ts AS DATE)) IN (SELECT (destination, day) FROM rain)
  GROUP BY ALL
)
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY carrier ORDER BY avg_delay_min DESC, origin, destination) AS rank
  FROM agg) WHERE rank <= 10
""")
def top_routes_delay(spark: SparkSession, sf_dir: str):
    """Flagship: top-10 routes by mean departure delay on rain days, per carrier."""
    return top_routes(valid_flights(Tables(spark, sf_dir)))


# --------------------------------------------------------------------------- facts
_HOLIDAY_SQL = "(month(d) * 100 + day(d)) IN (101, 421, 501, 907, 1012, 1102, 1115, 1225)"


@query("fact_flight", sql=f"""
WITH {FLIGHTS_SQL}
SELECT order_key, line_number, carrier, origin, destination, CAST(planned_ts AS DATE) AS planned_date,
       CAST(year(planned_ts) * 10000 + month(planned_ts) * 100 + day(planned_ts) AS INTEGER) AS date_key,
       planned_ts, real_ts, round(delay_min, 6) AS delay_min, cancelled
FROM f WHERE carrier IS NOT NULL AND origin IS NOT NULL AND planned_ts IS NOT NULL
""")
def q_fact_flight(spark: SparkSession, sf_dir: str):
    """Flight fact: one row per flight (deduplicated), conformed keys and measures."""
    f = valid_flights(Tables(spark, sf_dir))
    return f.select("order_key", "line_number", "carrier", "origin", "destination",
                    F.to_date("planned_ts").alias("planned_date"), date_key(F.col("planned_ts")).alias("date_key"),
                    "planned_ts", "real_ts", F.round("delay_min", 6).alias("delay_min"), "cancelled")


@query("route_month_punctuality", sql=f"""
WITH {FLIGHTS_SQL}
SELECT origin, destination, CAST(date_trunc('month', planned_ts) AS DATE) AS month,
       count(*) AS flights, CAST(count_if(cancelled) AS BIGINT) AS cancelled,
       round(avg(CASE WHEN NOT cancelled THEN delay_min END), 6) AS avg_delay_min,
       round(avg(CASE WHEN NOT cancelled THEN CASE WHEN delay_min <= 15 THEN 1.0 ELSE 0.0 END END), 6) AS on_time_share
FROM f GROUP BY 1, 2, 3
""")
def q_route_month_punctuality(spark: SparkSession, sf_dir: str):
    f = valid_flights(Tables(spark, sf_dir))
    ok = ~F.col("cancelled")
    return (f.groupBy("origin", "destination", F.trunc("planned_ts", "month").alias("month"))
            .agg(F.count(F.lit(1)).alias("flights"),
                 F.count_if("cancelled").cast("bigint").alias("cancelled"),
                 F.round(F.avg(F.when(ok, F.col("delay_min"))), 6).alias("avg_delay_min"),
                 F.round(F.avg(F.when(ok, F.when(F.col("delay_min") <= 15, 1.0).otherwise(0.0))), 6)
                 .alias("on_time_share")))


@query("price_cancel_corr", sql=f"""
WITH {FLIGHTS_SQL},
m AS (SELECT carrier, date_trunc('month', planned_ts) AS month, avg(fare) AS avg_fare,
             avg(CASE WHEN cancelled THEN 1.0 ELSE 0.0 END) AS cancel_rate
      FROM f GROUP BY 1, 2)
SELECT carrier, count(*) AS n_months, round(corr(avg_fare, cancel_rate), 6) AS corr_fare_cancel
FROM m GROUP BY 1
""")
def q_price_cancel_corr(spark: SparkSession, sf_dir: str):
    """Per carrier: correlation of monthly mean fare with the monthly cancellation rate."""
    f = valid_flights(Tables(spark, sf_dir))
    m = (f.groupBy("carrier", F.date_trunc("month", "planned_ts").alias("month"))
         .agg(F.avg("fare").alias("avg_fare"),
              F.avg(F.when(F.col("cancelled"), 1.0).otherwise(0.0)).alias("cancel_rate")))
    return m.groupBy("carrier").agg(F.count(F.lit(1)).alias("n_months"),
                                    F.round(F.corr("avg_fare", "cancel_rate"), 6).alias("corr_fare_cancel"))


# Price table published per (nation, year) through this date only.
PRICE_PUBLISHED_BEFORE = "2000-01-01"


def annual_prices(t: Tables):
    o = t.orders.filter(F.col("o_orderdate") < F.lit(PRICE_PUBLISHED_BEFORE).cast("timestamp"))
    c = t.customer.select("c_custkey", "c_nationkey")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .groupBy(F.col("c_nationkey").alias("nation"), F.year("o_orderdate").alias("year"))
            .agg(F.avg("o_totalprice").alias("price")))


@query("grain_align", sql=f"""
WITH {FLIGHTS_SQL},
p AS (SELECT c_nationkey AS nation, year(o_orderdate) AS year, avg(o_totalprice) AS price
      FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE o_orderdate < TIMESTAMP '{PRICE_PUBLISHED_BEFORE}' GROUP BY 1, 2)
SELECT order_key, line_number, destination, CAST(year(planned_ts) AS INTEGER) AS planned_year,
       round(p.price, 6) AS annual_price, CASE WHEN p.price IS NOT NULL THEN 'year' END AS source_grain
FROM f LEFT JOIN p ON f.destination = p.nation AND year(f.planned_ts) = p.year
WHERE carrier IS NOT NULL AND origin IS NOT NULL AND planned_ts IS NOT NULL
""")
def q_grain_align(spark: SparkSession, sf_dir: str):
    """Annual price per destination nation attached to daily flights of that year only."""
    t = Tables(spark, sf_dir)
    f = valid_flights(t).select("order_key", "line_number", "destination",
                                F.year("planned_ts").alias("planned_year"))
    p = annual_prices(t)
    j = f.join(p, (f.destination == p.nation) & (f.planned_year == p.year), "left")
    return j.select("order_key", "line_number", "destination", "planned_year",
                    F.round("price", 6).alias("annual_price"),
                    F.when(F.col("price").isNotNull(), F.lit("year")).alias("source_grain"))


@query("unpivot_wide", sql="""
SELECT c_nationkey AS nation, CAST(year(o_orderdate) AS INTEGER) AS year,
       round(avg(o_totalprice), 2) AS price
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
""")
def q_unpivot_wide(spark: SparkSession, sf_dir: str):
    """A spreadsheet-like wide table (one text column per year, decimal comma) back to long form."""
    wide, years = wide_prices(Tables(spark, sf_dir))
    text = wide.select("nation", *[F.regexp_replace(F.round(f"y{y}", 2).cast("string"), r"\.", ",").alias(f"y{y}") for y in years])
    return unpivot_years(text, "nation", [f"y{y}" for y in years])


def wide_prices(t: Tables):
    """nation and one column of mean order prices per year (y1995 ...), with the years from the first order to the last."""
    o = t.orders.select("o_custkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    lo, hi = t.orders.agg(F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate"))).first()
    years = list(range(lo, hi + 1)) if lo else []  # known beforehand, so the join need not run to find them
    c = t.customer.select("c_custkey", "c_nationkey")
    wide = (o.join(c, o.o_custkey == c.c_custkey).groupBy(F.col("c_nationkey").alias("nation")).pivot("y", years)
            .agg(F.avg("o_totalprice")))
    return wide.toDF("nation", *[f"y{y}" for y in years]), years


@query("wide_sheet_prices", sql="""
SELECT CAST(c_nationkey AS VARCHAR) AS nation, CAST(year(o_orderdate) AS INTEGER) AS year, round(avg(o_totalprice), 2) AS price
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
""")
def q_wide_sheet_prices(spark: SparkSession, sf_dir: str):
    """The same prices published as two sheets: headers of two rows with a merged cell, amounts as currency text, and the years of
    the second sheet in the other order; read back by the sheet reader."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/sheets-{uuid.uuid4().hex}"
    wide, years = wide_prices(Tables(spark, sf_dir))
    wide = materialize(wide, "wide-prices")
    for k, (part, order) in enumerate(((F.col("nation") < 13, years), (F.col("nation") >= 13, years[::-1]))):
        amounts = [F.coalesce(F.concat(F.lit("R$ "), F.translate(F.format_number(F.round(f"y{y}", 2), 2), ",.", ".,")), F.lit("-")) for y in order]
        head = [(0, ";".join(["Nation", "Mean price"] + [""] * (len(order) - 1))), (1, ";".join(["", *map(str, order)]))]
        lines = spark.createDataFrame(head, "place int, line string").unionByName(
            wide.where(part).select(F.lit(2).alias("place"), F.concat_ws(";", F.col("nation").cast("string"), *amounts).alias("line")))
        # a sheet has a row per nation
        lines.coalesce(1).sortWithinPartitions("place").select("line").write.text(f"{root}/sheet{k}")
    long = read_wide_sheet(spark, root, header_rows=2, id_cols=1)
    return long.where("value IS NOT NULL").select("nation", F.regexp_extract("column", r"(\d{4})$", 1).try_cast("int").alias("year"),
                                                  F.col("value").alias("price"))


def unpivot_years(wide, id_col: str, year_cols):
    """Wide year columns -> (id, year, value); text numbers with decimal comma are cleaned."""
    long = wide.unpivot([id_col], list(year_cols), "year_col", "price_text")
    return (long.filter(F.col("price_text").isNotNull())
            .select(id_col, F.regexp_extract("year_col", r"(\d{4})", 1).try_cast("int").alias("year"),
                    F.regexp_replace(F.regexp_replace("price_text", r"\s", ""), ",", ".").try_cast("double")
                    .alias("price")))


# --------------------------------------------------------------------------- dimensions
@query("dim_date", sql=f"""
SELECT d AS date, CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS iso_weekday, isodow(d) >= 6 AS is_weekend,
       {_HOLIDAY_SQL} AS is_holiday, month(d) IN (1, 7, 12) AS is_high_season
FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d
      FROM orders)
""")
def q_dim_date(spark: SparkSession, sf_dir: str):
    o = Tables(spark, sf_dir).orders
    bounds = o.agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    return build_dim_date(bounds, "lo", "hi")


@query("dim_hour", sql="""
SELECT CAST(hour(ts) AS INTEGER) AS hour,
       CASE WHEN hour(ts) >= 18 THEN 'evening' WHEN hour(ts) >= 12 THEN 'afternoon'
            WHEN hour(ts) >= 6 THEN 'morning' ELSE 'night' END AS day_period,
       count(*) AS events
FROM events GROUP BY 1, 2
""")
def q_dim_hour(spark: SparkSession, sf_dir: str):
    """Hour-of-day dimension (period labels) with the event count seen in each hour."""
    e = Tables(spark, sf_dir).events
    return (e.groupBy(F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("events"))
            .withColumn("day_period", day_period(F.col("hour"))))


@query("calendar_features", sql=f"""
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) AS INTEGER) AS iso_weekday,
       CAST(month(ts) AS INTEGER) AS month, isodow(ts) >= 6 AS is_weekend,
       (month(ts) * 100 + day(ts)) IN (101, 421, 501, 907, 1012, 1102, 1115, 1225) AS is_holiday,
       month(ts) IN (1, 7, 12) AS is_high_season
FROM events
""")
def q_calendar_features(spark: SparkSession, sf_dir: str):
    e = Tables(spark, sf_dir).events
    d = F.col("ts")
    return e.select("event_id", F.hour(d).alias("hour"), iso_weekday(d).alias("iso_weekday"),
                    F.month(d).alias("month"), (iso_weekday(d) >= 6).alias("is_weekend"),
                    is_holiday(d).alias("is_holiday"), is_high_season(d).alias("is_high_season"))


# IANA zone of each nation key 0..24 (the zone table of the airports).
NATION_ZONES = [
    "America/Sao_Paulo", "America/Manaus", "America/Recife", "America/Noronha", "America/Cuiaba",
    "America/Rio_Branco", "America/Belem", "America/Fortaleza", "America/Bahia", "America/Campo_Grande",
    "America/Porto_Velho", "America/Boa_Vista", "America/Araguaina", "America/Maceio", "America/Santarem",
    "America/Eirunepe", "America/New_York", "America/Chicago", "America/Los_Angeles", "Europe/Lisbon",
    "Europe/London", "Europe/Madrid", "America/Argentina/Buenos_Aires", "America/Santiago", "Atlantic/Azores",
]

_ZONES_SQL = "(VALUES " + ", ".join(f"({i}, '{z}')" for i, z in enumerate(NATION_ZONES)) + ") AS z(nk, zone)"


@query("local_to_utc", sql=f"""
SELECT order_key, zone, local_ts,
       CASE WHEN timezone(zone, timezone('UTC', u_alt)) = local_ts THEN least(u, u_alt) ELSE u END AS utc_ts
FROM (SELECT o_orderkey AS order_key, zone, local_ts, timezone('UTC', timezone(zone, local_ts)) AS u,
             timezone('UTC', timezone(zone, local_ts - INTERVAL 1 HOUR)) + INTERVAL 1 HOUR AS u_alt
      FROM (SELECT o_orderkey, z.zone, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS local_ts
            FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN {_ZONES_SQL} ON c_nationkey = z.nk))
""")
def q_local_to_utc(spark: SparkSession, sf_dir: str):
    """Planned local times (customer nation's zone, DST history included) converted to UTC.

    A wall-clock time that occurs twice (DST fall-back) resolves to the earlier
    instant; one inside a spring-forward gap is shifted forward by the gap.
    """
    t = Tables(spark, sf_dir)
    zones = bounded_broadcast(spark.createDataFrame(list(enumerate(NATION_ZONES)), "nk int, zone string"))
    o = t.orders.select("o_orderkey", "o_custkey",
                        (F.col("o_orderdate") + F.make_interval(hours=(F.col("o_orderkey") % 24).cast("int")))
                        .alias("local_ts"))
    c = t.customer.select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey).join(zones, F.col("c_nationkey") == zones.nk, "left")
    return j.select(F.col("o_orderkey").alias("order_key"), "zone", "local_ts",
                    local_to_utc("local_ts", "zone").alias("utc_ts"))


# Query parameters: local quarter hours of the nights from Saturday on, over the weeks from FOLD_FROM to FOLD_UNTIL.
FOLD_FROM, FOLD_UNTIL, FOLD_WEEKS, FOLD_SLOTS = "2016-12-31", "2020-01-01", 156, 24

_LOCAL_SQL = f"""
lo AS (SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_partkey AS part_key, z.zone,
              TIMESTAMP '{FOLD_FROM} 22:00:00' + to_days(CAST(7 * (l_partkey % {FOLD_WEEKS}) AS INTEGER))
                + to_minutes(CAST(15 * ((l_orderkey + l_linenumber) % {FOLD_SLOTS}) AS INTEGER)) AS local_ts
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN {_ZONES_SQL} ON s_nationkey = z.nk)"""


@query("local_folds", sql=f"""
WITH {_LOCAL_SQL},
c AS (SELECT *, unnest([timezone('UTC', timezone(zone, local_ts)),
                        timezone('UTC', timezone(zone, local_ts - INTERVAL 2 HOUR)) + INTERVAL 2 HOUR,
                        timezone('UTC', timezone(zone, local_ts + INTERVAL 2 HOUR)) - INTERVAL 2 HOUR]) AS u FROM lo),
v AS (SELECT order_key, line_number, part_key, zone, local_ts, min(u) FILTER (ok) AS a, max(u) FILTER (ok) AS b, any_value(before) AS before
      FROM (SELECT *, timezone(zone, timezone('UTC', u)) = local_ts AS ok,
                   timezone('UTC', timezone(zone, local_ts - INTERVAL 2 HOUR)) + INTERVAL 2 HOUR AS before FROM c) GROUP BY ALL)
SELECT zone, local_ts, coalesce(a, before) AS first_utc, coalesce(b, before) AS second_utc, coalesce(a <> b, false) AS is_repeated,
       a IS NULL AS is_gap, count(*) AS n
FROM v GROUP BY ALL
""")
def q_local_folds(spark: SparkSession, sf_dir: str):
    """Local times in the nights in which clocks change, with both instants of repeated ones and skipped ones flagged; rows
    of one zone and time are counted, those that repeat order, line and part once."""
    t = Tables(spark, sf_dir)
    zones = spark.createDataFrame(list(enumerate(NATION_ZONES)), "nk int, zone string")
    changes = F.broadcast(zone_changes(zones, "zone", FOLD_FROM, FOLD_UNTIL))  # a row per zone
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").join(
        t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    j = li.join(bounded_broadcast(zones), F.col("s_nationkey") == F.col("nk"))
    minutes = 7 * 1440 * (F.col("l_partkey") % FOLD_WEEKS) + 15 * ((F.col("l_orderkey") + F.col("l_linenumber")) % FOLD_SLOTS)
    local = F.lit(f"{FOLD_FROM} 22:00:00").cast("timestamp") + F.make_interval(mins=minutes.cast("int"))
    # a row that comes twice counts once; few times per zone: counted before they are placed
    rows = j.select("l_orderkey", "l_linenumber", "l_partkey", "zone", local.alias("local_ts")).distinct()
    times = rows.groupBy("zone", "local_ts").agg(F.count(F.lit(1)).alias("n"))
    at = times.join(changes, F.col("zone") == F.col("z_zone")).withColumn("at", instants(F.col("local_ts"), F.col("z_first"), F.col("z_changes")))
    return at.select("zone", "local_ts", "at.*", "n")
