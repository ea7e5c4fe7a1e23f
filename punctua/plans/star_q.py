"""The star composed: a flight fact with dimension lookups, a type-2 lookup and both delays, and flights with weather."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from punctua.operators.calendar import date_key
from punctua.operators.joins import point_in_time, resolve_surrogate, surrogate_key, with_unknown_member
from punctua.operators.scd2 import scd2_from_cdc
from punctua.operators.timeseries import MICROS_PER_DAY
from punctua.plans.flights import FLIGHTS_SQL, valid_flights
from punctua.plans.registry import query
from punctua.session import materialize
from punctua.tables import Tables

# Fixed values of the role mapping: an unnamed carrier, airports outside the network, described situations, tiers.
NO_CARRIER = "4-NOT SPECIFIED"
OUTSIDE_REGION = 4
SITUATIONS = {"F": "flown", "P": "cancelled"}
GOLD_FARE = 250_000
UNKNOWN = "UNKNOWN"
TURNAROUND_MINUTES = 120


def carrier_dim(t: Tables):
    named = t.orders.select(F.col("o_orderpriority").alias("carrier_name")).where(
        F.col("carrier_name") != NO_CARRIER).distinct()
    return with_unknown_member(named.select(surrogate_key("carrier_name").alias("carrier_sk"), "carrier_name"),
                               "carrier_sk", {"carrier_name": UNKNOWN})


def airport_dim(t: Tables):
    network = t.nation.where(F.col("n_regionkey") != OUTSIDE_REGION)
    return with_unknown_member(network.select(surrogate_key("n_nationkey").alias("airport_sk"), "n_nationkey",
                                              F.col("n_name").alias("airport_name")),
                               "airport_sk", {"airport_name": UNKNOWN})


def situation_dim(t: Tables):
    codes = t.orders.select(F.col("o_orderstatus").alias("code")).where(F.col("code").isin(*SITUATIONS)).distinct()
    label = F.create_map(*[F.lit(x) for kv in SITUATIONS.items() for x in kv])
    return with_unknown_member(codes.select(surrogate_key("code").alias("situation_sk"), "code", label[F.col("code")]
                                            .alias("situation")), "situation_sk", {"situation": UNKNOWN})


def destination_tiers(t: Tables):
    """Type-2 history of each destination's tier: gold while its last order was a dear one."""
    o = t.orders.select("o_custkey", "o_orderdate", F.when(F.col("o_totalprice") >= GOLD_FARE, "gold")
                        .otherwise("standard").alias("tier"))
    c = t.customer.select("c_custkey", "c_nationkey")
    changes = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_nationkey").alias("place"), F.unix_micros("o_orderdate").alias("at"), "o_orderdate", "tier")
    return scd2_from_cdc(changes, "place", "at", "o_orderdate", ["tier"], F.lit(False), seq_bucket=30 * MICROS_PER_DAY)


@query("fact_flight_star", sql=f"""
WITH {FLIGHTS_SQL},
ev AS (SELECT c_nationkey AS place, o_orderdate AS since,
              min(CASE WHEN o_totalprice >= {GOLD_FARE} THEN 'gold' ELSE 'standard' END) AS tier
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
ch AS (SELECT *, lag(tier) OVER (PARTITION BY place ORDER BY since) AS p FROM ev),
v AS (SELECT place, tier, since, lead(since) OVER (PARTITION BY place ORDER BY since) AS until
      FROM ch WHERE p IS NULL OR p <> tier)
SELECT order_key, line_number,
       CAST(year(planned_ts) * 10000 + month(planned_ts) * 100 + day(planned_ts) AS INTEGER) AS date_key,
       CASE WHEN carrier = '{NO_CARRIER}' THEN '{UNKNOWN}' ELSE carrier END AS carrier_name,
       coalesce(a.n_name, '{UNKNOWN}') AS origin_name, coalesce(b.n_name, '{UNKNOWN}') AS destination_name,
       CASE s.o_orderstatus WHEN 'F' THEN 'flown' WHEN 'P' THEN 'cancelled' ELSE '{UNKNOWN}' END AS situation,
       CAST((CASE WHEN carrier = '{NO_CARRIER}' THEN 1 ELSE 0 END) + (CASE WHEN a.n_name IS NULL THEN 1 ELSE 0 END)
            + (CASE WHEN b.n_name IS NULL THEN 1 ELSE 0 END)
            + (CASE WHEN s.o_orderstatus IN ('F', 'P') THEN 0 ELSE 1 END) AS INTEGER) AS n_unknown,
       v.tier AS destination_tier, v.since AS tier_since,
       round(delay_min, 6) AS departure_delay_min, round(delay_min + quantity - {TURNAROUND_MINUTES}, 6) AS arrival_delay_min
FROM f JOIN (SELECT o_orderkey, o_orderstatus FROM orders) s ON f.order_key = s.o_orderkey
LEFT JOIN nation a ON f.origin = a.n_nationkey AND a.n_regionkey <> {OUTSIDE_REGION}
LEFT JOIN nation b ON f.destination = b.n_nationkey AND b.n_regionkey <> {OUTSIDE_REGION}
LEFT JOIN v ON f.destination = v.place AND v.since <= f.real_ts AND (v.until IS NULL OR f.real_ts < v.until)
""")
def q_fact_flight_star(spark: SparkSession, sf_dir: str):
    """Flights with carrier, both airports and situation by surrogate key (-1: unknown member), the destination's tier
    valid at the actual departure, and both delays. Natural names come along in each lookup's own join."""
    t = Tables(spark, sf_dir)
    f = valid_flights(t).select("order_key", "line_number", "carrier", "origin", "destination", "planned_ts", "real_ts",
                                "delay_min", "quantity", "status")
    places = airport_dim(t)
    f = resolve_surrogate(f, carrier_dim(t), "carrier", "carrier_name", "carrier_sk", {"carrier_name": UNKNOWN})
    for role in ("origin", "destination"):
        role_dim = places.select("n_nationkey", F.col("airport_sk").alias(f"{role}_sk"),
                                 F.col("airport_name").alias(f"{role}_name"))
        f = resolve_surrogate(f, role_dim, role, "n_nationkey", f"{role}_sk", {f"{role}_name": UNKNOWN})
    f = resolve_surrogate(f, situation_dim(t), "status", "code", "situation_sk", {"situation": UNKNOWN})
    # the history is a dimension table: written once, then read in two branches of the as-of join
    tiers = materialize(destination_tiers(t), "tiers").select("place", F.col("tier").alias("destination_tier"), F.col("valid_from_seq").alias("v_from"),
                                        F.col("valid_to_seq").alias("v_to"), F.col("valid_from_ts").alias("tier_since"))
    f = point_in_time(f.withColumn("real_us", F.unix_micros("real_ts")), tiers, "destination", "real_us", "place", "v_from",
                      "v_to", bucket_size=30 * MICROS_PER_DAY)
    keys = ["carrier_sk", "origin_sk", "destination_sk", "situation_sk"]
    n_unknown = sum(((F.col(k) == -1).cast("int") for k in keys), F.lit(0))
    return f.select("order_key", "line_number", date_key(F.col("planned_ts")).alias("date_key"), "carrier_name",
                    "origin_name", "destination_name", "situation", n_unknown.alias("n_unknown"), "destination_tier",
                    "tier_since", F.round("delay_min", 6).alias("departure_delay_min"),
                    F.round(F.col("delay_min") + F.col("quantity") - TURNAROUND_MINUTES, 6).alias("arrival_delay_min"))


@query("flight_weather", sql=f"""
WITH {FLIGHTS_SQL},
w AS (SELECT CAST(user_id % 25 AS INTEGER) AS station, day(ts) AS d, hour(ts) AS h, avg(value) AS temperature,
             sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) AS rain_mm
      FROM events GROUP BY 1, 2, 3),
g AS (SELECT order_key, line_number, origin, destination, day(real_ts) AS d,
             CAST(order_key % 24 AS INTEGER) AS dep_h, CAST((order_key + 2) % 24 AS INTEGER) AS arr_h FROM f
      WHERE carrier IS NOT NULL AND origin IS NOT NULL AND planned_ts IS NOT NULL)
SELECT order_key, line_number, origin, destination, round(a.temperature, 6) AS origin_temperature,
       round(a.rain_mm, 6) AS origin_rain_mm, round(b.temperature, 6) AS destination_temperature,
       round(b.rain_mm, 6) AS destination_rain_mm
FROM g LEFT JOIN w a ON g.origin = a.station AND g.d = a.d AND g.dep_h = a.h
LEFT JOIN w b ON g.destination = b.station AND g.d = b.d AND g.arr_h = b.h
""")
def q_flight_weather(spark: SparkSession, sf_dir: str):
    """Flights with the hourly weather at origin (departure hour) and destination (arrival hour).

    ``events`` are the stations' readings (station = user modulo airports). They cover one month that no flight is in, so
    hours meet by day of the month; the order key gives the departure hour, as dates have none.
    """
    t = Tables(spark, sf_dir)
    readings = t.events.select((F.col("user_id") % 25).cast("int").alias("station"), F.dayofmonth("ts").alias("w_day"),
                               F.hour("ts").alias("w_hour"), "value", (F.col("event_type") == "purchase").alias("rain"))
    w = readings.groupBy("station", "w_day", "w_hour").agg(
        F.avg("value").alias("temperature"), F.sum(F.when(F.col("rain"), F.col("value")).otherwise(0)).alias("rain_mm"))
    f = valid_flights(t).select("order_key", "line_number", "origin", "destination", F.dayofmonth("real_ts").alias("day"),
                                (F.col("order_key") % 24).cast("int").alias("origin_hour"),
                                ((F.col("order_key") + 2) % 24).cast("int").alias("destination_hour"))
    for role in ("origin", "destination"):
        side = w.select(*[F.col(c).alias(f"{role}_{c}") for c in w.columns])
        f = f.join(side, (F.col(role) == F.col(f"{role}_station")) & (F.col("day") == F.col(f"{role}_w_day"))
                   & (F.col(f"{role}_hour") == F.col(f"{role}_w_hour")), "left")
    return f.select("order_key", "line_number", "origin", "destination", *[
        F.round(f"{role}_{c}", 6).alias(f"{role}_{c}") for role in ("origin", "destination") for c in ("temperature", "rain_mm")])
