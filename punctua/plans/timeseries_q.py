"""Time-series queries over ``events``: forward fill, trailing rates, as-of
join, hourly join and daily roll-up."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from punctua.operators.timeseries import asof_join, daily_from_hourly, forward_fill, hourly, trailing_sums
from punctua.plans.registry import query
from punctua.tables import Tables

# Query parameters.
TRAILING_DAYS = 7


@query("forward_fill", sql="""
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS value FROM events
           WHERE event_type = 'purchase' GROUP BY 1, 2),
s AS (SELECT user_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day
      FROM (SELECT DISTINCT user_id FROM d), (SELECT min(day) AS lo, max(day) AS hi FROM d)),
j AS (SELECT s.user_id, s.day, d.value,
             last_value(d.value IGNORE NULLS) OVER (PARTITION BY s.user_id ORDER BY s.day
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f
      FROM s LEFT JOIN d ON s.user_id = d.user_id AND s.day = d.day)
SELECT user_id, day, round(value, 6) AS value, round(f, 6) AS value_filled,
       value IS NULL AND f IS NOT NULL AS is_filled
FROM j
""")
def q_forward_fill(spark: SparkSession, sf_dir: str):
    """Daily purchase value per user from the first to the last day of any purchase, gaps carried forward."""
    e = Tables(spark, sf_dir).events
    daily = (e.filter(F.col("event_type") == "purchase")
             .groupBy("user_id", F.to_date("ts").alias("day"))
             .agg(F.sum("value").alias("value")))
    out = forward_fill(daily, "user_id", "day", "value")
    return out.select("user_id", "day", F.round("value", 6).alias("value"),
                      F.round("value_filled", 6).alias("value_filled"), "is_filled")


@query("trailing_rate", sql=f"""
SELECT event_id, user_id, ts,
       count(*) OVER w AS n_prior,
       round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) OVER w, 6) AS error_rate
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts
             RANGE BETWEEN INTERVAL {TRAILING_DAYS} DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)
""")
def q_trailing_rate(spark: SparkSession, sf_dir: str):
    """Share of error events in each user's previous 7 days, excluding the event itself."""
    e = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts", "event_type")
    out = trailing_sums(e, None, "user_id", "ts", "ts", {"n_prior": F.lit(1), "n_errors": F.col("event_type") == "error"},
                        TRAILING_DAYS)
    return out.select("event_id", "user_id", "ts", "n_prior",
                      F.round(F.when(F.col("n_prior") > 0, F.col("n_errors") / F.col("n_prior")), 6).alias("error_rate"))


@query("asof_latest_before", sql="""
SELECT e.event_id, e.user_id, e.ts, e.event_type, s.s_event_id AS signup_event_id, s.s_ts AS signup_ts
FROM events e ASOF LEFT JOIN
     (SELECT user_id AS s_user, ts AS s_ts, event_id AS s_event_id FROM events WHERE event_type = 'signup') s
ON e.user_id = s.s_user AND e.ts > s.s_ts
""")
def q_asof_latest_before(spark: SparkSession, sf_dir: str):
    """For every event, the user's latest sign-up strictly before it."""
    e = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts", "event_type")
    signups = (e.filter(F.col("event_type") == "signup")
               .select("user_id", F.col("event_id").alias("signup_event_id"), F.col("ts").alias("signup_ts")))
    return asof_join(e, signups, "user_id", "ts", "signup_ts", ["signup_event_id", "signup_ts"],
                     tie="signup_event_id", strict=True, bucket_days=1.0)


_HOURLY_SQL = """
h AS (SELECT user_id, date_trunc('hour', ts) AS hour_ts, count(*) AS views, round(avg(value), 6) AS avg_view_value
      FROM events WHERE event_type = 'view' GROUP BY 1, 2)"""


def _hourly_views(e):
    return hourly(e.filter(F.col("event_type") == "view"), "user_id", "ts",
                  [F.count(F.lit(1)).alias("views"), F.round(F.avg("value"), 6).alias("avg_view_value")])


@query("hourly_join", sql=f"""
WITH {_HOURLY_SQL}
SELECT e.event_id, e.user_id, date_trunc('hour', e.ts) AS hour_ts, h.views, h.avg_view_value
FROM events e LEFT JOIN h ON e.user_id = h.user_id AND date_trunc('hour', e.ts) = h.hour_ts
WHERE e.event_type = 'purchase'
""")
def q_hourly_join(spark: SparkSession, sf_dir: str):
    """Each purchase with the same user's hourly 'view' readings (key + truncated hour)."""
    e = Tables(spark, sf_dir).events
    h = _hourly_views(e)
    p = (e.filter(F.col("event_type") == "purchase")
         .select("event_id", "user_id", F.date_trunc("hour", "ts").alias("hour_ts")))
    return p.join(h, ["user_id", "hour_ts"], "left").select("event_id", "user_id", "hour_ts", "views",
                                                            "avg_view_value")


@query("daily_from_hourly", sql="""
WITH h AS (SELECT user_id, date_trunc('hour', ts) AS hour_ts, sum(value) AS mm FROM events GROUP BY 1, 2)
SELECT user_id, CAST(hour_ts AS DATE) AS day, round(sum(mm), 6) AS rain_mm, round(max(mm), 6) AS max_hourly_mm,
       count(*) AS hours_with_data
FROM h GROUP BY 1, 2
""")
def q_daily_from_hourly(spark: SparkSession, sf_dir: str):
    """Hourly readings (sum of value per user-hour) rolled up to days."""
    e = Tables(spark, sf_dir).events
    h = hourly(e, "user_id", "ts", [F.sum("value").alias("mm")])
    return daily_from_hourly(h, "user_id", "hour_ts", [
        F.round(F.sum("mm"), 6).alias("rain_mm"), F.round(F.max("mm"), 6).alias("max_hourly_mm"),
        F.count(F.lit(1)).alias("hours_with_data")])
