"""A price series of its own source, monthly with gaps, against the flights: filled, aligned to months, correlated at lags.

The series is made from ``events`` (the flights come from the order tables): purchases are dealt to months by their id, and a
month's value is their mean. Some months are not published. A month's value is known from the first day of the next month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctua.plans.flights import FLIGHTS_SQL, valid_flights
from punctua.plans.registry import query
from punctua.tables import Tables

# Query parameters: first month of the series, its months, which are not published, and the lags looked at.
FIRST_MONTH, MONTHS, GAP_EVERY, GAP_AT = "1995-01-01", 80, 7, 3
LAGS = 4


def monthly_price(t: Tables) -> DataFrame:
    """month, price: the published months."""
    k = (F.col("event_id") % MONTHS).cast("int")
    e = t.events.where((F.col("event_type") == "purchase") & (k % GAP_EVERY != GAP_AT))
    return (e.groupBy(F.add_months(F.lit(FIRST_MONTH).cast("date"), k).alias("month"))
            .agg(F.avg("value").alias("price")))


def month_fill(series: DataFrame, month: str, value: str, start, end) -> DataFrame:
    """``series`` on every month from ``start`` to ``end``, gaps carried forward; a row per calendar month."""
    spine = series.sparkSession.range(1).select(F.explode(F.sequence(
        F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 month"))).alias(month))
    w = Window.orderBy(month).rowsBetween(Window.unboundedPreceding, 0)  # calendar months, however long the input
    return spine.join(series.select(month, value), month, "left").withColumn(value, F.last(value, ignorenulls=True).over(w))


def price_at(prices: DataFrame, ts: Column) -> tuple[DataFrame, Column]:
    """Filled prices by the month from which they are known, and that month for ``ts`` (known strictly before it)."""
    known = prices.select(F.add_months("month", 1).alias("p_month"), "price")
    return known, F.trunc(F.timestamp_micros(F.unix_micros(ts) - 1), "month")


_PRICE_SQL = f"""
pm AS (SELECT CAST(DATE '{FIRST_MONTH}' + to_months(CAST(event_id % {MONTHS} AS INTEGER)) AS DATE) AS month, avg(value) AS price
       FROM events WHERE event_type = 'purchase' AND event_id % {MONTHS} % {GAP_EVERY} <> {GAP_AT} GROUP BY 1),
ms AS (SELECT CAST(DATE '{FIRST_MONTH}' + to_months(CAST(i AS INTEGER)) AS DATE) AS month FROM range({MONTHS}) r(i)),
pf AS (SELECT ms.month, last_value(pm.price IGNORE NULLS) OVER (ORDER BY ms.month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       AS price FROM ms LEFT JOIN pm ON pm.month = ms.month)"""


def filled_price(t: Tables) -> DataFrame:
    last = F.add_months(F.lit(FIRST_MONTH).cast("date"), MONTHS - 1)
    return month_fill(monthly_price(t), "month", "price", FIRST_MONTH, last)


@query("price_series_filled", sql=f"""
WITH {_PRICE_SQL}
SELECT pf.month, round(pm.price, 6) AS published, round(pf.price, 6) AS price FROM pf LEFT JOIN pm ON pm.month = pf.month
""")
def q_price_series_filled(spark: SparkSession, sf_dir: str):
    """Monthly prices on the full calendar, with what was published."""
    t = Tables(spark, sf_dir)
    published = monthly_price(t).select(F.col("month").alias("p_month"), F.round("price", 6).alias("published"))
    return filled_price(t).join(published, F.col("month") == F.col("p_month"), "left").select(
        "month", "published", F.round("price", 6).alias("price"))


@query("price_cancel_lags", sql=f"""
WITH {FLIGHTS_SQL}, {_PRICE_SQL},
m AS (SELECT carrier, CAST(date_trunc('month', planned_ts) AS DATE) AS month, count(*) AS n,
             avg(CASE WHEN cancelled THEN 1.0 ELSE 0.0 END) AS rate
      FROM f WHERE carrier IS NOT NULL AND origin IS NOT NULL AND planned_ts IS NOT NULL GROUP BY 1, 2),
j AS (SELECT carrier, lag, n, rate, price FROM m, range({LAGS}) l(lag)
      JOIN pf ON pf.month = CAST(m.month - to_months(CAST(lag AS INTEGER)) AS DATE) WHERE price IS NOT NULL)
SELECT carrier, CAST(lag AS INTEGER) AS lag, count(*) AS n_months, CAST(sum(n) AS BIGINT) AS flights,
       round(corr(price, rate), 6) AS corr_price_cancel
FROM j GROUP BY 1, 2
""")
def q_price_cancel_lags(spark: SparkSession, sf_dir: str):
    """Per carrier and lag of 0 to 3 months: correlation of the filled price with the monthly cancellation rate."""
    t = Tables(spark, sf_dir)
    f = valid_flights(t).select("carrier", "planned_ts", "cancelled")
    # flights are pre-aggregated to (carrier, month) before anything is joined
    m = f.groupBy("carrier", F.trunc("planned_ts", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.when(F.col("cancelled"), 1.0).otherwise(0.0)).alias("rate"))
    lagged = m.withColumn("lag", F.explode(F.sequence(F.lit(0), F.lit(LAGS - 1))))
    prices = filled_price(t).where("price IS NOT NULL").withColumnRenamed("month", "p_month")
    j = lagged.join(prices, F.add_months("month", -F.col("lag")) == F.col("p_month"))
    return j.groupBy("carrier", "lag").agg(F.count(F.lit(1)).alias("n_months"), F.sum("n").alias("flights"),
                                           F.round(F.corr("price", "rate"), 6).alias("corr_price_cancel"))
