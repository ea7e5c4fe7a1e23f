"""Incremental planning as Spark plans (no per-key driver loops).

* :func:`next_windows` — per key, the next window to fetch: start = last
  fetched + 1 day (or a default start), end = today - lag; keys already up
  to date are skipped.  One left join of the whole key set to the control
  table.
* :func:`split_windows` — cut each window into contiguous, inclusive pieces
  of at most N years (anchor_1 = start + N years, anchor_k = anchor_1 +
  N(k-1) years; a 29 Feb start moves the anchors to 28 Feb for good).
* :func:`year_range` — one row per year of a range.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the upstream APIs.
MAX_YEARS_PER_REQUEST = 10
SERIES_LAG_DAYS = 1
WEATHER_LAG_DAYS = 7


def _date(d: dt.date | str | Column) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(d if isinstance(d, str) else d.isoformat()).cast("date")


def next_windows(keys: DataFrame, control: DataFrame, key: str, last_col: str,
                 default_start, today, lag_days: int) -> DataFrame:
    """keys: one row per key (e.g. series code, airport); control: key, last fetched date."""
    c = control.select(F.col(key), F.col(last_col).alias("last_fetched"))
    j = keys.select(key).join(c, key, "left")
    start = F.coalesce(F.date_add("last_fetched", 1), _date(default_start))
    end = F.date_sub(_date(today), lag_days)
    return (j.select(key, "last_fetched", start.alias("start_date"), end.alias("end_date"))
            .filter(F.col("start_date") <= F.col("end_date")))


def split_windows(df: DataFrame, start: str = "start_date", end: str = "end_date",
                  years: int = MAX_YEARS_PER_REQUEST) -> DataFrame:
    months = 12 * years
    first_anchor = F.add_months(F.col(start), months)
    n = F.greatest(F.ceil(F.months_between(F.col(end), F.col(start)) / months).cast("int"), F.lit(0)) + 1
    out = df.withColumn("window_no", F.explode(F.sequence(F.lit(0), n)))
    k = F.col("window_no")
    w_start = F.when(k == 0, F.col(start)).otherwise(F.add_months(first_anchor, (k - 1) * months))
    next_anchor = F.add_months(first_anchor, k * months)
    w_end = F.least(F.date_sub(next_anchor, 1), F.col(end))
    return (out.withColumn("window_start", w_start).withColumn("window_end", w_end)
            .filter(F.col("window_start") <= F.col(end)))


def year_range(df: DataFrame, first: str, last: str, out: str = "year") -> DataFrame:
    return df.withColumn(out, F.explode(F.sequence(F.col(first), F.col(last))))
