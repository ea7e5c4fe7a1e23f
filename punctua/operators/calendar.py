"""Calendar and clock dimensions / features (built-in date functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# National fixed-date holidays (month, day) and high-season months.
FIXED_HOLIDAYS = [(1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (12, 25)]
HIGH_SEASON_MONTHS = [1, 7, 12]
# Period of day by hour (start hour inclusive).
DAY_PERIODS = [(0, "night"), (6, "morning"), (12, "afternoon"), (18, "evening")]


def iso_weekday(d: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return ((F.dayofweek(d) + 5) % 7 + 1).cast("int")


def is_holiday(d: Column) -> Column:
    md = F.month(d) * 100 + F.dayofmonth(d)
    return md.isin(*[m * 100 + dd for m, dd in FIXED_HOLIDAYS])


def is_high_season(d: Column) -> Column:
    return F.month(d).isin(*HIGH_SEASON_MONTHS)


def day_period(hour: Column) -> Column:
    expr = None
    for start, label in reversed(DAY_PERIODS):
        expr = F.when(hour >= start, F.lit(label)) if expr is None else expr.when(hour >= start, F.lit(label))
    return expr


def date_key(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(d: Column) -> dict[str, Column]:
    return {
        "date_key": date_key(d),
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "iso_weekday": iso_weekday(d),
        "is_weekend": iso_weekday(d) >= 6,
        "is_holiday": is_holiday(d),
        "is_high_season": is_high_season(d),
    }


def dim_date(bounds: DataFrame, lo: str, hi: str) -> DataFrame:
    """One row per day between the two DATE columns of a one-row ``bounds`` frame.

    The row count is calendar-bounded (days in the data's range), so the
    generator runs in a single task without a shuffle.
    """
    days = bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi))).alias("date"))
    return days.select("date", *[e.alias(n) for n, e in calendar_columns(F.col("date")).items()])
