"""Calendar tables: one row per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HIERARCHY = ("Year", "Quarter", "Month", "Day")


def date_spine(df: DataFrame, start: Column | str, end: Column | str, name: str = "date") -> DataFrame:
    """Every day from ``start`` to ``end``, both included, per row of ``df``."""
    as_date = lambda d: (F.col(d) if isinstance(d, str) else d).cast("date")
    days = F.sequence(as_date(start), as_date(end), F.expr("interval 1 day"))
    return df.select(F.explode(days).alias(name))


def dim_date(days: DataFrame) -> DataFrame:
    """Reporting calendar over a ``date`` column; weeks start on Monday."""
    d = F.col("date")
    weekday = F.weekday(d) + 1
    return days.select(
        d,
        F.year(d).cast("smallint").alias("year"),
        F.month(d).cast("smallint").alias("month_number"),
        F.date_format(d, "MMM").alias("month_short"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.date_trunc("week", d).cast("date").alias("week_start"),
        weekday.cast("smallint").alias("day_of_week_number"),
        F.date_format(d, "E").alias("day_name"),
        weekday.isin(6, 7).alias("is_weekend"),
    )


def span(df: DataFrame, ts: str) -> DataFrame:
    """First and last day of a date or timestamp column, one row."""
    return df.agg(F.min(F.to_date(ts)).alias("first_day"), F.max(F.to_date(ts)).alias("last_day"))


def calendar(df: DataFrame, ts: str) -> DataFrame:
    """Whole years covering the column: January 1st to December 31st, with the
    levels of the date hierarchy."""
    ends = span(df, ts)
    days = date_spine(
        ends,
        F.make_date(F.year("first_day"), F.lit(1), F.lit(1)),
        F.make_date(F.year("last_day"), F.lit(12), F.lit(31)),
        "Date",
    )
    d = F.col("Date")
    return days.select(
        d,
        F.year(d).alias("Year"),
        F.month(d).alias("MonthNo"),
        F.date_format(d, "MMMM").alias("Month"),
        F.quarter(d).alias("QuarterNo"),
        F.concat(F.lit("Qtr "), F.quarter(d).cast("string")).alias("Quarter"),
        F.dayofmonth(d).alias("Day"),
    )


def by_level(df: DataFrame, ts: str, days: DataFrame, level: str, *aggregates: Column) -> DataFrame:
    """Aggregates at a level of the date hierarchy, joined on the date part."""
    upper = HIERARCHY[: HIERARCHY.index(level) + 1]
    keyed = df.join(days, F.to_date(ts) == F.col("Date"))
    return keyed.groupBy(*upper).agg(*aggregates)
