"""The calendar dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The default calendar range, inclusive.
FIRST_DAY, LAST_DAY = "2012-01-01", "2030-12-31"


def calendar_parts(day: Column) -> dict[str, Column]:
    """Calendar attributes of a date column, in table order."""
    weekday = F.weekday(day)
    return {
        "year": F.year(day).cast("bigint"),
        "month": F.month(day).cast("bigint"),
        "day_of_month": F.dayofmonth(day).cast("bigint"),
        "day_of_week": (weekday + 1).cast("bigint"),
        "day_name": F.date_format(day, "EEEE"),
        "day_name_short": F.date_format(day, "E"),
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "week_of_month": (F.floor((F.dayofmonth(day) - 1) / 7) + 1).cast("bigint"),
        "is_weekend": weekday >= 5,
        "is_weekday": weekday < 5,
    }


def expand_calendar(bounds: DataFrame) -> DataFrame:
    """One row per day of ``bounds(first_day, last_day)``; the key is the day's position, so no sort is needed."""
    days = bounds.select("first_day", F.explode(F.sequence("first_day", "last_day")).alias("full_date"))
    key = (F.date_diff("full_date", "first_day") + 1).cast("bigint")
    return days.select(
        key.alias("time_key"),
        "full_date",
        *(part.alias(name) for name, part in calendar_parts(F.col("full_date")).items()),
    )


def calendar(spark: SparkSession, first_day: str = FIRST_DAY, last_day: str = LAST_DAY) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(first_day).cast("date").alias("first_day"), F.lit(last_day).cast("date").alias("last_day")
    )
    return expand_calendar(bounds)
