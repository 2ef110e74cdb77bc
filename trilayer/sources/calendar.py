"""Calendar, clock and band dimensions, computed in parallel from a row range."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


# Fixed value: the key of the first calendar day.
FIRST_DATE_SK = 2415022


def _yes(condition: Column) -> Column:
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def build_date_dim(
    spark: SparkSession,
    start: date,
    days: int,
    holidays: Sequence[str] = ("01-01", "12-25"),
    today: date | None = None,
) -> DataFrame:
    """One row per day from ``start``; ``holidays`` are "MM-dd".

    ``d_last_dom`` is the day of the year on which the *next* month starts (1 for
    December) and ``d_first_dom`` that of the month's own first day. The current_*
    flags compare with ``today``; without it they are all N.
    """
    offset = F.col("id").cast("int")
    d, first = F.col("d"), F.trunc("d", "MM")
    year, quarter, week = F.year(d), F.quarter(d), F.floor(F.dayofyear(d) / 7) + 1
    is_holiday = lambda c: F.date_format(c, "MM-dd").isin(*holidays)
    now = F.lit(today).cast("date")
    same = lambda unit: _yes(F.coalesce(F.trunc(d, unit) == F.trunc(now, unit), F.lit(False)))
    bigints = {
        "d_month_seq": (year - 1900) * 12 + F.month(d),
        "d_week_seq": week,
        "d_quarter_seq": quarter + (year - 1998) * 4,
        "d_year": year,
        "d_dow": F.weekday(d),
        "d_moy": F.month(d),
        "d_dom": F.day(d),
        "d_qoy": quarter,
        "d_fy_year": year,
        "d_fy_quarter_seq": quarter,
        "d_fy_week_seq": week,
    }
    key = F.lit(FIRST_DATE_SK) + offset
    return spark.range(days).withColumn("d", F.date_add(F.lit(start), offset)).select(
        key.alias("d_date_sk"),
        F.concat(F.lit("AAAAAA"), F.date_format(d, "yyyyMMdd")).alias("d_date_id"),
        d.alias("d_date"),
        *[c.cast("bigint").alias(name) for name, c in bigints.items()],
        F.date_format(d, "EEEE").alias("d_day_name"),
        F.concat(year.cast("string"), F.lit("Q"), quarter.cast("string")).alias("d_quarter_name"),
        _yes(is_holiday(d)).alias("d_holiday"),
        _yes(F.weekday(d) >= 5).alias("d_weekend"),
        _yes(is_holiday(F.date_sub(d, 1))).alias("d_following_holiday"),
        F.dayofyear(first).cast("bigint").alias("d_first_dom"),
        F.dayofyear(F.add_months(first, 1)).cast("bigint").alias("d_last_dom"),
        (key - 365).alias("d_same_day_ly"),
        (key - 91).alias("d_same_day_lq"),
        _yes(F.coalesce(d == now, F.lit(False))).alias("d_current_day"),
        same("week").alias("d_current_week"),
        same("MM").alias("d_current_month"),
        same("quarter").alias("d_current_quarter"),
        same("year").alias("d_current_year"),
    )


def build_time_dim(spark: SparkSession) -> DataFrame:
    """One row per second of the day. The meal follows the hour, and the sub-shift is the meal or night."""
    second = F.col("t_time")
    hour = F.floor(second / 3600).cast("int")
    meal = F.when(hour.between(6, 9), "breakfast").when(hour.between(11, 13), "lunch").when(hour.between(17, 20), "dinner")
    return spark.range(86_400).select(F.col("id").cast("int").alias("t_time")).select(
        second.alias("t_time_sk"),
        F.concat(F.lit("T"), F.lpad(second.cast("string"), 8, "0")).alias("t_time_id"),
        "t_time",
        hour.alias("t_hour"),
        F.floor(second % 3600 / 60).cast("int").alias("t_minute"),
        (second % 60).alias("t_second"),
        F.when(hour < 12, "AM").otherwise("PM").alias("t_am_pm"),
        F.when(hour < 8, "first").when(hour < 16, "second").otherwise("third").alias("t_shift"),
        F.coalesce(meal, F.lit("night")).alias("t_sub_shift"),
        meal.alias("t_meal_time"),
    )


def build_income_bands(spark: SparkSession, bands: int = 20, width: int = 10_000) -> DataFrame:
    """Equal bands; each starts where the one before ends."""
    i = F.col("id").cast("int")
    return spark.range(bands).select(
        (i + 1).alias("ib_income_band_sk"),
        (i * width).alias("ib_lower_bound"),
        ((i + 1) * width).alias("ib_upper_bound"),
    )
