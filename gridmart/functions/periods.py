"""Months, month windows and load labels."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart import feeds


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def period_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def slots_expected(
    first_day: Column,
    slots_per_day: int = feeds.SLOTS_PER_DAY,
    missing: dict[int, int] | None = None,
) -> Column:
    """Slots of a complete month, less those its calendar month lacks."""
    lacking = F.lit(0)
    for month, slots in (feeds.MISSING_SLOTS if missing is None else missing).items():
        lacking = F.when(F.month(first_day) == month, slots).otherwise(lacking)
    return F.dayofmonth(F.last_day(first_day)) * slots_per_day - lacking


def load_label(start: str | None, end: str | None) -> str:
    """Label of a requested window: ``full``, ``start/end``, ``start/`` or ``/end``."""
    return f"{start or ''}/{end or ''}" if start or end else "full"


def month_windows(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Contiguous windows ``[window_start, window_end[``, one per month, both months included.

    No row when ``start`` is after ``end``.
    """
    bounds = spark.range(1).select(
        F.lit(f"{start}-01").cast("date").alias("first"), F.lit(f"{end}-01").cast("date").alias("last")
    )
    # a sequence cannot run backwards
    month = F.explode(F.sequence("first", F.greatest("first", "last"), F.expr("interval 1 month")))
    return (
        bounds.select(month.alias("window_start"), "last")
        .where("window_start <= last")
        .select(
            period_text(F.col("window_start")).alias("label"),
            "window_start",
            F.add_months("window_start", 1).alias("window_end"),
        )
    )


def trailing_months(day: date, months: int = 3) -> tuple[str, str]:
    """Months to read again for revised series: from ``months`` before ``day`` to its own month."""
    index = day.year * 12 + day.month - 1 - months
    return f"{index // 12:04d}-{index % 12 + 1:02d}", f"{day:%Y-%m}"


def annual_year_to_load(day: date, last_published: int) -> int:
    """Year before ``day``, but no later than the last one published."""
    return min(day.year - 1, last_published)


def recent_bounds(now: datetime, minutes: int) -> tuple[datetime, datetime]:
    """Bounds of the half-open window ``[now - minutes, now[``."""
    return now - timedelta(minutes=minutes), now
