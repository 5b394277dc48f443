"""Column functions on dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Days between payouts of each cadence.
CADENCE_DAYS = {"DAILY": 30, "MONTHLY": 30, "QUARTERLY": 91, "SEMI_ANNUAL": 182, "ANNUAL": 365}


def month_end_within(day: Column, days: int) -> Column:
    """Whether ``day`` is one of the last ``days`` days of its month."""
    return F.datediff(F.last_day(day), day) < days


def in_season(day: Column, start: tuple[int, int], end: tuple[int, int]) -> Column:
    """Whether ``day`` lies between two (month, day) of any year, both included; the season may wrap over the year's end."""
    at = F.month(day) * 100 + F.dayofmonth(day)
    lo, hi = start[0] * 100 + start[1], end[0] * 100 + end[1]
    return (at >= lo) & (at <= hi) if lo <= hi else (at >= lo) | (at <= hi)


def cadence_days(cadence: Column) -> Column:
    """Expected days between payouts; of unknown cadences those of a quarter."""
    table = F.create_map(*(F.lit(x) for pair in CADENCE_DAYS.items() for x in pair))
    return F.coalesce(F.try_element_at(table, F.upper(cadence)), F.lit(CADENCE_DAYS["QUARTERLY"]))


def cadence_of(median_gap: Column) -> Column:
    """The cadence a median gap in days stands for."""
    return F.when(median_gap <= 45, "MONTHLY").when(median_gap <= 120, "QUARTERLY").when(median_gap <= 240, "SEMI_ANNUAL").when(median_gap.isNotNull(), "ANNUAL")


def months_between_days(start: Column, end: Column) -> Column:
    """``array<date>``: the first day of each month from that of ``start`` to that of ``end``; [] if end is before start."""
    first, last = F.trunc(start, "month"), F.trunc(end, "month")
    return F.when(start <= end, F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).otherwise(F.array().cast("array<date>"))


def month_windows(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row per calendar month that [start, end] touches: window_start and window_end, cut to the range at both ends."""
    wide = df.withColumn("__m", F.explode(months_between_days(F.col(start), F.col(end))))
    return wide.withColumn("window_start", F.greatest(F.col("__m"), F.col(start))).withColumn("window_end", F.least(F.last_day("__m"), F.col(end))).drop("__m")


def leap_year(year: Column) -> Column:
    return F.dayofmonth(F.last_day(F.make_date(year, F.lit(2), F.lit(1)))) == 29


def trailing_months(day: Column, months: int) -> Column:
    """The same day ``months`` months before, or its month's last day if it has no such day."""
    return F.add_months(day, -months)
