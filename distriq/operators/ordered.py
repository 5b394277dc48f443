"""Operators on rows in an order: latest, versions, previous values, runs, gaps.

All orders end in a column that makes them total, so results don't depend on the order rows arrive in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in ``order``. Spark limits each group before it shuffles (WindowGroupLimit)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")


def first_of(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """``values`` of each key's first row by ``order``, as an aggregate: partial results are combined before the shuffle, however hot the key."""
    head = F.min(F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate(order)), *(F.col(v).alias(f"v{i}") for i, v in enumerate(values)))).alias("__h")
    return df.groupBy(*keys).agg(head).select(*keys, *(F.col(f"__h.v{i}").alias(v) for i, v in enumerate(values)))


def with_versions(df: DataFrame, keys: list[str], order: list[Column], id_column: str) -> DataFrame:
    """Adds version_no (from 1), next_id (of the row that supersedes this one) and superseded."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({"version_no": F.row_number().over(w), "next_id": F.lead(id_column).over(w)}).withColumn("superseded", F.col("next_id").isNotNull())


def _with_carry(df: DataFrame, keys: list[str], bucket: Column, summary: Column, combine: Callable[[str], Column]) -> DataFrame:
    """``df`` with ``__b``, its bucket, and ``__carry``: what all earlier buckets of its keys add up to.

    Each bucket is first reduced to one row, so windows over whole keys see buckets only, and those over rows end at
    their buckets: a key with a third of all rows is spread over them. A NULL bucket comes first.
    """
    cut = df.withColumn("__b", bucket)
    ends = cut.groupBy(*keys, "__b").agg(summary.alias("__end"))
    before = Window.partitionBy(*keys).orderBy(F.col("__b").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col("__b").alias("__kb"), combine("__end").over(before).alias("__carry"))
    on = F.col("__b").eqNullSafe(F.col("__kb"))
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return cut.join(carried, on, "left").drop("__kb", *(f"__k{i}" for i in range(len(keys))))


def previous_value(df: DataFrame, keys: list[str], order: list[str], value: str, bucket: Column, out: str = "previous") -> DataFrame:
    """Adds the last value before this row that wasn't NULL, and ``changed``: NULL where there is none.

    ``order``: columns, smaller and NULL ones first. ``bucket``: rises with the first of them, such as its month.
    """
    place = F.struct(*(F.struct(F.col(c).isNotNull(), F.col(c)) for c in order))
    latest_known = F.max_by(F.col(value), F.when(F.col(value).isNotNull(), place))
    w = Window.partitionBy(*keys, "__b").orderBy(*(F.col(c).asc_nulls_first() for c in order)).rowsBetween(Window.unboundedPreceding, -1)
    carried = _with_carry(df, keys, bucket, latest_known, lambda c: F.last(c, ignorenulls=True))
    found = carried.withColumn(out, F.coalesce(F.last(value, ignorenulls=True).over(w), "__carry"))
    return found.withColumn("changed", F.col(value) != F.col(out)).drop("__b", "__carry")


def trailing_run(df: DataFrame, keys: list[str], at: str, flag: Column, out: str = "run") -> DataFrame:
    """(keys, out): how many of the latest rows in a row have ``flag``, by order of ``at``.

    The rows after the last without the flag, counted: two aggregates instead of a running sum. Rows with equal ``at``
    as that last one don't count.
    """
    marked = df.select(*keys, F.col(at).alias("__at"), F.coalesce(flag, F.lit(False)).alias("__f"))
    ends = marked.groupBy(*keys).agg(F.max(F.when(~F.col("__f"), F.col("__at"))).alias("__end"))
    joined = marked.join(ends, keys)
    return joined.groupBy(*keys).agg(F.count_if(F.col("__f") & (F.col("__end").isNull() | (F.col("__at") > F.col("__end")))).alias(out))


def running_max(df: DataFrame, keys: list[str], order: list[str], value: str, bucket: Column, out: str) -> DataFrame:
    """Adds the largest ``value`` of the key up to and including this row. ``order``, ``bucket``: as in :func:`previous_value`."""
    w = Window.partitionBy(*keys, "__b").orderBy(*(F.col(c).asc_nulls_first() for c in order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = _with_carry(df, keys, bucket, F.max(value), F.max)
    return carried.withColumn(out, F.greatest(F.max(value).over(w), F.col("__carry"))).drop("__b", "__carry")


def numbered(df: DataFrame, keys: list[str], order: list[Column], bucket: Column, out: str) -> DataFrame:
    """Adds each row's number within its key, from 1 in ``order``; ``bucket`` rises with the order's first column."""
    w = Window.partitionBy(*keys, "__b").orderBy(*order)
    carried = _with_carry(df, keys, bucket, F.count(F.lit(1)), F.sum)
    return carried.withColumn(out, (F.row_number().over(w) + F.coalesce("__carry", F.lit(0))).cast("long")).drop("__b", "__carry")


def month_gaps(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """(keys, day, gap): the first day of each month a key has, and the days since the one before; NULL for the first."""
    firsts = df.filter(F.col(day).isNotNull()).groupBy(*keys, F.trunc(day, "month").alias("__m")).agg(F.min(day).alias(day)).drop("__m")
    return firsts.withColumn("gap", F.datediff(day, F.lag(day).over(Window.partitionBy(*keys).orderBy(day))))


def missing_months(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """(keys, month): the calendar months between a key's first and last day in which it has none.

    Each month's distance to the next one seen tells how many are missing, so only these are made, not the whole range.
    """
    months = df.filter(F.col(day).isNotNull()).select(*keys, F.trunc(day, "month").alias("__m")).distinct()
    ahead = months.withColumn("__n", F.lead("__m").over(Window.partitionBy(*keys).orderBy("__m"))).filter(F.add_months("__m", 1) < F.col("__n"))
    return ahead.select(*keys, F.explode(F.sequence(F.add_months("__m", 1), F.add_months("__n", -1), F.expr("INTERVAL 1 MONTH"))).alias("month"))


def recent_within(df: DataFrame, keys: list[str], seconds_column: str, seconds: int, out: str = "recent") -> DataFrame:
    """Adds how many rows of the key lie in the last ``seconds`` up to and including each row's time.

    Time is cut into buckets no shorter than that; a row is also looked at from the next bucket, where it may still be
    recent, so a bucket knows all it needs and a key with a third of all rows is spread over time.
    """
    size = max(seconds, 1)
    here = F.floor(F.col(seconds_column) / F.lit(size))
    copies = df.withColumn("__own", F.explode(F.array(F.lit(True), F.lit(False)))).withColumn("__b", F.when(F.col("__own"), here).otherwise(here + 1))
    w = Window.partitionBy(*keys, "__b").orderBy(seconds_column).rangeBetween(-seconds, 0)
    return copies.withColumn(out, F.count(F.lit(1)).over(w)).filter("__own").drop("__own", "__b")
