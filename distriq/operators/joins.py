"""Joins beyond equality: containment in intervals, the latest before, the first match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Buckets of the first size that an interval may touch; longer ones are met in buckets so many times as large.
SHORT, LONGER = 64, 512


def within_intervals(points: DataFrame, intervals: DataFrame, keys: list[str], point: str, start: str, end: str, how: str = "inner", bucket_days: int = 32) -> DataFrame:
    """Join ``points`` to the ``intervals`` of the same keys that contain them, both ends included.

    Days are cut into buckets; an interval is copied to each bucket it touches, a point lies in one: an equi-join on keys
    and bucket, and a comparison. Intervals of more than SHORT buckets, such as open ones, go by buckets LONGER times as
    large, so the copies of an interval are few however long it is. No pair is met twice. A plain range join would
    compare all pairs of a key. ``how``: inner, left_semi or left_anti. NULL ends contain nothing; an interval whose end
    is before its start neither.
    """
    touched = F.datediff(F.col(end).cast("date"), F.col(start).cast("date")) / F.lit(bucket_days)
    usable = intervals.filter(F.col(start) <= F.col(end))
    parts = [(usable.filter(touched <= SHORT), bucket_days), (usable.filter(touched > SHORT), bucket_days * LONGER)]

    def met(left: DataFrame, some: DataFrame, size: int, kind: str) -> DataFrame:
        day = lambda c: F.floor(F.unix_date(F.col(c).cast("date")) / F.lit(size))
        p = left.withColumn("__b", day(point)).alias("p")
        i = some.withColumn("__b", F.explode(F.sequence(day(start), day(end)))).alias("i")
        on = F.col("p.__b") == F.col("i.__b")
        for k in keys:
            on = on & (F.col(f"p.{k}") == F.col(f"i.{k}"))
        joined = p.join(i, on & F.col(f"p.{point}").between(F.col(f"i.{start}"), F.col(f"i.{end}")), kind)
        if kind != "inner":
            return joined.drop("__b")
        return joined.select(*(F.col(f"p.{c}") for c in points.columns), *(F.col(f"i.{c}") for c in intervals.columns if c not in keys))

    (short, size), (long, large) = parts
    if how == "left_anti":
        return met(met(points, short, size, how), long, large, how)
    if how == "left_semi":
        return met(points, short, size, how).union(met(met(points, short, size, "left_anti"), long, large, how))
    return met(points, short, size, how).union(met(points, long, large, how))


def as_of(left: DataFrame, right: DataFrame, keys: list[str], left_at: str, right_at: str, values: list[str], tie: str, bucket_days: int = 32) -> DataFrame:
    """``left`` with ``values`` of the latest ``right`` row of its keys not after it; NULLs if there is none.

    Both sides go through one window in time order, so no pair is made. The windows are cut into buckets of days, and
    each bucket begins with what the last one before it knew, so a key with a third of all rows is spread over the
    calendar. Times may be numbers, too; a bucket is as many units long then. Of right rows with equal time the one with the larger ``tie`` counts. Right rows whose keys or time are
    NULL match nothing; left rows are all kept, those without a time with NULLs.
    """
    days = F.unix_date(F.col("__at").cast("date")) if left.schema[left_at].dataType.typeName().startswith(("date", "timestamp")) else F.col("__at")
    bucket = F.floor(days / F.lit(bucket_days))
    known = F.struct(F.col("__at").alias("at"), F.col("__tie").alias("tie"), *(F.col(v).alias(f"v{i}") for i, v in enumerate(values)))
    one = left.withColumns({"__at": F.col(left_at), "__side": F.lit(1)})
    other = right.filter(F.col(right_at).isNotNull()).select(*keys, F.col(right_at).alias("__at"), F.lit(0).alias("__side"), F.col(tie).alias("__tie"), *[v for v in values if v not in keys])
    other = other.select(*keys, "__at", "__side", known.alias("__v"))
    both = one.unionByName(other, allowMissingColumns=True).withColumn("__b", bucket)
    ends = both.groupBy(*keys, "__b").agg(F.max("__v").alias("__end"))
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col("__b").alias("__kb"), F.last("__end", ignorenulls=True).over(before).alias("__carry"))
    on = F.col("__b").eqNullSafe(F.col("__kb"))
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    within = Window.partitionBy(*keys, "__b").orderBy("__at", "__side", F.col("__v.tie")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("__last", F.last("__v", ignorenulls=True).over(within)).filter("__side = 1").join(carried, on, "left")
    last = F.coalesce("__last", "__carry")
    usable = F.col("__at").isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    return found.select(*left.columns, *(F.when(usable, last[f"v{i}"]).alias(v) for i, v in enumerate(values)))


def lookup(df: DataFrame, dimension: DataFrame, keys: list[str], values: dict[str, Column | None]) -> DataFrame:
    """Left join to a dimension with one row per key; ``values``: column and what stands for it where nothing matches.

    Whether the dimension is broadcast is left to Spark, which knows its size.
    """
    joined = df.join(dimension.select(*keys, *values), keys, "left")
    return joined.withColumns({v: F.coalesce(F.col(v), d) for v, d in values.items() if d is not None})
