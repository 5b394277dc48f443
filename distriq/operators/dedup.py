"""Keeping the first of equal rows, in a stated order, and keeping a table's rows unique across loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distriq.operators.ordered import latest


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Each key's first row by ``order``; NULLs in keys are equal to each other."""
    return latest(df, keys, order)


def by_content(df: DataFrame, content: str, order: list[str], values: list[str]) -> DataFrame:
    """(sha256, copies, values of the first): rows of equal content stored once. NULL contents are left out."""
    hashed = df.filter(F.col(content).isNotNull()).withColumn("sha256", F.sha2(F.col(content), 256))
    head = F.min(F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate(order)), *(F.col(v).alias(f"v{i}") for i, v in enumerate(values)))).alias("__h")
    return hashed.groupBy("sha256").agg(F.count(F.lit(1)).alias("copies"), head).select("sha256", "copies", *(F.col(f"__h.v{i}").alias(v) for i, v in enumerate(values)))


def not_yet_stored(fresh: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``fresh`` whose keys no row of ``stored`` has; NULL equals NULL."""
    a, b = fresh.alias("a"), stored.select(*keys).distinct().alias("b")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return a.join(b, on, "left_anti")


def snapshot_diff(before: DataFrame, after: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys, change): ADDED, REMOVED or CHANGED between two snapshots with unique keys; equal rows are left out."""
    a = before.select(*keys, F.struct(*values).alias("__a"))
    b = after.select(*keys, F.struct(*values).alias("__b"))
    change = F.when(F.col("__a").isNull(), "ADDED").when(F.col("__b").isNull(), "REMOVED").when(~F.col("__a").eqNullSafe(F.col("__b")), "CHANGED")
    return a.join(b, keys, "full").withColumn("change", change).filter(F.col("change").isNotNull()).select(*keys, "change")
