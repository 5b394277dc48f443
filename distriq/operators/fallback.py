"""Several ways to get rows, in order of preference."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_yielding(df: DataFrame, keys: list[str], readers: dict[str, Callable[[DataFrame], DataFrame]], route: str = "route") -> DataFrame:
    """Rows of the first reader that yields any for a key, with its name in ``route``; keys that no reader has rows for give none.

    Readers give frames of the same columns, among them ``keys``. All of them run on all keys, side by side, each with a
    scan of its own; which one was first is a minimum per key, joined back. NULL keys give no rows.
    """
    tagged = [reader(df).withColumns({"__rank": F.lit(i), route: F.lit(name)}) for i, (name, reader) in enumerate(readers.items())]
    rows = reduce(DataFrame.unionByName, tagged)
    best = rows.groupBy(*keys).agg(F.min("__rank").alias("__rank"))
    return rows.join(best, [*keys, "__rank"]).drop("__rank")


def with_fallback(primary: DataFrame, unresolved: str, keys: list[str], fallback: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``primary`` without its ``unresolved`` rows (an SQL condition), and what ``fallback`` makes of their keys.

    ``fallback`` sees the distinct unresolved keys only and gives the columns of ``primary``; a key it gives nothing
    for keeps its unresolved row. A condition that is NULL is none.
    """
    open_rows = primary.filter(f"coalesce({unresolved}, FALSE)")
    second = fallback(open_rows.select(*keys).distinct())
    kept = open_rows.join(second.select(*keys).distinct(), keys, "left_anti").select(*primary.columns)
    return primary.filter(f"NOT coalesce({unresolved}, FALSE)").unionByName(second.select(*primary.columns)).unionByName(kept)
