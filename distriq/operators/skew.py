"""Equi-joins whose hot keys are split over several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rows of a key that one task joins, at most; and hot keys that are broadcast, at most.
TASK_ROWS, HOT_KEYS = 1_000_000, 100_000


def salted_join(many: DataFrame, one: DataFrame, keys: list[str], spread: list[str], counts: DataFrame, rows: str, how: str = "inner") -> DataFrame:
    """Join ``many`` to ``one``, which has each key once, with hot keys spread over several tasks.

    ``counts`` tells how many rows a key has in ``many`` (columns ``keys`` and ``rows``; to be cheap to read, as it is
    looked at first). A key with more than TASK_ROWS gets as many salts as it has TASK_ROWS: its rows a salt from the
    hash of ``spread``, its row in ``one`` a copy per salt. Other keys keep salt 0 and aren't copied. Hot keys are
    broadcast if there are at most HOT_KEYS of them, else joined. NULL keys match nothing.
    """
    hot = counts.filter(F.col(rows) > TASK_ROWS).select(*keys, F.ceil(F.col(rows) / TASK_ROWS).cast("int").alias("__salts"))
    found = hot.limit(HOT_KEYS + 1).count()
    if not found:
        return many.join(one, keys, how)
    mark = F.broadcast(hot) if found <= HOT_KEYS else hot
    salts = F.coalesce("__salts", F.lit(1))
    left = many.join(mark, keys, "left").withColumn("__salt", F.pmod(F.xxhash64(*spread), salts).cast("int"))
    right = one.join(mark, keys, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return left.drop("__salts").join(right.drop("__salts"), [*keys, "__salt"], how).drop("__salt")
