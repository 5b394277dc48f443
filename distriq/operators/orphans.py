"""References to records that do not exist: missing, deleted, or stored only afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distriq.durable import durable
from distriq.operators.skew import salted_join

def reference_key(key: Column) -> Column:
    """The form in which keys are compared: no surrounding white space, one case; NULL if nothing is left."""
    return F.nullif(F.upper(F.regexp_replace(key, r"(?U)^\s+|\s+$", "")), F.lit(""))


def utc_month(at: Column) -> Column:
    """YYYY-MM of a timestamp in UTC, whatever the session's time zone is."""
    return F.date_format(F.date_from_unix_date(F.floor(F.unix_seconds(at) / 86400).cast("int")), "yyyy-MM")


def orphan_references(child: DataFrame, child_id: str, reference: str, child_time: str, parent: DataFrame, parent_key: str, parent_created: str, parent_deleted: str | None, label: str) -> DataFrame:
    """(child_table, child_id, kind, period) of each child row whose reference fails, each distinct row once.

    kind: MISSING, no parent row has the key; DELETED, every parent row with it is deleted; LATE, the child's time is
    before the earliest creation among the parent rows. A NULL or blank reference fails nothing; a child without a
    time is never LATE and has period ''; with ``parent_deleted`` None no parent is deleted. Either table may be empty.

    Both sides shrink to their distinct keys before they meet: the child's keys with their earliest time, the parent's
    with what decides the kind, each aggregated before it is shuffled. A left anti-join finds the missing keys, a join
    the others; only failing keys go back to the rows, a hot one in several tasks.
    """
    rows = child.select(F.col(f"`{child_id}`").cast("string").alias("child_id"), reference_key(F.col(f"`{reference}`")).alias("__key"), F.col(f"`{child_time}`").alias("__at")).filter(F.col("__key").isNotNull())
    keys = rows.groupBy("__key").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    deleted = F.lit(False) if parent_deleted is None else F.col(f"`{parent_deleted}`").isNotNull()
    parents = (
        parent.select(reference_key(F.col(f"`{parent_key}`")).alias("__key"), F.col(f"`{parent_created}`").alias("__created"), deleted.alias("__deleted"))
        .filter(F.col("__key").isNotNull())
        .groupBy("__key")
        .agg(F.min("__created").alias("__created"), F.every("__deleted").alias("__deleted"))
    )
    missing = keys.join(parents, "__key", "left_anti").select("__key", "__rows", F.lit("MISSING").alias("__kind"), F.lit(None).cast("timestamp").alias("__created"))
    present = (
        keys.join(parents, "__key")
        .filter(F.col("__deleted") | (F.col("__first") < F.col("__created")))
        .select("__key", "__rows", F.when(F.col("__deleted"), "DELETED").otherwise("LATE").alias("__kind"), F.col("__created").cast("timestamp").alias("__created"))
    )
    # written, as it is read for the hot keys and for the join
    failing = durable(missing.unionByName(present), "failing")
    back = salted_join(rows, failing.drop("__rows"), ["__key"], ["child_id", "__at"], failing, "__rows")
    kept = back.filter((F.col("__kind") != "LATE") | (F.col("__at") < F.col("__created")))
    return kept.select(F.lit(label).alias("child_table"), "child_id", F.col("__kind").alias("kind"), F.coalesce(utc_month(F.col("__at")), F.lit("")).alias("period")).distinct()


def orphan_counts(orphans: DataFrame) -> DataFrame:
    """(child_table, period, kind, n_orphans): the failing rows of :func:`orphan_references` per table, month and kind."""
    return orphans.groupBy("child_table", "period", "kind").agg(F.count(F.lit(1)).alias("n_orphans"))
