"""Versioned merge: rows that arrive in sequence for a natural key, as versions with what became of each row.

A row INSERTs its key, leaves it UNCHANGED, AMENDs it with a new version if its source is one of those that stand for
the current figure, or else is a CONFLICT, kept as evidence only. What a row becomes depends on all before it. Rows are
therefore sorted by key and arrival within partitions, which spills, and streamed past the state of the key at hand: a
key's rows are never in memory together, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Amounts closer than this are the same figure.
SAME = 1e-6


def signature(parts: Column) -> Column:
    """Components (structs of kind and amount) as a text that doesn't depend on how they were listed, amounts to six decimals."""
    ordered = F.array_sort(F.transform(parts, lambda p: F.concat_ws("=", F.coalesce(p["kind"], F.lit("")), F.coalesce(F.format_number(p["amount"].cast("double"), 6), F.lit("")))))
    return F.coalesce(F.array_join(ordered, ";"), F.lit(""))


def merge_versions(df: DataFrame, keys: list[str], order: list[str], id_column: str, amount: str, source: str, parts: str | None = None, amendment: str | None = None) -> DataFrame:
    """(keys, id, outcome, version, reallocated) of each row, in the order of ``order``, which must be total within a key.

    Rows without an amount above 0, a source or a key are REJECTED, with version NULL, and change nothing. reallocated:
    an amended row that splits the same amount otherwise. ``amendment``: a boolean column that makes a row an amendment
    whatever its source. A source is entitled to amend the current figure if it gave or confirmed it.
    """
    good = (F.col("amount") > 0) & F.col("source").isNotNull() & F.col("key").isNotNull()
    typed = df.select(
        *keys,
        F.when(~F.greatest(F.lit(False), *(F.col(k).isNull() for k in keys)), F.to_json(F.struct(*keys))).alias("key"),
        *(F.col(c).alias(f"o{i}") for i, c in enumerate(order)),
        F.col(id_column).cast("string").alias("id"),
        F.col(amount).cast("double").alias("amount"),
        F.col(source).cast("string").alias("source"),
        (signature(F.col(parts)) if parts else F.lit("")).alias("parts"),
        (F.coalesce(F.col(amendment), F.lit(False)) if amendment else F.lit(False)).alias("amendment"),
    )
    rejected = typed.filter(~F.coalesce(good, F.lit(False))).select(*keys, "id", F.lit("REJECTED").alias("outcome"), F.lit(None).cast("int").alias("version"), F.lit(False).alias("reallocated"))
    rows = typed.filter(good).repartition("key").sortWithinPartitions("key", *(f"o{i}" for i in range(len(order))), "id")
    said = "id string, outcome string, version int, reallocated boolean"
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys) + ", " + said

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, version, figure, split, sources = None, 0, 0.0, "", set()
        for batch in batches:
            out: list[tuple[str, int, bool]] = []
            for key, value, source_, made, forced in zip(batch["key"], batch["amount"], batch["source"], batch["parts"], batch["amendment"]):
                again = False
                if key != at:
                    at, version, outcome = key, 1, "INSERTED"
                else:
                    same = abs(figure - value) < SAME
                    if same and made == split and not forced:
                        outcome = "UNCHANGED"
                    elif forced or source_ in sources:
                        outcome, version, again = "AMENDED", version + 1, same and made != split
                    else:
                        outcome = "CONFLICT"
                    if outcome in ("UNCHANGED", "CONFLICT") and same:
                        sources.add(source_)
                if outcome in ("INSERTED", "AMENDED"):
                    figure, split, sources = value, made, {source_}
                out.append((outcome, version, again))
            told = pd.DataFrame(out, columns=["outcome", "version", "reallocated"])
            yield pd.concat([batch[[*keys, "id"]].reset_index(drop=True), told], axis=1)

    return rows.mapInPandas(fold, kinds).unionByName(rejected)


def overwrite_by_key(stored: DataFrame, fresh: DataFrame, keys: list[str], keep_old: tuple[str, ...] = (), keep_largest: tuple[str, ...] = ()) -> DataFrame:
    """``stored`` with the rows of ``fresh`` put over those of equal keys; both have unique keys and the same columns.

    ``keep_old``: columns in which a NULL doesn't replace a value. ``keep_largest``: columns that keep the larger value.
    """
    a, b = stored.withColumn("__a", F.lit(True)), fresh.withColumn("__b", F.lit(True)).withColumnsRenamed({c: f"__n_{c}" for c in fresh.columns if c not in keys})
    out = [F.col(k) for k in keys]
    for c in stored.columns:
        if c in keys:
            continue
        old, new = F.col(c), F.col(f"__n_{c}")
        value = F.greatest(old, new) if c in keep_largest else F.coalesce(new, old) if c in keep_old else F.when(F.col("__b"), new).otherwise(old)
        out.append(value.alias(c))
    return a.join(b, keys, "full").select(*out)
