"""New batches against all history: a forest of prefix trees over sorted signature permutations.

The accepted entries of each batch are written as a run: four permutations of them, each sorted by key and signature (see
:mod:`distriq.llm.forest`). A new batch is put in the order of its keys; each task finds its entries' ranges in the runs
by binary search, reads the row groups these ranges meet and no others, and verifies exactly what it finds. Runs are
merged four at a time, so that there are few of them. What a batch costs depends on the batch, on the number of runs,
which grows with the logarithm of the number of batches, and on nothing else of the history.

Within a batch, rows equal in key, day and amount are one value. What a value restates depends on others of its key only,
so a task that has whole keys decides them one by one. A key with more rows in one batch than KEY_ROWS isn't given to one
task: its values that are the first in all their cells can't restate anything undecided before them and are accepted;
what matches them is a duplicate; and so on until all are decided. As accepted entries never match each other, a cell
holds at most a few, so a cell with a third of all rows meets those few only, never itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from distriq.durable import durable, fresh_path, remove
from distriq.llm.forest import BITS, ORIGIN, TREES, Forest, settled, shifts, unit_of, valued, whole_keys

#: So many runs of one level become one of the next.
FAN_IN = 4
#: Rows of one key in one batch that a task decides, at most; keys with more are decided by joins.
KEY_ROWS = 1_000_000
#: Rows that a task gets: where cores would be idle, not under the first; about the second at most.
TASK_ROWS = 5_000, 200_000
#: Rows of a run's row group: what one range search reads at least.
GROUP_ROWS = 1024

#: Steps that put a gap after each of the lower bits: shift and mask of each.
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def with_signature(df: DataFrame, days: int, rate: float) -> DataFrame:
    """``df`` (day, amount, tree) with ``code``, the signature in that tree, as :func:`distriq.llm.forest.interleaved` has it.

    Each step is a column of its own: within one expression every step would be evaluated twice by the next.
    """

    def shift(axis: int) -> Column:
        return F.get(F.array(*(F.lit(shifts(t)[axis]) for t in range(TREES))), F.col("tree"))

    x = F.floor(F.col("day") / F.lit(days)).cast("long") + ORIGIN + shift(0)
    y = F.when(F.col("amount") == 0, F.lit(0)).otherwise(F.floor(F.log(F.abs("amount")) / F.lit(unit_of(rate)))).cast("long") + ORIGIN + shift(1)
    mask = F.lit((1 << BITS) - 1)
    df = df.withColumns({"__x": x.bitwiseAND(mask), "__y": y.bitwiseAND(mask)})
    for by, kept in _SPREAD:
        df = df.withColumns({c: F.col(c).bitwiseOR(F.shiftleft(c, by)).bitwiseAND(F.lit(kept)) for c in ("__x", "__y")})
    # never NULL, or the filter on NULL keys that joins add would be pushed below the steps, as one expression of them all
    return df.withColumn("code", F.coalesce(F.shiftleft("__x", 1).bitwiseOR(F.col("__y")), F.lit(-1))).drop("__x", "__y")


def near(a: tuple[Column, Column], b: tuple[Column, Column], days: int, rate: float) -> Column:
    """Whether two (day, amount) are within tolerance, exactly."""
    return (F.abs(a[0] - b[0]) <= days) & (F.abs(a[1] - b[1]) <= rate * F.greatest(F.abs(a[1]), F.abs(b[1])))


_VALUE = "id long, key string, day int, amount double, copies long"
_DECIDED = f"{_VALUE}, first long"
_RUN = "key string, code long, id long, day int, amount double, tree int"
#: The tree under which a batch's run holds its duplicates: ``id`` restates ``code``.
_DUPLICATES = -1
_PAIRS = "first_id long, dup_id long"


def _in_trees(entries: DataFrame, days: int, rate: float) -> DataFrame:
    """Each entry once for each tree, with its signature there."""
    return with_signature(entries.withColumn("tree", F.explode(F.array(*(F.lit(t) for t in range(TREES))))), days, rate)


class HistoryIndex:
    """Accepted entries of all batches so far. ``days`` at least 1; amounts of different signs never match.

    ``recall``: the share of matches that a range search has to find; below 1 prefixes may stay longer, see
    :meth:`distriq.llm.forest.Forest.widened`. ``rows_read``: of the history, in all searches so far; tasks that were run
    again count again. :meth:`close` removes the runs; frames that :meth:`add` returned can't be read then.
    """

    def __init__(self, spark: SparkSession, days: int = 1, rate: float = 0.005, recall: float = 1.0) -> None:
        if not 0 <= recall <= 1:
            raise ValueError("recall is a share")
        unit_of(rate)
        self.spark, self.days, self.rate, self.recall = spark, days, rate, recall
        self.runs: list[tuple[int, str]] = []
        self.spent: list[str] = []
        self.rows_read = spark.sparkContext.accumulator(0)

    def _searched(self, values: DataFrame) -> DataFrame:
        """``values`` with ``first``, the smallest accepted id in the history that they match."""
        paths, days, rate, recall, read = [path for _, path in self.runs], self.days, self.rate, self.recall, self.rows_read

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            forest = Forest(paths, days, rate, recall)
            for entries in batches:
                first = forest.first(entries)
                yield entries.assign(first=pd.arrays.IntegerArray(first, first < 0))
            read.add(forest.rows_read)

        order = ["key", "day", "amount"]
        return values.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(search, _DECIDED)

    def _settled(self, rows: DataFrame, tasks: int) -> DataFrame:
        """What a run of ``rows`` holds, whole keys to a task: the accepted values in each tree, and the duplicates."""
        paths, days, rate, recall, read = [path for _, path in self.runs], self.days, self.rate, self.recall, self.rows_read

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forest = Forest(paths, days, rate, recall)
            names = ["key", "id", "day", "amount", "first"]
            for entries in whole_keys(b.to_pandas() for b in batches):
                values, place = valued(entries)
                first = settled(values, forest.first(values), days, rate)
                new = values[first < 0]
                kept = [pa.array(new["key"].to_numpy(object), pa.string()), *(pa.array(new[c].to_numpy(), kind) for c, kind in (("id", pa.int64()), ("day", pa.int32()), ("amount", pa.float64())))]
                yield pa.RecordBatch.from_arrays([*kept, pa.nulls(len(new), pa.int64())], names)
                ids = entries["id"].to_numpy("int64")
                head = np.where(first < 0, values["id"].to_numpy("int64"), first)[place]
                dup = ids != head
                n = int(dup.sum())
                yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.string()), pa.array(ids[dup]), pa.nulls(n, pa.int32()), pa.nulls(n, pa.float64()), pa.array(head[dup])], names)
            read.add(forest.rows_read)

        # a task's work is the history it meets, so rows' bytes mustn't decide how many tasks there are
        found = rows.repartitionByRange(tasks, "key").sortWithinPartitions("key").mapInArrow(search, "key string, id long, day int, amount double, first long")
        trees = F.when(F.col("first").isNull(), F.array(*(F.lit(t) for t in range(TREES)))).otherwise(F.array(F.lit(_DUPLICATES)))
        signed = with_signature(found.withColumn("tree", F.explode(trees)), self.days, self.rate)
        # keys are in order from task to task, so that sorted tasks are sorted trees
        return signed.withColumn("code", F.coalesce("first", "code")).sortWithinPartitions("tree", "key", "code")

    def _tasks(self, rows: int) -> int:
        return max(1, rows // TASK_ROWS[1], min(rows // TASK_ROWS[0], self.spark.sparkContext.defaultParallelism))

    def _written(self, df: DataFrame, name: str) -> str:
        path = fresh_path(self.spark, name)
        df.write.parquet(path)
        self.spent.append(path)
        return path

    def _round(self, open_values: DataFrame) -> DataFrame:
        """``open_values`` with ``first`` and ``accepted``: accepted now, or the head they match that is; both missing, still undecided."""
        signed = _in_trees(open_values, self.days, self.rate).withColumn("cell", F.shiftright("code", 4))
        cells = signed.groupBy("cell", "key", "tree").agg(F.min(F.struct("id", "day", "amount")).alias("head"))
        close = near((F.col("day"), F.col("amount")), (F.col("head.day"), F.col("head.amount")), self.days, self.rate)
        # an entry meets one head per tree, so the set of heads has four members at most
        each = signed.join(cells, ["cell", "key", "tree"]).groupBy("id").agg(
            *(F.first(c).alias(c) for c in ("key", "day", "amount", "copies")),
            F.every(F.col("id") == F.col("head.id")).alias("accepted"),
            F.collect_set(F.when(close & (F.col("id") != F.col("head.id")), F.col("head.id"))).alias("heads"),
        )
        each = self.spark.read.schema(f"{_VALUE}, accepted boolean, heads array<long>").parquet(self._written(each, "round"))
        rest = each.filter("NOT accepted").withColumn("h", F.explode_outer("heads")).join(each.filter("accepted").select(F.col("id").alias("h"), F.col("id").alias("met")), "h", "left")
        judged = rest.groupBy("id").agg(*(F.first(c).alias(c) for c in ("key", "day", "amount", "copies")), F.min("met").alias("first")).withColumn("accepted", F.lit(False))
        names = [c.split()[0] for c in _VALUE.split(", ")]
        return each.filter("accepted").select(*names, F.lit(None).cast("long").alias("first"), "accepted").unionByName(judged)

    def _decided_by_joins(self, values: DataFrame) -> list[str]:
        """Paths of decided values of keys with too many of them for one task."""
        old = self.spark.read.schema(_DECIDED).parquet(self._written(self._searched(values), "searched"))
        out = [self._written(old.filter("first IS NOT NULL"), "decided")]
        open_values = old.filter("first IS NULL").drop("first")
        accepted: list[DataFrame] = []
        lost: list[DataFrame] = []
        while not open_values.isEmpty():
            done = self.spark.read.schema(f"{_DECIDED}, accepted boolean").parquet(self._written(self._round(open_values), "round"))
            accepted.append(done.filter("accepted").drop("accepted"))
            lost.append(done.filter("first IS NOT NULL").drop("accepted"))
            open_values = done.filter("NOT accepted AND first IS NULL").drop("first", "accepted")
        for part in accepted:
            out.append(self._written(part, "decided"))
        if not lost:
            return out
        # of all accepted entries that a duplicate matches the first one counts, not the one of its round
        heads, rest = accepted[0], lost[0]
        for a, b in zip(accepted[1:], lost[1:]):
            heads, rest = heads.unionByName(a), rest.unionByName(b)
        signed = [_in_trees(df, self.days, self.rate).withColumn("cell", F.shiftright("code", 4)) for df in (heads, rest.drop("first"))]
        heads = signed[0].select("tree", "key", "cell", F.col("id").alias("first"), F.col("day").alias("__d"), F.col("amount").alias("__a"))
        found = signed[1].join(heads, ["cell", "key", "tree"]).filter((F.col("first") < F.col("id")) & near((F.col("day"), F.col("amount")), (F.col("__d"), F.col("__a")), self.days, self.rate))
        out.append(self._written(found.groupBy("id").agg(*(F.first(c).alias(c) for c in ("key", "day", "amount", "copies")), F.min("first").alias("first")), "decided"))
        return out

    def decide(self, batch: DataFrame) -> DataFrame:
        """(first_id, dup_id) of a batch's duplicates, on shared storage until :meth:`close`; what it accepts becomes a run of the index."""
        rows = _usable(batch)
        many = []
        n = batch.count()
        if n > KEY_ROWS:
            # fewer than rows / KEY_ROWS
            many = [r[0] for r in rows.groupBy("key").count().filter(F.col("count") > KEY_ROWS).select("key").collect()]
        rest = rows.filter(~F.col("key").isin(many)) if many else rows
        path = self._write_sorted(self._settled(rest, self._tasks(n)), 0)
        out = self.spark.read.schema(_RUN).parquet(path).filter(F.col("tree") == _DUPLICATES).select(F.col("code").alias("first_id"), F.col("id").alias("dup_id"))
        if many:
            hot = rows.filter(F.col("key").isin(many))
            values = hot.groupBy("key", "day", "amount").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
            decided = self.spark.read.schema(_DECIDED).parquet(*self._decided_by_joins(values.select("id", "key", "day", "amount", "copies")))
            out = out.unionByName(self.spark.read.schema(_PAIRS).parquet(self._written(_pairs(hot, decided), "hot")))
            self._write_run(decided.filter("first IS NULL").select("key", "id", "day", "amount"), 0)
        self._merge()
        return out

    def add(self, batch: DataFrame) -> DataFrame:
        """Decide a batch and remember what it accepts; returns (first_id, dup_id) of its duplicates.

        ``batch``: id (unique, larger than all ids before), key, day (int), amount (double). Rows lacking a key, day or
        amount, or whose amount is no finite number, are neither duplicate nor accepted. Other columns are left alone.
        first_id is the smallest accepted id that matches. An empty batch changes nothing.
        """
        return self.decide(batch)

    def _write_sorted(self, signed: DataFrame, level: int) -> str:
        path = fresh_path(self.spark, f"run{level}")
        rows = signed.select("key", "code", "id", "day", "amount", "tree")
        rows.write.partitionBy("tree").option("parquet.block.row.count.limit", GROUP_ROWS).parquet(path)
        self.runs.append((level, path))
        self.spent.append(path)
        return path

    def _write_run(self, accepted: DataFrame, level: int) -> None:
        """Entries as a run. They go to tasks once, not once for each tree; only those of keys that are too large for a task do."""
        order = ["tree", "key", "code"]
        n = accepted.count()
        large = n > KEY_ROWS and not accepted.groupBy("key").count().filter(F.col("count") > KEY_ROWS).isEmpty()
        spread = _in_trees(accepted, self.days, self.rate).repartitionByRange(*order) if large else _in_trees(accepted.repartitionByRange(self._tasks(n), "key"), self.days, self.rate)
        self._write_sorted(spread.sortWithinPartitions(*order), level)

    def _merge(self) -> None:
        """Runs of one level, as soon as they are enough, become one of the next. A tree of them has all their entries."""
        level = 0
        while level <= max(at for at, _ in self.runs):
            same = [r for r in self.runs if r[0] == level]
            if len(same) >= FAN_IN:
                entries = (self.spark.read.schema(_RUN).parquet(p).filter("tree = 0").select("key", "id", "day", "amount") for _, p in same)
                merged = reduce(DataFrame.unionByName, entries)
                self.runs = [r for r in self.runs if r not in same]
                self._write_run(merged, level + 1)
                for _, p in same:  # the duplicates stay
                    for t in range(TREES):
                        remove(self.spark, f"{p}/tree={t}")
            level += 1

    def close(self) -> None:
        """Remove everything the index has written."""
        for path in self.spent:
            remove(self.spark, path)
        self.spent, self.runs = [], []


def _usable(batch: DataFrame) -> DataFrame:
    """(id, key, day, amount) of the rows that have all of them, the amount's sign before the key."""
    finite = F.col("amount").isNotNull() & ~F.isnan("amount") & (F.abs("amount") < float("inf"))
    rows = batch.select("id", "key", F.col("day").cast("int").alias("day"), F.col("amount").cast("double").alias("amount"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("key").isNotNull() & F.col("day").isNotNull() & finite)
    # -0.0 and 0.0 are one value
    return rows.withColumns({"key": F.concat_ws("|", F.signum("amount").cast("int").cast("string"), "key"), "amount": F.col("amount") + F.lit(0.0)})


def _pairs(rows: DataFrame, values: DataFrame) -> DataFrame:
    """(first_id, dup_id) of rows. A row of a value that is accepted restates it, one of a duplicate what that restates.

    What a value restates is the same in each batch it comes in: accepted entries are never taken back, and later ones
    have larger ids.
    """
    known = values.groupBy("key", "day", "amount").agg(F.min(F.coalesce("first", "id")).alias("first_id"))
    return rows.join(known, ["key", "day", "amount"]).filter(F.col("id") != F.col("first_id")).select("first_id", F.col("id").alias("dup_id"))


def restated(df: DataFrame, batch_column: str, days: int = 1, rate: float = 0.005, recall: float = 1.0) -> DataFrame:
    """(first_id, dup_id) of all batches of ``df``, added one by one to a new index in the order of ``batch_column``.

    ``df`` has id, key, day and amount as :meth:`HistoryIndex.add` wants them, ids rising with batches. What is decided
    about an entry depends on those with smaller ids only. Rows without a batch are left out.
    """
    spark = df.sparkSession
    entries = df.select(F.col(f"`{batch_column}`").alias("__batch"), "id", "key", "day", "amount").filter(F.col("__batch").isNotNull())
    path = fresh_path(spark, "batches")
    # each batch is a folder, so that it is read alone
    entries.write.partitionBy("__batch").parquet(path)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in entries.schema if f.name != "__batch")
    entries = spark.read.schema(f"{kinds}, __batch {entries.schema['__batch'].dataType.simpleString()}").parquet(path)
    numbers = sorted(r[0] for r in entries.select("__batch").distinct().collect())
    if not numbers:
        return spark.createDataFrame([], _PAIRS)
    index = HistoryIndex(spark, days, rate, recall)
    found = [index.decide(entries.filter(F.col("__batch") == n).drop("__batch")) for n in numbers]
    out = durable(reduce(DataFrame.unionByName, found), "restated")
    index.close()
    remove(spark, path)
    return out
