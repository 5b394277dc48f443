"""Structured Streaming: documents and events as they arrive.

The same operators as in batch, run on what is new: content seen before is dropped within a watermark, windows are
counted with late data, and every micro-batch is merged into a snapshot exactly once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from distriq.operators.dedup import not_yet_stored
from distriq.sources.files import append_snapshot, read_snapshot, snapshot_parts, write_snapshot


def arriving(spark: SparkSession, directory: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """Parquet files of a folder as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(directory)


def new_content(stream: DataFrame, content: str, at: str, delay: str = "7 days") -> DataFrame:
    """Rows whose content didn't arrive within ``delay`` before; the state holds digests of that time only."""
    return stream.withColumn("sha256", F.sha2(F.col(content), 256)).withWatermark(at, delay).dropDuplicatesWithinWatermark(["sha256"])


def windowed_counts(stream: DataFrame, at: str, kind: str, size: str = "1 day", delay: str = "2 days") -> DataFrame:
    """Rows per window and kind; rows later than ``delay`` are left out, windows are final after it."""
    counted = stream.withWatermark(at, delay).groupBy(F.window(at, size).alias("w"), F.col(kind)).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), kind, "n")


def sessions(stream: DataFrame, at: str, key: str, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Runs of a key's rows no further apart than ``gap``: start, end and rows."""
    grouped = stream.withWatermark(at, delay).groupBy(F.session_window(at, gap).alias("s"), F.col(key)).agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


#: Parts of a snapshot, at most, before they are written as one.
PARTS = 64


def into_snapshot(stream: DataFrame, root: str, keys: list[str], checkpoint: str, merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Merge each micro-batch into the snapshot at ``root``; without ``merge``, rows with new keys are added.

    Added rows are written as a part of their own, so a batch costs what it brings and a look at the stored keys; every
    PARTS batches the parts are written as one. A ``merge`` may change any row and writes the whole state. A batch that
    is replayed after a failure finds its keys stored and changes nothing.
    """

    def step(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        parts = snapshot_parts(spark, root)
        if parts is None:
            write_snapshot(batch.dropDuplicates(keys), root)
            return
        stored = read_snapshot(spark, root)
        if merge:
            write_snapshot(merge(stored, batch), root)
            return
        append_snapshot(not_yet_stored(batch.dropDuplicates(keys), stored, keys), root)
        if len(parts) >= PARTS:
            write_snapshot(read_snapshot(spark, root), root)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
