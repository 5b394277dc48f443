"""Tables written to the folder all executors share, to cut lineage or to keep state between batches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; in local mode without that setting, one of our own.

    On a cluster without the setting this raises: a machine's own temporary folder would be lost with the machine.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = context.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="distriq-")
    return _OWN[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing was written to yet."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later plans start from the files, not from its lineage."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table written here; a path that is gone already is no error."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
