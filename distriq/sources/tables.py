"""The Parquet tables of one scale directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Scan ``<directory>/<name>.parquet``; columns and filters of later steps reach the scan."""
    return spark.read.parquet(f"{directory}/{name}.parquet")
