"""Session set-up used by the tests, the bench and the command line."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", app: str = "distriq", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the operators are written for (UTC, adaptive execution)."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    } | conf
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers that don't find it by themselves, once per application.

    They do if PYTHONPATH names its folder, or in local mode if that is the working directory; else the package is sent
    to the executors as a zip file.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = Path(__file__).resolve().parent
    root = str(package.parent)
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or (context.master.startswith("local[") and os.getcwd() == root):
        return
    archive = Path(tempfile.mkdtemp(prefix="distriq-")) / "distriq.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*")):
            if file.suffix in (".py", ".json"):
                out.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(str(archive))
