"""What every session of the library needs."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def shipped(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application."""
    if (app := spark.sparkContext.applicationId) in _shipped:
        return
    top = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="quillgraph-")  # the driver's own; Spark serves the file from there
    atexit.register(shutil.rmtree, folder, True)
    with zipfile.ZipFile(f"{folder}/{top.name}.zip", "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    spark.sparkContext.addPyFile(f"{folder}/{top.name}.zip")
    _shipped.add(app)


def builder(app: str = "quillgraph", partitions: int = 8) -> SparkSession.Builder:
    """A session with UTC times and adaptive execution; the master is the caller's."""
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
