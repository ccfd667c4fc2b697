"""Session settings the operators are designed for."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Adaptive execution does three jobs here: it coalesces shuffle partitions, it
# splits skewed join partitions, and it switches to a broadcast join from the
# measured (not estimated) size of a side.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers, once per application.

    A cluster job may pass the package with ``--py-files`` instead.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        if not package.exists():  # imported from an archive that was shipped before
            return spark
        archive = shutil.make_archive(
            str(Path(tempfile.mkdtemp(prefix="tallgrove-code-")) / "tallgrove"), "zip", package.parent, package.name
        )
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return ship(spark)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tallgrove") -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)
