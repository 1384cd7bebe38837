"""Session defaults and table access shared by every query."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(cpus: int | str | None = None, app: str = "foliant") -> SparkSession:
    """A local session with the settings that the engine is tuned for.

    On a cluster the caller brings its own session; nothing here is required by the operators.
    """
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("FOLIANT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> SparkSession:
    """Give the Python workers this package: a zip of a few hundred KB that Spark serves to every executor, once a context.

    Rows hold whole texts, so Arrow batches are made smaller where the session has the default size.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH, "10000") == "10000":
        spark.conf.set(BATCH, "2000")
    if not getattr(context, "_foliant_shipped", False):
        folder = tempfile.mkdtemp(prefix="foliant-code-")
        atexit.register(shutil.rmtree, folder, True)
        root = os.path.dirname(os.path.abspath(__file__))
        with zipfile.ZipFile(os.path.join(folder, "foliant_code.zip"), "w", zipfile.ZIP_DEFLATED) as z:
            for at, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(at, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        context.addPyFile(os.path.join(folder, "foliant_code.zip"))
        context._foliant_shipped = True
    return spark
