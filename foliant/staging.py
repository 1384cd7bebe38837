"""Tables written in the shared folder to cut lineage, and joins whose broadcast side is counted first."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def staging_dir(spark: SparkSession) -> str:
    """A fresh folder name below the shared folder in spark.checkpoint.dir.

    In local mode, where one machine is all there is, an unset folder is made and set. On a cluster it is an error:
    executors would write where nobody reads.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="foliant-")
        atexit.register(shutil.rmtree, base, True)
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/foliant-{uuid.uuid4().hex}"


#: Folders of staged tables that were made by this process and not deleted yet, in order.
_MADE: list[str] = []


def staged(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends there, and lost executors cost nothing upstream."""
    path = staging_dir(df.sparkSession)
    _MADE.append(path)
    (df.write if by is None else df.write.partitionBy(*by)).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)
    if path in _MADE:
        _MADE.remove(path)


def discard(df: DataFrame) -> None:
    """Delete a staged table that no plan reads any more."""
    path = getattr(df, "_staged_path", None)
    if path:
        _delete(df.sparkSession, path)


def made() -> int:
    """A mark for sweep: how many staged tables there are now."""
    return len(_MADE)


def sweep(spark: SparkSession, since: int, *keep: DataFrame) -> None:
    """Delete the tables staged after the mark, those of keep excepted. For callers whose result is written."""
    kept = {getattr(df, "_staged_path", None) for df in keep}
    for path in [p for p in _MADE[since:] if p not in kept]:
        _delete(spark, path)


#: Rows of a few short columns that may be broadcast: 16 MB or so.
BROADCAST_ROWS = 1_000_000


def checked(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The side of a join, broadcast if its counted size allows it, so that the other side stays where it is."""
    return F.broadcast(rows) if rows.count() <= most else rows
