"""Tables written to the folder that the driver and all executors share, where lineage is cut."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a temporary folder, on one machine alone."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def removed(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session is gone: nothing is left to clean with
        pass


_kept: set[str] = set()


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what stands there goes when the Python process ends."""
    top = f"{shared_dir(spark)}/tidemark-{spark.sparkContext.applicationId}"
    if top not in _kept:
        _kept.add(top)
        atexit.register(removed, spark, top)
    return f"{top}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: its lineage ends there, and lost executors recompute only from it.

    by: a column of few values, by which a reader takes only its own files.
    The application's tables go when the Python process ends, or before that by `freed`.
    """
    path = folder(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def freed(*tables: DataFrame) -> None:
    """Remove staged tables that nothing will read again."""
    for t in tables:
        removed(t.sparkSession, t._tidemark_path)
