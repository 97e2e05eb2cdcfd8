"""Session set-up that works for sessions made elsewhere."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = str(Path(__file__).resolve().parents[1])


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this library, wherever the driver was started."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "")
    if _ROOT not in paths.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, paths) if x)
    return spark


def small_batches(spark: SparkSession, rows: int = 1024) -> SparkSession:
    """Arrow batches of fewer rows where the session has Spark's default: texts are long."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return spark


def local(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A session for one machine."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("tidemark")
    defaults = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "8g", "spark.sql.adaptive.enabled": "true"}
    return importable(builder.config(map=defaults | conf).getOrCreate())
