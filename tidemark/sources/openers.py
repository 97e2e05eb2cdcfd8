"""Files of any file system: listed on the driver through Spark's, opened in tasks."""

from __future__ import annotations

import io
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 1 << 20
#: Tasks for each core that small files are dealt to, and bytes that are worth a task beyond those.
TASKS, TASK_BYTES = 8, 64 << 20


def listed(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Address and length of the files at a path or pattern, and in the folders there, by address."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = [x for s in fs.globStatus(at) or () for x in (fs.listStatus(s.getPath()) if s.isDirectory() else (s,))]
    return sorted((x.getPath().toUri().toString(), x.getLen()) for x in there if x.isFile() and x.getPath().getName()[0] not in "._")


def in_few_tasks(rows: DataFrame) -> DataFrame:
    """Rows that were just loaded from files, however many, in a few tasks for each core or in tasks of TASK_BYTES.

    Spark counts every file as 4 MB at least, so by itself it makes a task of each 32 small ones.
    """
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return rows.coalesce(max(TASKS * rows.sparkSession.sparkContext.defaultParallelism, size // TASK_BYTES))


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """path and content of the files at a path or pattern, also of those without a byte, which Spark's reader passes by.

    Names of files come to the driver only if fewer are read than are listed.
    """
    import pyarrow as pa

    found = spark.read.format("binaryFile").load(path)
    rows = in_few_tasks(found).select("path", "content")
    names = found._jdf.inputFiles()
    if len(names) == in_few_tasks(found).count():
        return rows
    # in one call, as inputFiles() makes one for each file; addresses have no line ends
    names = spark.createDataFrame(pa.table({"value": spark.sparkContext._jvm.org.apache.hadoop.util.StringUtils.join("\n", names).split("\n")}))

    def address(c):  # file:/a and file:///a are one file
        return F.regexp_replace(c, "^([^:/]+):/+", "$1:/").alias("at")

    read = in_few_tasks(found).select(address(F.col("_metadata.file_path")))
    empty = names.select(address("value")).join(read, "at", "left_anti")
    return rows.unionByName(empty.select(F.url_decode(F.replace("at", F.lit("+"), F.lit("%2B"))).alias("path"), F.lit(b"").alias("content")))


def put(spark: SparkSession, path: str, content: bytes) -> None:
    """Write a small file from the driver."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at)
    out.write(content)
    out.close()


def opened(uri: str):
    """A file that can be read and sought, in a task. Local files, and what Arrow's file systems reach (HDFS, S3, GCS)."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return open(unquote(parts.path) if parts.scheme else uri, "rb")
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return io.BufferedReader(system.open_input_file(path), BLOCK)


def blocks(file, size: int = BLOCK) -> Iterator[bytes]:
    while block := file.read(size):
        yield block
