"""Line lists and small JSON files: histories, caches, video lists, info records, taxonomies."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import text as X
from .openers import in_few_tasks


def exists(spark: SparkSession, path: str) -> bool:
    """Whether any file is at a path or pattern, in whatever file system it names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """Files without a byte at a path or pattern, and in the folders there: readers of files pass them over."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = [x for s in fs.globStatus(at) or () for x in (fs.listStatus(s.getPath()) if s.isDirectory() else (s,))]
    return [x.getPath().toString() for x in there if x.isFile() and not x.getLen() and x.getPath().getName()[0] not in "._"]


def history(spark: SparkSession, path: str) -> DataFrame:
    """Watch events from JSON lines. Their order in the files is the history's (history_ord); ingest_ord is as written.

    Files that a writer numbered come by folder and number, others by name."""
    rows = spark.read.schema(S.ORDERED_EVENT).json(path)
    name = F.col("_metadata.file_path")
    number = F.regexp_extract(name, r"/part-(\d+)[^/]*$", 1).try_cast("long")
    at = F.struct(F.regexp_extract(name, r"(?s)^(.*/)", 1).alias("folder"), number.alias("number"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return rows.withColumns({"history_ord": at, "ingest_ord": F.coalesce("ingest_ord", F.monotonically_increasing_id())})


def channel_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache of resolved videos (an object by video id), empty where there is no file; a null value is a recorded miss."""
    if not exists(spark, path):
        return spark.createDataFrame([], S.CHANNEL_CACHE)
    whole = in_few_tasks(spark.read.text(path, wholetext=True))
    entries = whole.select(F.explode(F.from_json("value", "map<string, struct<channel: string, channel_url: string>>")).alias("video_id", "v"))
    return entries.select("video_id", "v.channel", "v.channel_url")


def raw_videos(lines: DataFrame) -> DataFrame:
    """Entries of a flat listing (value, ingest_ord); lines that are no JSON objects are skipped."""
    text = ", ".join(f"{f.name}: string" for f in S.RAW_VIDEO.fields)
    parsed = lines.withColumn("e", F.from_json("value", f"struct<{text}>", {"mode": "PERMISSIVE"}))
    kept = parsed.filter(F.get_json_object("value", "$").isNotNull() & F.col("e").isNotNull()).select("e.*", "ingest_ord")
    # numbers with a fraction or in quotes count; views are whole
    views = F.coalesce(F.col("view_count").try_cast("long"), F.col("view_count").try_cast("double").try_cast("long"))
    return kept.withColumns({"duration": F.col("duration").try_cast("double"), "view_count": views})


def document_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON array that `sinks.json_document` wrote in parts, in as many tasks as there are parts or more."""
    value = spark.read.text(path).filter("value not in ('[', ']')").select(F.substr("value", F.lit(2)).alias("value"))
    return value.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumn("ingest_ord", F.monotonically_increasing_id())


def videos(lines: DataFrame) -> DataFrame:
    """Video rows of a list that may hold blank lines and comments."""
    bare = lines.withColumn("value", X.strip("value")).filter(F.col("value").startswith("{"))
    return bare.select(F.from_json("value", S.VIDEO.simpleString(), {"mode": "FAILFAST"}).alias("e"), "ingest_ord").select("e.*", "ingest_ord")


def videos_strict(spark: SparkSession, path: str) -> DataFrame:
    """Video rows of a list where every line must be one; anything else stops the query."""
    rows = spark.read.text(path).withColumn("ingest_ord", F.monotonically_increasing_id())
    return rows.select(F.from_json("value", S.VIDEO.simpleString(), {"mode": "FAILFAST"}).alias("e"), "ingest_ord").select("e.*", "ingest_ord")


def info_records(spark: SparkSession, path: str) -> DataFrame:
    """Info records (a JSON file each) with their file name; unreadable ones are skipped."""
    whole = in_few_tasks(spark.read.text(path, wholetext=True)).select("value", F.col("_metadata.file_name").alias("file"))
    return whole.filter(F.get_json_object("value", "$").isNotNull()).select(F.from_json("value", S.INFO.simpleString()).alias("e"), "file").select("e.*", "file")


def listing(spark: SparkSession, path: str) -> DataFrame:
    """file and size of what is in a folder; contents are not read."""
    rows = in_few_tasks(spark.read.format("binaryFile").load(path))
    return rows.select(F.substring_index("path", "/", -1).alias("file"), F.col("length").alias("size"))


def srt_files(spark: SparkSession, path: str) -> DataFrame:
    rows = in_few_tasks(spark.read.format("binaryFile").load(path))
    return rows.select(F.substring_index("path", "/", -1).alias("file"), F.col("length").alias("size"), X.decoded("content").alias("content"))


def domains(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """The taxonomy in its order; patterns are checked here. A taxonomy is a page of text, so it is read on the driver."""
    if not exists(spark, path):
        raise FileNotFoundError(f"{path}: write the taxonomy first")
    text = spark.read.text(path, wholetext=True).first().value
    found = list(json.loads(text).items())
    for _, pattern in found:
        X.java_pattern(pattern)
    return found


def domain_table(spark: SparkSession, found: list[tuple[str, str]]) -> DataFrame:
    """A taxonomy as a table: ord, domain, pattern (in Python's dialect)."""
    return spark.createDataFrame([(i, k, p) for i, (k, p) in enumerate(found)], S.DOMAIN)
