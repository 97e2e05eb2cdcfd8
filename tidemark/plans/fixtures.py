"""The driver's tables in the roles of the engine's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def watch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a watch history: users are channels, k is the video; errors have no channel."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    return e.select(
        k.alias("video_id"),
        F.concat(F.lit("item "), k).alias("title"),
        F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("channel"),
        F.when(F.col("event_type") == "click", F.concat(F.lit("https://example.com/c/"), F.col("user_id"))).alias("channel_url"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("watched_at"),
        F.col("event_type").alias("source"),
        F.col("event_id").alias("ingest_ord"),
    )


#: The same in SQL.
EVENTS_SQL = """(SELECT json_extract_string(props, '$.k') AS video_id, 'item ' || json_extract_string(props, '$.k') AS title,
  CASE WHEN event_type <> 'error' THEN user_id::VARCHAR END AS channel,
  CASE WHEN event_type = 'click' THEN 'https://example.com/c/' || user_id::VARCHAR END AS channel_url,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS watched_at, event_type AS source, event_id AS ingest_ord FROM events)"""


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with part as a larger history: suppliers are channels, parts videos."""
    l, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return l.join(p, l["l_partkey"] == p["p_partkey"]).select(
        F.col("l_partkey").cast("string").alias("video_id"),
        F.col("p_name").alias("title"),
        F.col("l_suppkey").cast("string").alias("channel"),
        F.lit(None).cast("string").alias("channel_url"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("watched_at"),
        F.lit("takeout").alias("source"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ingest_ord"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as transcripts."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").cast("string").alias("id"), F.col("doc_id").alias("ingest_ord"), "text", "source", "lang")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as titled videos with views and words."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("title"), F.col("p_size").cast("long").alias("view_count"), (X.word_count("p_name") * 1000).alias("words"), F.col("p_partkey").alias("ingest_ord"))


PARTS_SQL = "(SELECT p_partkey::VARCHAR AS id, p_name AS title, p_size::BIGINT AS views, len(regexp_extract_all(p_name, '\\S+'))::BIGINT * 1000 AS words FROM part)"


def label_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels as info records of the documents."""
    n = table(spark, sf_dir, "labels")
    return n.select(F.col("doc_id").cast("string").alias("id"), F.lit("20240101").alias("upload_date"), F.col("toxic").cast("long").alias("view_count"), F.col("quality").cast("double").alias("duration"))


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as listed videos, some without a date, views or duration."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("title"),
        F.when(F.col("doc_id") % 3 == 0, "20230615").alias("upload_date"),
        F.when(F.col("doc_id") % 4 == 0, 0).when(F.col("doc_id") % 4 == 1, F.col("n_chars")).cast("long").alias("view_count"),
        F.when(F.col("doc_id") % 2 == 0, F.col("n_chars") / 2).cast("double").alias("duration"),
        F.col("source").alias("channel"),
        F.col("lang").alias("uploader"),
        F.col("doc_id").alias("ingest_ord"),
    )


LISTED_SQL = """(SELECT doc_id::VARCHAR AS id, text AS title, CASE WHEN doc_id % 3 = 0 THEN '20230615' END AS upload_date,
  CASE WHEN doc_id % 4 = 0 THEN 0 WHEN doc_id % 4 = 1 THEN n_chars END::BIGINT AS view_count,
  CASE WHEN doc_id % 2 = 0 THEN n_chars / 2 END::DOUBLE AS duration, source AS channel, lang AS uploader, doc_id AS ingest_ord FROM documents)"""
