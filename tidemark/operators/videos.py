"""Video lists of a channel: reduction, back-filling and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import falsy_to_null, first_truthy
from .ordering import keep_first

WATCH = "https://www.youtube.com/watch?v="


def reduce_videos(raw: DataFrame, order: str = "ingest_ord") -> DataFrame:
    """The first entry of each id as a video row; entries without an id go."""
    with_id = raw.filter(falsy_to_null("id").isNotNull())
    return keep_first(with_id, "id", order).select("id", "title", F.concat(F.lit(WATCH), "id").alias("url"), "upload_date", "duration", "view_count", order)


def channel_name(raw: DataFrame, order: str = "ingest_ord") -> DataFrame:
    """One row: the first channel or uploader among the kept entries."""
    kept = keep_first(raw.filter(falsy_to_null("id").isNotNull()), "id", order)
    name = first_truthy("channel", "uploader")
    return kept.agg(F.min_by(name, F.when(name.isNotNull(), F.col(order))).alias("channel"))


def channel_record(raw: DataFrame, slug: str, url: str, tab: str = "videos", order: str = "ingest_ord") -> DataFrame:
    """One row: a channel's slug, name (null where no entry has one), address, tab and number of videos."""
    count = reduce_videos(raw, order).agg(F.count("*").alias("video_count"))
    one = channel_name(raw, order).join(F.broadcast(count), F.lit(True))
    return one.select(F.lit(slug).alias("slug"), "channel", F.lit(url).alias("url"), F.lit(tab).alias("tab"), "video_count")


def runtime(videos: DataFrame) -> DataFrame:
    """Videos and their total hours."""
    return videos.agg(F.count("*").alias("videos"), (F.coalesce(F.sum("duration"), F.lit(0.0)) / 3600).alias("hours"))


def backfill(videos: DataFrame, info: DataFrame) -> DataFrame:
    """Missing (null, not zero or empty) dates, views and durations from info records; `filled` tells where a date was.

    Of repeated ids the record whose file sorts last counts (where they have no file, the greatest one), so no video is multiplied.
    """
    fields = ("upload_date", "view_count", "duration")
    one = latest_info(info) if "file" in info.columns else latest_info(info.withColumn("__all", F.struct(*fields)), "__all")
    side = one.select(F.col("id").alias("__id"), *(F.col(c).alias(f"__{c}") for c in ("upload_date", "view_count", "duration")))
    joined = videos.join(side, videos["id"] == F.col("__id"), "left")
    filled = F.col("upload_date").isNull() & F.col("__upload_date").isNotNull()
    new = {c: F.coalesce(c, f"__{c}") for c in ("upload_date", "view_count", "duration")}
    return joined.withColumn("filled", filled).withColumns(new).select(*videos.columns, "filled")


def backfill_report(filled: DataFrame, info: DataFrame) -> DataFrame:
    """Videos, info records, dates filled, first and last date, videos still without a date."""
    dated = falsy_to_null("upload_date")
    report = filled.agg(
        F.count("*").alias("videos"),
        F.count_if("filled").alias("dates_filled"),
        F.min(dated).alias("first_date"),
        F.max(dated).alias("last_date"),
        F.count_if(dated.isNull()).alias("undated"),
    )
    return report.join(F.broadcast(info.agg(F.count_distinct("id").alias("info_files"))), F.lit(True))


def latest_info(info: DataFrame, order: str = "file") -> DataFrame:
    """One info record for each id, the one whose file sorts last; records without an id go."""
    return info.filter(falsy_to_null("id").isNotNull()).groupBy("id").agg(*(F.max_by(c, order).alias(c) for c in ("upload_date", "view_count", "duration")))
