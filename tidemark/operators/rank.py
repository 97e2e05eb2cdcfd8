"""Creators ranked by breadth, repetition, span and recency of viewing.

First addresses, first titles and ties go by history order (`history.place`), not by the order of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import days_between, iso_day
from ..functions.text import first_truthy
from ..staging import staged
from .history import place
from .ordering import with_ordinal

TITLES = 25


def attribute(events: DataFrame, cache: DataFrame | None = None) -> DataFrame:
    """Events with channel and address, each filled by itself from the cache of resolved videos; those without a channel go."""
    if cache is None:
        filled = events.withColumns({"channel": first_truthy("channel"), "channel_url": first_truthy("channel_url")})
    else:
        known = cache.select("video_id", F.col("channel").alias("__channel"), F.col("channel_url").alias("__url"))
        filled = events.join(known, "video_id", "left").withColumns({"channel": first_truthy("channel", "__channel"), "channel_url": first_truthy("channel_url", "__url")})
    return filled.filter("channel is not null").drop("__channel", "__url")


def _first_titles(rows: DataFrame, most: int) -> DataFrame:
    """The first distinct titles of a channel. A channel's titles are cut to `most` before they meet in one place."""
    seen = rows.groupBy("channel", "title").agg(F.min("__place").alias("ord"))
    first = seen.withColumn("r", F.row_number().over(Window.partitionBy("channel").orderBy("ord", "title"))).filter(F.col("r") <= most)
    return first.groupBy("channel").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "title"))), lambda x: x["title"]).alias("sample_titles"))


def creators(events: DataFrame, cache: DataFrame | None = None, min_videos: int = 3, titles: int = TITLES, rank: bool = False) -> DataFrame:
    """A row for each channel name of at least min_videos distinct videos.

    With rank, their place (from 0): most videos, most events, then first seen. It is worked out before the titles are
    joined, from the totals alone.
    """
    rows = attribute(events.withColumn("__place", place(events)), cache).withColumn("day", iso_day("watched_at"))
    totals = rows.groupBy("channel").agg(
        F.count_distinct("video_id").alias("videos"),
        F.count("*").alias("events"),
        F.min("day").alias("first"),
        F.max("day").alias("last"),
        F.min_by("channel_url", F.when(F.col("channel_url").isNotNull(), F.col("__place"))).alias("channel_url"),
        F.min("__place").alias("first_ord"),
    )
    kept = totals.filter(F.col("videos") >= min_videos)
    if rank:
        kept = with_ordinal(staged(kept, "totals"), [F.desc("videos"), F.desc("events"), F.col("first_ord")], "rank")
    return kept.join(_first_titles(rows, titles), "channel").select(
        "channel",
        "channel_url",
        "videos",
        "events",
        days_between("first", "last").alias("span_days"),
        F.date_format("first", "yyyy-MM-dd").alias("first_watched"),
        F.date_format("last", "yyyy-MM-dd").alias("last_watched"),
        "sample_titles",
        "first_ord",
        *(["rank"] if rank else []),
    )


def top_creators(rows: DataFrame, n: int = 40) -> DataFrame:
    return rows.orderBy(F.desc("videos"), F.desc("events"), "first_ord").limit(n)


def cut_summary(events: DataFrame, cache: DataFrame | None = None, min_videos: int = 3) -> DataFrame:
    """How many channels there are, are kept, and fall below the cut."""
    per = attribute(events, cache).groupBy("channel").agg(F.count_distinct("video_id").alias("videos"))
    kept = F.count_if(F.col("videos") >= min_videos)
    return per.agg(F.count("*").alias("channels"), kept.alias("kept"), (F.count("*") - kept).alias("below_cut"))


def viewing_style(rows: DataFrame) -> DataFrame:
    """Volume against span: videos for each day between the first and last view."""
    return rows.withColumn("videos_per_day", F.col("videos") / F.greatest(F.col("span_days"), F.lit(1)))
