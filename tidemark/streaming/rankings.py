"""Rankings kept up over runs: each export is summed up once, and a new one costs its own rows.

A run leaves a row for each (channel, video) of its events, with their number, days, first place and first address, and
each channel's first distinct titles. All of these fold by sums, minima and maxima, so those of several runs, folded,
are those of one run over everything: a title that is among the first of all is among the first of its own run. Events
without a channel keep a row of their own by video, and take channel and address from the cache when the ranking is
made, so a video that is resolved later needs no old export.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import days_between, iso_day
from ..functions.text import first_truthy
from ..operators.history import SOURCE_BITS
from ..operators.ordering import with_ordinal
from ..operators.rank import TITLES
from ..staging import staged
from .incremental import finished, read_folders

_PLACE = "struct<at: string, video: string, ord: bigint>"
_VIEWS = f"channel string, video_id string, events long, first date, last date, place {_PLACE}, own struct<place: {_PLACE}, url: string>, bare {_PLACE}"
_TITLES = f"channel string, video_id string, title string, place {_PLACE}"


def _place(number: int) -> Column:
    """History order: time, video, number of the run, place in it."""
    return F.struct(F.coalesce("watched_at", F.lit("")).alias("at"), F.col("video_id").alias("video"), (F.lit(number << SOURCE_BITS) + F.col("ingest_ord")).alias("ord"))


def _folded_views(rows: DataFrame) -> DataFrame:
    return rows.groupBy("channel", "video_id").agg(F.sum("events").alias("events"), F.min("first").alias("first"), F.max("last").alias("last"), F.min("place").alias("place"), F.min("own").alias("own"), F.min("bare").alias("bare"))


def _first_titles(rows: DataFrame, most: int) -> DataFrame:
    """The first distinct titles of each channel, and all of what has no channel yet; a channel's are cut before they meet."""
    seen = rows.groupBy("channel", "video_id", "title").agg(F.min("place").alias("place"))
    place = F.row_number().over(Window.partitionBy("channel", "video_id").orderBy("place", "title"))
    return seen.withColumn("r", place).filter(F.col("r") <= most).drop("r")


def summed_up(events: DataFrame, number: int = 0, titles: int = TITLES) -> tuple[DataFrame, DataFrame]:
    """What the events of a run leave: rows by channel and video, and first titles (video_id is null where there is a channel)."""
    rows = events.select(first_truthy("channel").alias("channel"), "video_id", "title", first_truthy("channel_url").alias("url"), iso_day("watched_at").alias("day"), _place(number).alias("place"))
    url = F.col("url").isNotNull()
    views = rows.groupBy("channel", "video_id").agg(
        F.count("*").alias("events"),
        F.min("day").alias("first"),
        F.max("day").alias("last"),
        F.min("place").alias("place"),
        F.min(F.when(url, F.struct("place", "url"))).alias("own"),
        F.min(F.when(~url, F.col("place"))).alias("bare"),
    )
    return views, _first_titles(rows.withColumn("video_id", F.when(F.col("channel").isNull(), F.col("video_id"))), titles)


def add_run(spark: SparkSession, path: str, number: int, events: DataFrame, titles: int = TITLES) -> None:
    """Sum up a run under its number; one that is added again replaces itself. Earlier runs are not read."""
    views, first = summed_up(events, number, titles)
    views.write.mode("overwrite").parquet(f"{path}/views/run={number}")
    first.write.mode("overwrite").parquet(f"{path}/titles/run={number}")


def _runs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The folded rows of every run that was finished."""
    done = finished(spark, f"{path}/titles", "run")
    views = [v for k, v in finished(spark, f"{path}/views", "run").items() if k in done]
    return _folded_views(read_folders(spark, views, _VIEWS)), read_folders(spark, list(done.values()), _TITLES)


def creators(spark: SparkSession, path: str, cache: DataFrame | None = None, min_videos: int = 3, titles: int = TITLES, rank: bool = False) -> DataFrame:
    """`rank.creators` of all runs, of what they left."""
    views, first = _runs(spark, path)
    none = F.lit(None).cast("string")
    if cache is None:
        views, first = views.withColumns({"name": none, "address": none}), first.withColumn("name", none)
    else:
        known = cache.select(F.col("video_id").alias("__id"), F.col("channel").alias("name"), F.col("channel_url").alias("address"))
        views = views.join(known, F.col("video_id") == F.col("__id"), "left")
        first = first.join(known, F.col("video_id") == F.col("__id"), "left")
    address = first_truthy("address")
    views = views.withColumn("channel", first_truthy("channel", "name")).filter("channel is not null")
    views = views.withColumn("own", F.least("own", F.when(address.isNotNull() & F.col("bare").isNotNull(), F.struct(F.col("bare").alias("place"), address.alias("url")))))
    totals = views.groupBy("channel").agg(F.count_distinct("video_id").alias("videos"), F.sum("events").alias("events"), F.min("first").alias("first"), F.max("last").alias("last"), F.min("own").alias("own"), F.min("place").alias("first_ord"))
    kept = totals.filter(F.col("videos") >= min_videos)
    if rank:
        kept = with_ordinal(staged(kept, "totals"), [F.desc("videos"), F.desc("events"), F.col("first_ord")], "rank")
    named = first.select(first_truthy("channel", "name").alias("channel"), "title", "place", none.alias("video_id")).filter("channel is not null")
    listed = _first_titles(named, titles).groupBy("channel").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "title"))), lambda x: x["title"]).alias("sample_titles"))
    return kept.join(listed, "channel").select(
        "channel",
        F.col("own.url").alias("channel_url"),
        "videos",
        "events",
        days_between("first", "last").alias("span_days"),
        F.date_format("first", "yyyy-MM-dd").alias("first_watched"),
        F.date_format("last", "yyyy-MM-dd").alias("last_watched"),
        "sample_titles",
        "first_ord",
        *(["rank"] if rank else []),
    )


def history_stats(spark: SparkSession, path: str) -> DataFrame:
    """`history.history_stats` of all runs."""
    views, _ = _runs(spark, path)
    named = F.when(F.col("channel").isNotNull(), F.col("video_id"))
    return views.agg(F.coalesce(F.sum("events"), F.lit(0)).alias("events"), F.count_distinct("video_id").alias("unique_videos"), F.count_distinct(named).alias("with_channel"))
