"""Watch histories: union, order and statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import falsy_to_null
from .ordering import with_ordinal


#: Bits of an input place below the number of its source.
SOURCE_BITS = 52


def union_sources(*sources: DataFrame) -> DataFrame:
    """All events of all sources; a view that two sources hold counts twice.

    The number of the source goes above the place in it, so input order is that of the sources, then that inside them.
    """
    numbered = (s.withColumn("ingest_ord", F.lit(i << SOURCE_BITS) + F.col("ingest_ord")) for i, s in enumerate(sources))
    return reduce(DataFrame.unionByName, numbered)


def _order() -> list[Column]:
    return [F.coalesce("watched_at", F.lit("")), F.col("video_id"), F.col("ingest_ord")]


def place(events: DataFrame) -> Column:
    """A value that orders events as the history does: history_ord where they have one, else the sort key itself."""
    return F.col("history_ord") if "history_ord" in events.columns else F.struct(*_order())


def in_order(events: DataFrame) -> DataFrame:
    """Events with their place in history order: time as text (none first), video, then input order."""
    return with_ordinal(events, _order(), "history_ord")


def sorted_history(events: DataFrame) -> DataFrame:
    return events.orderBy(*_order())


def source_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("source").agg(F.count("*").alias("events"))


def history_stats(events: DataFrame) -> DataFrame:
    """Events, distinct videos, and distinct videos with a channel."""
    named = F.when(falsy_to_null("channel").isNotNull(), F.col("video_id"))
    return events.agg(F.count("*").alias("events"), F.count_distinct("video_id").alias("unique_videos"), F.count_distinct(named).alias("with_channel"))


def unattributed(events: DataFrame) -> DataFrame:
    """Distinct videos of which some event has no channel."""
    return events.filter(falsy_to_null("channel").isNull()).select("video_id").distinct()
