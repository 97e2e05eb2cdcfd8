"""What is still to fetch: anti-joins against what is there, shards and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPACE, file_stem, strip, without_suffix
from .ordering import with_ordinal

def done_ids(transcripts: DataFrame, srt: DataFrame, no_captions: DataFrame) -> DataFrame:
    """Ids with a transcript file, a caption file that is not empty, or a recorded miss.

    transcripts: file; srt: file, size; no_captions: value (lines).
    """
    written = transcripts.filter(F.col("file").endswith(".txt")).select(without_suffix("file").alias("id"))
    fetched = srt.filter(F.col("file").endswith(".srt") & (F.col("size") > 0)).select(file_stem("file").alias("id"))
    missed = no_captions.select(F.split(strip("value"), f"{SPACE}+")[0].alias("id")).filter("id <> ''")
    return written.union(fetched).union(missed).distinct()


def todo(videos: DataFrame, done: DataFrame) -> DataFrame:
    """Videos in input order that are not done."""
    return videos.join(done.select("id"), "id", "left_anti")


def shard(rows: DataFrame, shard: int = 0, shards: int = 1, limit: int = 0, order: str = "ingest_ord") -> DataFrame:
    """Every shards-th row from `shard` on of what is left, then at most limit rows (0: all), with its place."""
    placed = with_ordinal(rows, [F.col(order)], "place")
    mine = placed.filter(F.col("place") % shards == shard).withColumn("place", F.expr(f"place div {shards}"))
    return mine.filter(F.col("place") < limit) if limit else mine


def batches(rows: DataFrame, size: int = 15) -> DataFrame:
    """The batch and number of batches for rows that have a place."""
    return rows.withColumn("batch", F.expr(f"place div {size}"))


def batch_count(rows: DataFrame, size: int = 15) -> DataFrame:
    return rows.agg(F.count("*").alias("ids"), F.ceil(F.count("*") / size).alias("batches"))


def not_fetched(batch: DataFrame, srt: DataFrame) -> DataFrame:
    """Ids of a batch without any caption file, of any size."""
    have = srt.filter(F.col("file").endswith(".srt")).select(file_stem("file").alias("id")).distinct()
    return batch.join(have, "id", "left_anti")


def resolve_plan(ids: DataFrame, cache: DataFrame, limit: int = 150, batch: int = 20) -> DataFrame:
    """The next ids to resolve, in order, with their batch; ids in the cache (misses too) are not asked for again."""
    next_ids = ids.select("video_id").distinct().join(cache.select("video_id"), "video_id", "left_anti").orderBy("video_id").limit(limit)
    return batches(with_ordinal(next_ids, [F.col("video_id")], "place"), batch)


def lookup_lines(lines: DataFrame) -> DataFrame:
    """Cache rows of a lookup's lines: id, channel, address by tabs; NA or nothing is no channel, and an address starts with http."""
    part = F.split("value", "\t", -1)
    name, url = part[1], part[2]
    return lines.filter(F.size(part) == 3).select(part[0].alias("video_id"), F.when(~name.isin("", "NA"), name).alias("channel"), F.when(url.startswith("http"), url).alias("channel_url"))


def yield_report(videos: DataFrame, transcripts: DataFrame, missed: DataFrame) -> DataFrame:
    """Enumerated against transcripts and recorded misses, and the gap between them."""
    counts = [d.agg(F.count_distinct("id").alias(n)) for d, n in ((videos, "enumerated"), (transcripts, "transcripts"), (missed, "no_captions"))]
    one = counts[0].join(F.broadcast(counts[1]), F.lit(True)).join(F.broadcast(counts[2]), F.lit(True))
    return one.withColumn("gap", F.col("enumerated") - F.col("transcripts") - F.col("no_captions"))


def fetch_advice(videos: DataFrame, threshold: int = 200, most: int = 5) -> DataFrame:
    """Whether a list is long enough for shards, and how many."""
    n = F.count("*")
    return videos.agg(n.alias("videos"), F.when(n > threshold, F.least(F.lit(most).cast("long"), F.ceil(n / threshold))).otherwise(1).alias("shards"))
