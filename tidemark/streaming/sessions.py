"""Viewing sessions of a stream: views with less than a gap between them, written once they are over.

A session is written (append mode) when the watermark, the latest time seen less `late`, has passed its end, which is
its last view plus the gap. A row that comes after that is late: it is dropped, a written session is never changed, and
`run` returns how many rows were dropped. Sessions that are still open stay in the state for the next run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sessions(views: DataFrame, key: str = "viewer", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """key, start, end, views, first_video, last_video of each session of rows (key, at, video_id), streamed or not."""
    rows = views.filter(F.col("at").isNotNull()).withColumn("at", F.col("at").cast("timestamp"))  # a watermark needs an instant
    if views.isStreaming:
        rows = rows.withWatermark("at", late)
    order = F.struct("at", "video_id")
    made = rows.groupBy(F.col(key), F.session_window("at", gap).alias("w")).agg(F.count("*").alias("views"), F.min(order).alias("a"), F.max(order).alias("z"))
    return made.select(key, F.col("w.start").alias("start"), F.col("z.at").alias("end"), "views", F.col("a.video_id").alias("first_video"), F.col("z.video_id").alias("last_video"))


def run(made: DataFrame, target: str, checkpoint: str) -> int:
    """Take all that is new, write the sessions that are over, and return how many rows came too late for theirs."""
    query = made.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    query.awaitTermination()
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
