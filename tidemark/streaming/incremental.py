"""Incremental runs: every start takes what is new, and a killed run costs one batch.

A checkpoint remembers which files are done, so done-sets need not be rebuilt from folders. `foreachBatch` writes what
a batch gives under the batch's number, so that a batch taken again replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import captions
from ..schemas import SRT_FILE
from ..staging import freed, staged

#: Outcomes of a lookup. A timeout may be asked for again; a miss may not.
NAMED, MISS, TIMEOUT = "named", "miss", "timeout"


def new_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", per_batch: int = 1000) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", per_batch).load(path)


def run_once(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]):
    """Take all that is new in batches, then end."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def finished(spark: SparkSession, path: str, name: str) -> dict[int, str]:
    """Folders name=N of a path whose writing was finished, by N."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return {}
    names = [x.getPath().getName() for x in fs.listStatus(top) if x.isDirectory()]
    found = {int(n.partition("=")[2]): f"{path}/{n}" for n in names if n.startswith(f"{name}=")}
    return {k: v for k, v in found.items() if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{v}/_SUCCESS"))}


def read_folders(spark: SparkSession, folders: list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


#: What a later track of a video that has a transcript does: nothing, or it replaces the transcript if it is better.
KEEP_FIRST, TAKE_BETTER = "first", "better"
_TRIED = "id string, rank int, file string, status string"
_MADE = "id string, body string, words long, batch long"


def _best_tried(rows: DataFrame) -> DataFrame:
    """One row for each id: the best track that was tried, and whether there is a transcript. It folds again, in any order."""
    best = rows.groupBy("id").agg(F.min(F.struct("rank", "file")).alias("least"), F.max(F.col("status") == "written").alias("has"))
    return best.select("id", "least.rank", "least.file", F.when(F.col("has"), "written").otherwise("too_short").alias("status"))


def _tried(spark: SparkSession, target: str, before: int) -> DataFrame:
    """What batches of lower numbers tried: the last fold of them, and those after it."""
    folds = {k: v for k, v in finished(spark, f"{target}/tried", "upto").items() if k < before}
    base = max(folds, default=-1)
    rest = [v for k, v in finished(spark, f"{target}/tried", "batch").items() if base < k < before]
    return _best_tried(read_folders(spark, ([folds[base]] if folds else []) + rest, _TRIED))


def convert_captions(spark: SparkSession, source: str, target: str, checkpoint: str, min_chars: int = 200, later: str = KEEP_FIRST, per_batch: int = 1000, fold_every: int = 32):
    """Caption rows to transcripts as they arrive, each video once, however its tracks are dealt to files and runs.

    A batch looks up what earlier ones tried (`target/tried`: id, track, outcome; no bodies, and folded into one table every
    so many batches). A video with a transcript
    keeps it, or with TAKE_BETTER gets a new one from a better track (manual before original before any, then by name).
    One whose tracks were all too short is tried again with a better track alone, as if all of them had come at once.
    Bodies go to `target/made`, and what was tried is written after them. Both stand under the batch's number: a batch
    that is killed and taken again replaces its own folders and looks up only those of lower numbers.
    """
    if later not in (KEEP_FIRST, TAKE_BETTER):
        raise ValueError(f"later is {KEEP_FIRST} or {TAKE_BETTER}")

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = _tried(spark, target, number).select("id", F.struct("rank", "file").alias("least"), (F.col("status") == "written").alias("has"))
        new = captions.best_track(batch).join(known, "id", "left")
        better = F.struct("rank", "file") < F.col("least")
        new = new.filter(F.col("least").isNull() | (better & (F.lit(later == TAKE_BETTER) | ~F.col("has"))))
        made = staged(captions.transcripts(new, min_chars=min_chars, chosen=True), "made")
        made.filter("status = 'written'").select("id", "body", "words", F.lit(number).cast("long").alias("batch")).write.mode("overwrite").parquet(f"{target}/made/batch={number}")
        made.select("id", "rank", "file", "status").write.mode("overwrite").parquet(f"{target}/tried/batch={number}")
        if number % fold_every == fold_every - 1:
            _tried(spark, target, number + 1).write.mode("overwrite").parquet(f"{target}/tried/upto={number}")
        freed(made)

    return run_once(new_files(spark, source, SRT_FILE, per_batch=per_batch), checkpoint, each)


def converted(spark: SparkSession, target: str) -> DataFrame:
    """id, body, words, batch: the transcript of every video that has one. Batches that were not finished don't count."""
    tried = finished(spark, f"{target}/tried", "batch")
    made = {k: v for k, v in finished(spark, f"{target}/made", "batch").items() if k in tried}
    rows = read_folders(spark, list(made.values()), _MADE)
    last = rows.groupBy("id").agg(F.max("batch").alias("batch"))  # of several, the one that replaced the others
    return rows.join(last, ["id", "batch"]).select("id", "body", "words", "batch")


def merged_cache(cache: DataFrame, asked: DataFrame, answers: DataFrame, timed_out: bool = False) -> DataFrame:
    """The cache after a batch: answers, and for ids asked without one a recorded miss (or timeout). Known rows stay.

    asked: video_id; answers: video_id, channel, channel_url.
    """
    state = F.when(F.col("channel").isNotNull(), NAMED).otherwise(MISS)
    got = answers.withColumns({"status": state, "__rank": F.lit(0)})
    none = asked.select("video_id", F.lit(None).cast("string").alias("channel"), F.lit(None).cast("string").alias("channel_url"), F.lit(TIMEOUT if timed_out else MISS).alias("status"), F.lit(2).alias("__rank"))
    rows = cache.withColumn("__rank", F.when(F.col("status") == TIMEOUT, 3).otherwise(1)).unionByName(got).unionByName(none)
    best = F.row_number().over(Window.partitionBy("video_id").orderBy("__rank"))
    return rows.withColumn("__r", best).filter("__r = 1").drop("__r", "__rank")


def settled(cache: DataFrame) -> DataFrame:
    """Ids not to be asked for again."""
    return cache.filter(F.col("status") != TIMEOUT).select("video_id")


#: A row for each lookup: what came back for a video, at a place in its answer. outcome: answer, none (asked for and not answered) or timeout.
LOOKUP = "video_id string, channel string, channel_url string, outcome string, at long"
_STATE = "video_id string, best struct<kind: int, newest: long, last: long, channel: string, channel_url: string>"


def _folded(rows: DataFrame) -> DataFrame:
    """One state for each video: the last answer, else a miss, else a timeout. States fold into states, in any order."""
    return rows.groupBy("video_id").agg(F.min("best").alias("best"))


def _states(lookups: DataFrame, number: int) -> DataFrame:
    kind = F.when(F.col("outcome") == "answer", 0).when(F.col("outcome") == TIMEOUT, 2).otherwise(1)
    own = F.struct(kind.alias("kind"), F.lit(-number).cast("long").alias("newest"), (-F.coalesce("at", F.lit(0))).alias("last"), *(F.when(kind == 0, F.col(c)).alias(c) for c in ("channel", "channel_url")))
    return lookups.filter("video_id is not null").select("video_id", own.alias("best"))


def keep_cache(spark: SparkSession, source: str, target: str, checkpoint: str, compact_every: int = 16, per_batch: int = 1000):
    """Lookups as they arrive, kept: each batch costs its own rows, and a killed one replaces itself when it runs again.

    A batch is folded and written under its number (`target/batch=N`). Every so many batches all that stands is folded
    into `target/upto=N`. A folder counts once it is finished; `kept_cache` reads the last `upto` and what came after.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        _folded(_states(batch, number)).write.mode("overwrite").parquet(f"{target}/batch={number}")
        if number % compact_every == compact_every - 1:
            _folded(_kept(spark, target, number)).write.mode("overwrite").parquet(f"{target}/upto={number}")

    return run_once(new_files(spark, source, LOOKUP, per_batch=per_batch), checkpoint, each)


def _kept(spark: SparkSession, target: str, before: int | None = None) -> DataFrame:
    """The states that stand; before: as if no `upto` of this number or above were there."""
    whole = {k: v for k, v in finished(spark, target, "upto").items() if before is None or k < before}
    base = max(whole, default=-1)
    rest = [v for k, v in sorted(finished(spark, target, "batch").items()) if k > base and (before is None or k <= before)]
    return read_folders(spark, ([whole[base]] if whole else []) + rest, _STATE)


def kept_cache(spark: SparkSession, target: str) -> DataFrame:
    """video_id, channel, channel_url, status of every video that was asked for."""
    kind = F.col("best.kind")
    status = F.when(kind == 2, TIMEOUT).when(F.col("best.channel").isNotNull(), NAMED).otherwise(MISS)
    return _folded(_kept(spark, target)).select("video_id", "best.channel", "best.channel_url", status.alias("status"))
