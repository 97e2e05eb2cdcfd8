"""Transcripts labelled by a taxonomy of title patterns, with coverage and policy reports."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.patterns import Matcher
from ..session import importable
from .ordering import with_ordinal

#: Patterns that are tried one after the other as quickly as they are looked up in an index; the rows are the same.
FEW = 128
#: Domains of a taxonomy table at most: it is a list that people write, and goes to every task.
MOST_DOMAINS = 100_000


def with_titles(transcripts: DataFrame, videos: DataFrame, order: str = "ingest_ord") -> DataFrame:
    """Transcripts (id, words) with title and views; of repeated ids the last video counts, and one without a video has neither."""
    last = videos.groupBy("id").agg(*(F.max_by(c, order).alias(c) for c in ("title", "view_count")))
    joined = transcripts.join(last, "id", "left")
    return joined.select("id", "words", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("view_count", F.lit(0)).cast("long").alias("views"))


def labelled(rows: DataFrame, domains: list[tuple[str, str]]) -> DataFrame:
    """A row for each domain whose pattern is found in a title.

    The few patterns are known when the plan is made, so each is a literal in the expression: nothing is joined,
    and no pattern is compiled for a row.
    """
    hits = F.array(*(F.when(X.searches("title", p), F.lit(name)) for name, p in domains))
    return rows.withColumn("domain", F.explode(F.filter(hits, lambda x: x.isNotNull())))


def labelled_by_index(rows: DataFrame, domains: list[tuple[str, str]]) -> DataFrame:
    """The same for taxonomies of thousands of patterns: a title costs its own length and the patterns likely to match it.

    The patterns, which are read on the driver, go to each task once; null titles match as empty ones.
    """
    importable(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(domains)  # as long as the taxonomy's file

    @F.pandas_udf("array<string>")
    def matched(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        match = Matcher(shared.value)
        for titles in batches:
            yield pd.Series([match(t or "") for t in titles], dtype=object)

    return rows.withColumn("domain", F.explode(matched("title")))


def labelled_by_table(rows: DataFrame, domains: DataFrame) -> DataFrame:
    """The same for a taxonomy held in a table (domain, pattern in Python's dialect), one of at most MOST_DOMAINS rows; patterns are checked here."""
    taxonomy = [(r.domain, r.pattern) for r in domains.select("domain", "pattern").limit(MOST_DOMAINS + 1).collect()]
    if len(taxonomy) > MOST_DOMAINS:
        raise ValueError(f"a taxonomy has at most {MOST_DOMAINS} domains")
    for _, pattern in taxonomy:
        X.java_pattern(pattern)
    return (labelled if len(taxonomy) <= FEW else labelled_by_index)(rows, taxonomy)


_MEMBER = ("domain", "place", "id", "title", "views", "words")


def members(hits: DataFrame) -> DataFrame:
    """Members of each domain in order of views, then id; a domain may take many tasks."""
    placed = with_ordinal(hits, [F.desc("views"), F.col("id")], "place", ["domain"])
    return placed.withColumn("place", F.col("place") + 1).select(*_MEMBER)


def top_members(hits: DataFrame, n: int = 25) -> DataFrame:
    """The first n members of each domain; every task keeps n of a domain before they meet."""
    place = F.row_number().over(Window.partitionBy("domain").orderBy(F.desc("views"), "id"))
    return hits.withColumn("place", place.cast("long")).filter(F.col("place") <= n).select(*_MEMBER)


def summary(hits: DataFrame, domains: DataFrame) -> DataFrame:
    """Videos and words of every domain, empty ones too."""
    per = hits.groupBy("domain").agg(F.count("*").alias("videos"), F.sum("words").alias("words"))
    return domains.select("ord", "domain").join(per, "domain", "left").select("ord", "domain", F.coalesce("videos", F.lit(0)).alias("videos"), F.coalesce("words", F.lit(0)).alias("words"))


def unlabelled(rows: DataFrame, hits: DataFrame) -> DataFrame:
    return rows.join(hits.select("id").distinct(), "id", "left_anti")


def unlabelled_sample(rows: DataFrame, hits: DataFrame, n: int = 15, width: int = 78) -> DataFrame:
    return unlabelled(rows, hits).orderBy("id").limit(n).select("id", F.substr("title", F.lit(1), F.lit(width)).alias("title"))


def coverage(rows: DataFrame, hits: DataFrame, most_unlabelled: float = 0.15) -> DataFrame:
    """Labelled and unlabelled transcripts, the unlabelled share, and whether the taxonomy is wide enough."""
    marked = rows.select("id").join(hits.select("id", F.lit(True).alias("hit")).distinct(), "id", "left")
    without = F.count_if(F.col("hit").isNull())
    report = marked.agg(F.count("*").alias("transcripts"), F.count_if(F.col("hit").isNotNull()).alias("labelled"), without.alias("unlabelled"), F.coalesce(without / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias("share"))
    return report.withColumn("wide_enough", F.col("share") < most_unlabelled)


def domain_gate(totals: DataFrame, videos: int = 15, words: int = 40_000) -> DataFrame:
    """Domains too thin to stand alone."""
    return totals.withColumn("fold", (F.col("videos") < videos) | (F.col("words") < words))


def corpus_gate(transcripts: DataFrame, least: int = 15, one_topic: int = 40, one_topic_words: int = 100_000) -> DataFrame:
    """decline, one or several, by usable transcripts and words."""
    totals = transcripts.agg(F.count("*").alias("transcripts"), F.coalesce(F.sum("words"), F.lit(0)).alias("words"))
    thin = (F.col("transcripts") < one_topic) | (F.col("words") < one_topic_words)
    return totals.withColumn("verdict", F.when(F.col("transcripts") < least, "decline").when(thin, "one").otherwise("several"))


def nested(hits: DataFrame, domains: DataFrame) -> DataFrame:
    """A row for each domain with its members in order, for taxonomies of a page; `sinks.json_groups` writes any."""
    item = F.struct("place", F.struct("id", "title", "views", "words").alias("m"))
    grouped = members(hits).groupBy("domain").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["m"]).alias("members"))
    return domains.select("ord", "domain").join(grouped, "domain", "left").withColumn("members", F.coalesce("members", F.array().cast("array<struct<id:string,title:string,views:bigint,words:bigint>>")))
