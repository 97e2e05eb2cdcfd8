"""Viewing-history exports: discovery, archives, and the JSON and HTML layouts."""

from __future__ import annotations

import glob
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as X
from ..schemas import TAKEOUT_ENTRY
from . import exports

# Where exports are looked for, the first pattern with a hit first.
LOCATIONS = (
    "~/Takeout/YouTube and YouTube Music/history/watch-history.json",
    "~/Downloads/Takeout/YouTube and YouTube Music/history/watch-history.json",
    "~/Downloads/**/watch-history.json",
    "~/Downloads/**/watch-history.html",
    "~/Downloads/takeout-*.zip",
    "~/Downloads/takeout-*.tgz",
    "~/**/watch-history.json",
    "~/**/watch-history.html",
)
# Patterns of video addresses, event cells and links.
VIDEO = "[?&]v=([A-Za-z0-9_-]{11})"
CELL = '(?iu)<div class="outer-cell'
LINK = r'(?s)<a href="([^"]+)"[^>]*>(.*?)</a>'
MUSIC, MUSIC_CHARS = "YouTube Music", 400


def find_export(home: str | None = None) -> str | None:
    """The newest file of the first location that has any."""
    for pattern in LOCATIONS:
        full = pattern.replace("~", home, 1) if home else os.path.expanduser(pattern)
        if found := glob.glob(full, recursive=True):
            return max(sorted(found), key=os.path.getmtime)
    return None


def video_id(url) -> Column:
    """Eleven characters after v= in an address; null where there are none."""
    return X.falsy_to_null(F.regexp_extract(X._col(url), VIDEO, 1))


def json_events(entries: DataFrame) -> DataFrame:
    """Watch events of export entries (in the export's schema, with ingest_ord)."""
    kept = entries.withColumn("video_id", video_id(F.coalesce("titleUrl", F.lit("")))).filter("video_id is not null and (header is null or header = 'YouTube')")
    first = F.get("subtitles", F.lit(0))
    return kept.select(
        "video_id",
        X.watched_title(F.coalesce("title", F.lit(""))).alias("title"),
        first["name"].alias("channel"),
        first["url"].alias("channel_url"),
        F.col("time").alias("watched_at"),
        F.lit("takeout").alias("source"),
        "ingest_ord",
    )


def parse_json(files: DataFrame) -> DataFrame:
    """Watch events of JSON exports that stand whole in a column (text). One that is broken, cut off or empty stops the query."""
    parsed = F.from_json("text", "array<" + TAKEOUT_ENTRY.simpleString() + ">", {"mode": "FAILFAST"})
    entries = files.select(F.posexplode(F.coalesce(parsed, F.raise_error(F.lit("an export holds no JSON array")))).alias("ingest_ord", "e"))
    return json_events(entries.select("e.*", F.col("ingest_ord").cast("long").alias("ingest_ord")))


def parse_elements(items: DataFrame) -> DataFrame:
    """Watch events of the elements of JSON exports (text, ingest_ord)."""
    entry = F.from_json("text", TAKEOUT_ENTRY.simpleString(), {"mode": "FAILFAST"})
    return json_events(items.select(entry.alias("e"), "ingest_ord").select("e.*", "ingest_ord"))


def html_cells(text) -> Column:
    """The event cells of an HTML export."""
    parts = F.split(X._col(text), CELL)
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def anchors(cell) -> Column:
    """The links of a cell: href and label."""
    cell, pattern = X._col(cell), F.lit(LINK)
    return F.arrays_zip(F.regexp_extract_all(cell, pattern, F.lit(1)).alias("href"), F.regexp_extract_all(cell, pattern, F.lit(2)).alias("label"))


def cell_links(cell) -> Column:
    """video_id, title, channel and channel_url of a cell.

    The first link with a video id is the video. Of the other links, those to channels count up to the first with a
    label; the last of them gives the address.
    """
    found = F.transform(anchors(cell), lambda a: F.struct(a["href"].alias("href"), X.strip(X.strip_tags(a["label"])).alias("label"), video_id(a["href"]).alias("vid")))

    def chosen(links: Column, at: Column) -> Column:
        video = F.element_at(links, F.when(at > 0, at))
        # a later link to a video is no video, but may be a channel's
        others = F.filter(links, lambda a, i: (a["vid"].isNull() | ((at > 0) & (i + 1 > at))) & F.contains(a["href"], F.lit("/channel/")))

        def with_channel(others: Column) -> Column:
            named = F.array_position(F.transform(others, lambda a: a["label"] != ""), True).cast("int")
            last = F.when(named > 0, named).otherwise(F.nullif(F.size(others), F.lit(0)))
            channel = F.element_at(others, last)
            return F.struct(video["vid"].alias("video_id"), video["label"].alias("title"), X.falsy_to_null(channel["label"]).alias("channel"), channel["href"].alias("channel_url"))

        return X.let(others, with_channel)

    def first_video(links: Column) -> Column:
        return F.array_position(F.transform(links, lambda a: a["vid"].isNotNull()), True).cast("int")

    return X.let(found, lambda links: X.let(first_video(links), lambda at: chosen(links, at)))


def event_cells(files: DataFrame, *carry: str) -> DataFrame:
    """The carried columns, place and cell of whole HTML exports (text); cells of the music section go."""
    return _events(files.select(*carry, F.posexplode(html_cells("text")).alias("ingest_ord", "cell")))


def _events(cells: DataFrame) -> DataFrame:
    return cells.filter(~F.contains(F.substr("cell", F.lit(1), F.lit(MUSIC_CHARS)), F.lit(MUSIC)))


def parse_html(files: DataFrame) -> DataFrame:
    """Watch events of HTML exports that stand whole in a column (text)."""
    return _cell_events(event_cells(files))


def parse_cells(items: DataFrame) -> DataFrame:
    """Watch events of the cells of HTML exports (text, ingest_ord)."""
    return _cell_events(_events(items.select(F.col("text").alias("cell"), "ingest_ord")))


def _cell_events(cells: DataFrame) -> DataFrame:
    found = cells.select(F.col("ingest_ord").cast("long").alias("ingest_ord"), cell_links("cell").alias("l"), D.locale_stamp("cell").alias("watched_at")).filter("l.video_id is not null")
    return found.select("l.video_id", X.unescape_html("l.title").alias("title"), X.unescape_html("l.channel").alias("channel"), "l.channel_url", "watched_at", F.lit("takeout").alias("source"), "ingest_ord")


def read_export(spark: SparkSession, path: str, range_bytes: int = exports.RANGE) -> DataFrame:
    """Watch events of the exports of either layout at a path or pattern, loose or in archives; files come by name, events as they stand in them."""
    items = exports.items(spark, path, range_bytes)
    found = parse_elements(items[exports.JSON])
    return found.unionByName(parse_cells(items[exports.HTML])) if exports.HTML in items else found
