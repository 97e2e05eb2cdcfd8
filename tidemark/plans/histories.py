"""Queries on watch histories, rankings, addresses, stamps and fetch plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as X
from ..operators import history, planning, rank, videos
from ..operators.ordering import keep_first, with_ordinal
from ..sources import browser, takeout
from . import fixtures as T
from .fixtures import EVENTS_SQL, LISTED_SQL

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_RANK_SQL = """
WITH e AS (SELECT *, row_number() OVER (ORDER BY coalesce(watched_at, ''), video_id, ingest_ord) AS ord FROM {rows} WHERE channel IS NOT NULL),
t AS (SELECT channel, title, min(ord) AS o FROM e GROUP BY 1, 2),
f AS (SELECT channel, string_agg(title, '|' ORDER BY o, title) AS sample_titles FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY o, title) AS r FROM t) WHERE r <= 25 GROUP BY channel),
a AS (SELECT channel, arg_min(channel_url, ord) FILTER (WHERE channel_url IS NOT NULL) AS channel_url, count(DISTINCT video_id) AS videos, count(*) AS events,
  min(substr(watched_at, 1, 10)) AS first_watched, max(substr(watched_at, 1, 10)) AS last_watched, min(ord) AS first_ord FROM e GROUP BY channel)
SELECT row_number() OVER (ORDER BY videos DESC, events DESC, first_ord) AS rank, channel, channel_url, videos, events,
  date_diff('day', first_watched::DATE, last_watched::DATE) AS span_days, first_watched, last_watched, sample_titles
FROM a JOIN f USING (channel) WHERE videos >= 3
"""


def _ranking(events, cache=None):
    rows = rank.creators(events, cache, rank=True)
    return rows.select((F.col("rank") + 1).alias("rank"), "channel", "channel_url", "videos", "events", "span_days", "first_watched", "last_watched", F.array_join("sample_titles", "|").alias("sample_titles"))


@query(_RANK_SQL.format(rows=EVENTS_SQL))
def rank_creators(spark, d):
    return _ranking(T.watch_events(spark, d))


_CATALOG_SQL = "(SELECT l_partkey::VARCHAR AS video_id, p_name AS title, l_suppkey::VARCHAR AS channel, NULL::VARCHAR AS channel_url, strftime(l_shipdate, '%Y-%m-%d') AS watched_at, l_orderkey * 10 + l_linenumber AS ingest_ord FROM lineitem JOIN part ON l_partkey = p_partkey)"


@query(_RANK_SQL.format(rows=_CATALOG_SQL))
def rank_creators_catalog(spark, d):
    return _ranking(T.purchases(spark, d))


@query(
    _RANK_SQL.format(
        rows=f"""(SELECT video_id, title, coalesce(e.channel, nullif(c.channel, '')) AS channel, coalesce(e.channel_url, c.channel_url) AS channel_url, watched_at, ingest_ord
  FROM {EVENTS_SQL} e LEFT JOIN (SELECT p_partkey::VARCHAR AS v, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_brand END AS channel, 'https://example.com/b/' || p_brand AS channel_url FROM part) c ON v = video_id)"""
    )
)
def rank_creators_resolved(spark, d):
    p = T.table(spark, d, "part")
    brand = F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_brand"))
    cache = p.select(F.col("p_partkey").cast("string").alias("video_id"), brand.alias("channel"), F.concat(F.lit("https://example.com/b/"), "p_brand").alias("channel_url"))
    return _ranking(T.watch_events(spark, d), cache)


@query(f"SELECT channel, videos, events FROM (SELECT channel, count(DISTINCT video_id) AS videos, count(*) AS events, min(ord) AS o FROM (SELECT *, row_number() OVER (ORDER BY coalesce(watched_at, ''), video_id, ingest_ord) AS ord FROM {EVENTS_SQL}) WHERE channel IS NOT NULL GROUP BY channel) WHERE videos >= 3 ORDER BY videos DESC, events DESC, o LIMIT 40")
def top_creators(spark, d):
    return rank.top_creators(rank.creators(T.watch_events(spark, d))).select("channel", "videos", "events")


@query(f"SELECT count(*) AS channels, count(*) FILTER (WHERE v >= 60) AS kept, count(*) FILTER (WHERE v < 60) AS below_cut FROM (SELECT count(DISTINCT video_id) AS v FROM {EVENTS_SQL} WHERE channel IS NOT NULL GROUP BY channel)")
def creator_cut(spark, d):
    return rank.cut_summary(T.watch_events(spark, d), min_videos=60)


@query(f"SELECT channel, count(DISTINCT video_id) / greatest(date_diff('day', min(watched_at[:10])::DATE, max(watched_at[:10])::DATE), 1) AS videos_per_day FROM {EVENTS_SQL} WHERE channel IS NOT NULL GROUP BY channel HAVING count(DISTINCT video_id) >= 3")
def viewing_style(spark, d):
    return rank.viewing_style(rank.creators(T.watch_events(spark, d))).select("channel", "videos_per_day")


@query(f"SELECT source, count(*) AS events FROM {EVENTS_SQL} GROUP BY source")
def source_counts(spark, d):
    return history.source_counts(T.watch_events(spark, d))


@query(f"SELECT count(*) AS events, count(DISTINCT video_id) AS unique_videos, count(DISTINCT CASE WHEN channel <> '' THEN video_id END) AS with_channel FROM {EVENTS_SQL}")
def history_stats(spark, d):
    return history.history_stats(T.watch_events(spark, d))


_SOURCES = ("view", "click", "purchase")


@query(f"SELECT ingest_ord, source, video_id, row_number() OVER (ORDER BY coalesce(watched_at, ''), video_id, CASE source WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 ELSE 3 END, ingest_ord) - 1 AS history_ord FROM {EVENTS_SQL}")
def history_union_order(spark, d):
    e = T.watch_events(spark, d)
    parts = [*(e.filter(F.col("source") == s) for s in _SOURCES), e.filter(F.col("source").isNull() | ~F.col("source").isin(*_SOURCES))]
    placed = history.in_order(history.union_sources(*parts))
    return placed.select(F.col("ingest_ord").bitwiseAND(F.lit((1 << history.SOURCE_BITS) - 1)).alias("ingest_ord"), "source", "video_id", "history_ord")


@query(f"SELECT DISTINCT video_id FROM {EVENTS_SQL} WHERE coalesce(channel, '') = ''")
def unattributed_ids(spark, d):
    return history.unattributed(T.watch_events(spark, d))


@query("SELECT video_id, (row_number() OVER (ORDER BY video_id) - 1) AS place, (row_number() OVER (ORDER BY video_id) - 1) // 20 AS batch FROM (SELECT doc_id::VARCHAR AS video_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY 1 LIMIT 150)")
def resolve_plan(spark, d):
    ids = T.documents(spark, d).select(F.col("id").alias("video_id"))
    known = T.label_info(spark, d).select(F.col("id").alias("video_id"))
    return planning.resolve_plan(ids, known)


@query("SELECT c.v AS video_id, CASE WHEN n NOT IN ('', 'NA') THEN n END AS channel, CASE WHEN starts_with(u, 'http') THEN u END AS channel_url FROM (SELECT p_partkey::VARCHAR AS v, CASE WHEN p_size % 5 = 0 THEN 'NA' WHEN p_size % 5 = 1 THEN '' ELSE p_brand END AS n, CASE WHEN p_size % 2 = 0 THEN 'NA' ELSE 'https://example.com/' || p_brand END AS u FROM part WHERE p_size % 7 <> 0) c")
def lookup_lines(spark, d):
    p = T.table(spark, d, "part")
    name = F.when(F.col("p_size") % 5 == 0, "NA").when(F.col("p_size") % 5 == 1, "").otherwise(F.col("p_brand"))
    url = F.when(F.col("p_size") % 2 == 0, "NA").otherwise(F.concat(F.lit("https://example.com/"), "p_brand"))
    line = F.concat_ws("\t", F.col("p_partkey").cast("string"), name, url)
    return planning.lookup_lines(p.select(F.when(F.col("p_size") % 7 == 0, F.concat(line, F.lit("\tmore"))).otherwise(line).alias("value")))


@query("SELECT d.doc_id, coalesce(nullif(CASE WHEN d.doc_id % 2 = 0 THEN '' ELSE source END, ''), CASE WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN '' END) AS channel_raw, coalesce(nullif(CASE WHEN d.doc_id % 2 = 0 THEN '' ELSE source END, ''), nullif(CASE WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN '' END, '')) AS channel FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def channel_coalesce(spark, d):
    own = F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("source"))
    side = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "")
    rows = T.table(spark, d, "documents").join(T.table(spark, d, "labels"), "doc_id", "left")
    return rows.select("doc_id", F.coalesce(X.falsy_to_null(own), side).alias("channel_raw"), X.first_truthy(own, side).alias("channel"))


_URL = "CASE page_id % 4 WHEN 0 THEN url || '?v=' || lpad(page_id::VARCHAR, 11, 'a') WHEN 1 THEN url || '&v=' || lpad(page_id::VARCHAR, 14, 'b') WHEN 2 THEN url || '&amp;v=' || lpad(page_id::VARCHAR, 11, 'c') ELSE url END"


@query(f"SELECT page_id, regexp_extract(u, '[?&]v=([A-Za-z0-9_-]{{11}})', 1) AS video_id FROM (SELECT page_id, {_URL} AS u FROM pages) WHERE regexp_matches(u, '[?&]v=[A-Za-z0-9_-]{{11}}')")
def video_id_extract(spark, d):
    i = F.col("page_id").cast("string")
    u = (
        F.when(F.col("page_id") % 4 == 0, F.concat("url", F.lit("?v="), F.lpad(i, 11, "a")))
        .when(F.col("page_id") % 4 == 1, F.concat("url", F.lit("&v="), F.lpad(i, 14, "b")))
        .when(F.col("page_id") % 4 == 2, F.concat("url", F.lit("&amp;v="), F.lpad(i, 11, "c")))
        .otherwise(F.col("url"))
    )
    return T.table(spark, d, "pages").select("page_id", takeout.video_id(u).alias("video_id")).filter("video_id is not null")


@query(
    """
SELECT x.video_id, x.title, x.channel, x.channel_url, x.watched_at, 'takeout' AS source, ingest_ord FROM (
SELECT lpad(page_id::VARCHAR, 11, 'v') AS video_id, CASE WHEN page_id % 2 = 0 THEN url ELSE 'Watched ' || url END AS t, regexp_replace(CASE WHEN page_id % 2 = 0 THEN url ELSE 'Watched ' || url END, '^Watched ', '') AS title,
  CASE WHEN page_id % 5 <> 0 THEN 'c' || (page_id % 7)::VARCHAR END AS channel, CASE WHEN page_id % 5 <> 0 THEN 'https://example.com/' || (page_id % 7)::VARCHAR END AS channel_url,
  '2024-01-02T03:04:05Z' AS watched_at, page_id AS ingest_ord FROM pages WHERE page_id % 3 <> 1 AND page_id % 11 <> 0) x
"""
)
def takeout_json(spark, d):
    i = F.col("page_id")
    entry = F.struct(
        F.when(i % 11 != 0, F.concat(F.lit("https://www.youtube.com/watch?v="), F.lpad(i.cast("string"), 11, "v"))).alias("titleUrl"),
        F.when(i % 3 == 0, "YouTube").when(i % 3 == 1, "YouTube Music").alias("header"),
        F.when(i % 2 == 0, F.col("url")).otherwise(F.concat(F.lit("Watched "), "url")).alias("title"),
        F.when(i % 5 != 0, F.array(F.struct(F.concat(F.lit("c"), (i % 7).cast("string")).alias("name"), F.concat(F.lit("https://example.com/"), (i % 7).cast("string")).alias("url")))).alias("subtitles"),
        F.lit("2024-01-02T03:04:05Z").alias("time"),
    )
    rows = T.table(spark, d, "pages").select(F.col("page_id").alias("ingest_ord"), F.from_json(F.to_json(entry), takeout.TAKEOUT_ENTRY.simpleString()).alias("e"))
    return takeout.json_events(rows.select("e.*", "ingest_ord"))


_ANCHORS = "regexp_extract_all(html, '(?s)<a href=\"([^\"]+)\"[^>]*>(.*?)</a>', {0})"


@query(f"SELECT page_id, unnest({_ANCHORS.format(1)}) AS href, unnest({_ANCHORS.format(2)}) AS label FROM pages")
def html_anchors(spark, d):
    return T.table(spark, d, "pages").select("page_id", F.explode(takeout.anchors("html")).alias("a")).select("page_id", "a.href", "a.label")


_CELLS_SQL = "(SELECT page_id, unnest(c) AS cell, generate_subscripts(c, 1) AS pos FROM (SELECT page_id, string_split_regex(replace(html, '<li>', '<DIV class=\"outer-cell'), '(?i)<div class=\"outer-cell')[2:] AS c FROM pages))"


@query(f"SELECT page_id, pos - 1 AS ingest_ord, cell FROM (SELECT page_id, pos, replace(cell, 'the</a>', 'YouTube Music</a>') AS cell FROM {_CELLS_SQL}) x WHERE NOT contains(substr(cell, 1, 400), 'YouTube Music')")
def html_cells(spark, d):
    """List items as event cells; some labels are those of the music section."""
    html = F.replace(F.replace("html", F.lit("<li>"), F.lit('<DIV class="outer-cell')), F.lit("the</a>"), F.lit("YouTube Music</a>"))
    cells = takeout.event_cells(T.table(spark, d, "pages").select("page_id", html.alias("text")), "page_id")
    return cells.select("page_id", F.col("ingest_ord").cast("long").alias("ingest_ord"), "cell")


_CHANNEL_LINKS = "(SELECT page_id, unnest(x) AS href, trim(regexp_replace(unnest(y), '<[^>]+>', '', 'g')) AS label, generate_subscripts(x, 1) AS pos FROM (SELECT page_id, " + ", ".join(_ANCHORS.format(i).replace("(html,", "(replace(html, ' href=\"/', ' href=\"/channel/'),") + f" AS {c}" for i, c in ((1, "x"), (2, "y"))) + " FROM pages))"


@query(
    f"""
SELECT p.page_id, lpad(p.page_id::VARCHAR, 11, 'x') AS video_id, 'A ' || p.page_id::VARCHAR AS title, arg_min(label, pos) FILTER (WHERE label <> '') AS channel, coalesce(arg_min(href, pos) FILTER (WHERE label <> ''), arg_max(href, pos)) AS channel_url
FROM pages p LEFT JOIN {_CHANNEL_LINKS} l ON l.page_id = p.page_id AND contains(href, '/channel/') GROUP BY p.page_id
"""
)
def html_first_link(spark, d):
    """A link to a video before each page, whose own links are made those of channels."""
    i = F.col("page_id").cast("string")
    video = F.concat(F.lit('<a href="https://y/watch?v='), F.lpad(i, 11, "x"), F.lit('" class="k"> <b>A</b> '), i, F.lit("</a>"))
    cell = F.concat(video, F.replace("html", F.lit(' href="/'), F.lit(' href="/channel/')), F.lit('<a href="https://y/watch?v=zzzzzzzzzzz">no</a>'))
    return T.table(spark, d, "pages").select("page_id", takeout.cell_links(cell).alias("l")).select("page_id", "l.*")


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS stamp FROM events")
def stamp_dmy(spark, d):
    cell = F.concat(F.lit("x 1 b, "), F.date_format("ts", "d MMM yyyy, HH:mm:ss"), F.lit(" ACST</div>"))
    return T.table(spark, d, "events").select("event_id", D.locale_stamp(cell).alias("stamp"))


@query("SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS stamp FROM events")
def stamp_mdy(spark, d):
    good = F.concat(F.date_format("ts", "MMMM d, yyyy, h:mm:ss"), F.lit(" "), F.date_format("ts", "a"), F.lit(" ACST"))
    cell = F.when(F.col("event_id") % 10 != 0, good).otherwise(F.regexp_replace(good, "^[A-Za-z]+", "Xyz"))
    return T.table(spark, d, "events").select("event_id", D.locale_stamp(cell).alias("stamp"))


@query("SELECT event_id, CASE WHEN event_id % 6 < 4 THEN strftime(ts, '%Y-%m-%d') END AS day FROM events")
def iso_day(spark, d):
    k = F.col("event_id") % 6
    date = F.date_format("ts", "yyyy-MM-dd")
    clock = F.date_format("ts", "HH:mm:ss")
    s = F.when(k == 0, F.concat(date, F.lit("T"), clock)).when(k == 1, F.concat(date, F.lit(" "), clock, F.lit("+09:30"))).when(k == 2, F.concat(date, F.lit("T"), clock, F.lit("Z"))).when(k == 3, F.replace(date, F.lit("-"))).when(k == 4, F.concat(F.substr(date, F.lit(1), F.lit(8)), F.lit("45"))).otherwise(F.concat(date, F.lit("Tgarbage")))
    return T.table(spark, d, "events").select("event_id", F.date_format(D.iso_day(s), "yyyy-MM-dd").alias("day"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS chrome, strftime(ts, '%Y-%m-%d %H:%M:%S') AS firefox, NULL::VARCHAR AS never FROM events")
def browser_epoch(spark, d):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return T.table(spark, d, "events").select("event_id", D.visited_at(D.from_epoch_1601(us + 11_644_473_600_000_000)).alias("chrome"), D.visited_at(D.from_epoch_1970(us)).alias("firefox"), D.visited_at(D.from_epoch_1601(F.lit(0))).alias("never"))


@query("SELECT lpad(page_id::VARCHAR, 11, 'w') AS video_id, 'page ' || page_id::VARCHAR AS title, 'chrome' AS source, CASE WHEN page_id % 2 = 0 THEN '2024-01-01 00:00:00' END AS watched_at FROM pages WHERE page_id % 3 <> 2")
def browser_rows(spark, d):
    i = F.col("page_id")
    url = F.when(i % 3 == 0, F.concat(F.lit("https://www.YouTube.com/watch?v="), F.lpad(i.cast("string"), 11, "w"))).when(i % 3 == 1, F.concat(F.lit("https://m.youtube.com/watch?t=1&v="), F.lpad(i.cast("string"), 11, "w"))).otherwise(F.col("url"))
    rows = T.table(spark, d, "pages").select(url.alias("url"), F.concat(F.lit("page "), i.cast("string"), F.lit(" - YouTube")).alias("title"), F.when(i % 2 == 0, F.lit(13_348_540_800_000_000)).otherwise(F.lit(0)).alias("visited"), i.alias("ingest_ord"))
    return browser.browser_events(rows, "chrome", 1601).select("video_id", "title", "source", "watched_at")


@query("SELECT p_partkey, p_name AS title FROM part")
def title_suffix(spark, d):
    end = F.when(F.col("p_size") % 2 == 0, " - YouTube").otherwise("  -YouTube")
    return T.table(spark, d, "part").select("p_partkey", X.page_title(F.concat("p_name", end)).alias("title"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name ELSE 'watched ' || p_name END AS title FROM part")
def watched_prefix(spark, d):
    start = F.when(F.col("p_size") % 2 == 0, "Watched ").otherwise("watched ")
    return T.table(spark, d, "part").select("p_partkey", X.watched_title(F.concat(start, F.col("p_name"))).alias("title"))


@query("SELECT page_id, regexp_replace(regexp_replace(u, '/+$', ''), '/(videos|shorts|streams|playlists)$', '') || '/shorts' AS url, CASE WHEN page_id % 2 = 0 THEN 'h.' || page_id::VARCHAR ELSE string_split(u, '/')[-1] END AS handle FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'https://y/@h.' || page_id::VARCHAR || '/videos//' ELSE url END AS u FROM pages)")
def channel_url_norm(spark, d):
    u = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("https://y/@h."), F.col("page_id").cast("string"), F.lit("/videos//"))).otherwise(F.col("url"))
    return T.table(spark, d, "pages").select("page_id", X.channel_tab_url(u, "shorts").alias("url"), X.channel_handle(u).alias("handle"))


@query("SELECT p_partkey, coalesce(nullif(trim(regexp_replace(lower(CASE WHEN p_size % 10 = 0 THEN '!!' ELSE p_name || ' & ' || p_brand || '!' END), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'channel') AS slug FROM part")
def channel_slug(spark, d):
    name = F.when(F.col("p_size") % 10 == 0, "!!").otherwise(F.concat("p_name", F.lit(" & "), "p_brand", F.lit("!")))
    return T.table(spark, d, "part").select("p_partkey", X.channel_slug(name).alias("slug"))


@query("SELECT doc_id::VARCHAR AS id, doc_id AS ingest_ord FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND doc_id % 10 <> 0")
def fetch_todo(spark, d):
    docs = T.documents(spark, d)
    srt = T.label_info(spark, d).select(F.concat("id", F.when(F.col("view_count") == 1, ".en.srt").otherwise(".en-orig.srt")).alias("file"), F.lit(5).alias("size"))
    written = docs.filter("ingest_ord % 20 = 0").select(F.concat("id", F.lit(".txt")).alias("file"))
    missed = docs.filter("ingest_ord % 10 = 0").select(F.concat(F.lit(" "), "id", F.lit(" none")).alias("value"))
    return planning.todo(docs.select("id", "ingest_ord"), planning.done_ids(written, srt, missed))


@query("SELECT id, place // 4 AS place, place // 4 // 15 AS batch FROM (SELECT doc_id::VARCHAR AS id, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) WHERE place % 4 = 1 AND place // 4 < 40")
def fetch_shards(spark, d):
    left = planning.todo(T.documents(spark, d).select("id", "ingest_ord"), T.label_info(spark, d))
    return planning.batches(planning.shard(left, 1, 4, 40)).select("id", "place", "batch")


@query("SELECT count(*) AS ids, (count(*) + 14) // 15 AS batches FROM documents")
def fetch_batches(spark, d):
    return planning.batch_count(T.documents(spark, d))


@query("SELECT doc_id::VARCHAR AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def fetch_missing(spark, d):
    srt = T.label_info(spark, d).select(F.concat("id", F.lit(".en.srt")).alias("file"), F.col("view_count").alias("size"))
    return planning.not_fetched(T.documents(spark, d).select("id"), srt)


@query("SELECT count(*) AS videos, CASE WHEN count(*) > 200 THEN least(5, (count(*) + 199) // 200) ELSE 1 END AS shards FROM documents")
def fetch_advice(spark, d):
    return planning.fetch_advice(T.documents(spark, d))


@query("SELECT n AS enumerated, t AS transcripts, m AS no_captions, n - t - m AS gap FROM (SELECT count(*) AS n, (SELECT count(DISTINCT doc_id) FROM labels WHERE quality = 1) AS t, (SELECT count(DISTINCT doc_id) FROM labels WHERE quality = 0) AS m FROM documents)")
def yield_reconcile(spark, d):
    info = T.label_info(spark, d)
    return planning.yield_report(T.documents(spark, d), info.filter("duration = 1"), info.filter("duration = 0"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE r = 1")
def dedupe_keep_first(spark, d):
    return keep_first(T.table(spark, d, "events"), "user_id", "event_id").select("user_id", "event_id", "event_type")


@query(f"SELECT id, title, 'https://www.youtube.com/watch?v=' || id AS url, upload_date, duration, view_count FROM {LISTED_SQL}")
def reduce_videos(spark, d):
    once = T.listed(spark, d)
    again = once.withColumns({"title": F.lit("later"), "ingest_ord": F.col("ingest_ord") + 10_000_000})
    nameless = once.withColumn("id", F.lit(""))
    return videos.reduce_videos(once.unionByName(again).unionByName(nameless)).drop("ingest_ord")


@query(f"SELECT (SELECT coalesce(nullif(channel, ''), uploader) FROM {LISTED_SQL} ORDER BY ingest_ord LIMIT 1) AS channel, count(*) AS videos, sum(coalesce(duration, 0)) / 3600 AS hours FROM {LISTED_SQL}")
def enumerate_report(spark, d):
    raw = T.listed(spark, d)
    return videos.channel_name(raw).join(F.broadcast(videos.runtime(raw)), F.lit(True))


_FILL = f"(SELECT v.id, coalesce(v.upload_date, l.ud) AS upload_date, coalesce(v.view_count, l.vc) AS view_count, coalesce(v.duration, l.du) AS duration, v.upload_date IS NULL AND l.ud IS NOT NULL AS filled FROM {LISTED_SQL} v LEFT JOIN (SELECT doc_id::VARCHAR AS id, '20240101' AS ud, toxic::BIGINT AS vc, quality::DOUBLE AS du FROM labels) l ON l.id = v.id)"


@query(f"SELECT * FROM {_FILL}")
def backfill_meta(spark, d):
    return videos.backfill(T.listed(spark, d), T.label_info(spark, d)).select("id", "upload_date", "view_count", "duration", "filled")


@query(f"SELECT count(*) AS videos, count(*) FILTER (WHERE filled) AS dates_filled, min(upload_date) AS first_date, max(upload_date) AS last_date, count(*) FILTER (WHERE upload_date IS NULL) AS undated, (SELECT count(DISTINCT doc_id) FROM labels) AS info_files FROM {_FILL}")
def backfill_report(spark, d):
    info = T.label_info(spark, d)
    return videos.backfill_report(videos.backfill(T.listed(spark, d), info), info)


@query("SELECT user_id::VARCHAR AS id, arg_max(event_type, event_id) AS upload_date, max(event_id) AS view_count, arg_max(value, event_id) AS duration FROM events GROUP BY user_id")
def latest_info(spark, d):
    e = T.table(spark, d, "events")
    rows = e.select(F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("upload_date"), F.col("event_id").alias("view_count"), F.col("value").alias("duration"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("file"))
    return videos.latest_info(rows)


@query("SELECT p_partkey, p_type, row_number() OVER (PARTITION BY p_type ORDER BY p_size, p_partkey) - 1 AS place FROM part")
def ordinal_within(spark, d):
    return with_ordinal(T.table(spark, d, "part"), [F.col("p_size"), F.col("p_partkey")], "place", ["p_type"]).select("p_partkey", "p_type", "place")
