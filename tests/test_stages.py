"""Stages on small inputs that hold the awkward cases."""

import hashlib
import io
import json
import sqlite3
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark import sinks
from tidemark.operators import captions, cluster, documents, history, planning, rank, videos
from tidemark.sources import browser, lists, takeout
from tidemark.sources import documents as docs_source
from tidemark.streaming import incremental


def events(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], S.ORDERED_EVENT)


def test_ranking_of_awkward_events(spark):
    e = events(
        spark,
        [("v1", "t1", "A", None, "2024-01-01T00:00:00", "takeout"), ("v2", "t1", "A", "u", "bad", "takeout"), ("v3", "t2", "", None, "2024-01-05", "chrome"), ("v4", "x", None, None, None, "chrome"), ("v1", "t3", "A", "w", None, "firefox")],
    )
    cache = spark.createDataFrame([("v3", "A", "cached"), ("v4", None, "http://z")], S.CHANNEL_CACHE)
    out = rank.creators(e, cache, min_videos=3).collect()
    assert [(r.channel, r.videos, r.events, r.span_days, r.first_watched, r.last_watched, r.channel_url, r.sample_titles) for r in out] == [("A", 3, 4, 4, "2024-01-01", "2024-01-05", "w", ["t3", "t1", "t2"])], "undated events come first"
    assert rank.creators(e.filter("ingest_ord = 1"), None, 1).first().first_watched is None
    assert history.history_stats(e).first() == (5, 4, 2)


def test_ranking_goes_by_history_order(spark, tmp_path):
    """Exports are newest first and every source counts from 0: places in the input say nothing."""
    export = events(spark, [("v3", "newest", "A", "url-new", "2024-03-01", "takeout"), ("v2", "middle", "A", None, "2024-02-01", "takeout"), ("v1", "oldest", "A", "url-old", "2024-01-01", "takeout"), ("w1", "b", "B", None, "2024-01-02", "takeout"), ("w2", "b", "B", None, "2024-01-03", "takeout"), ("w3", "b", "B", None, "2024-04-01", "takeout")])
    other = events(spark, [("v3", "same time, later source", "A", "url-2", "2024-03-01", "chrome"), ("v0", "undated", "A", None, None, "chrome"), ("w3", "b", "B", None, "2024-04-01", "chrome"), ("w0", "b", "B", None, "2024-02-02", "chrome")])
    both = history.union_sources(export, other)
    assert both.select("ingest_ord").distinct().count() == 10
    sinks.json_lines(history.sorted_history(both), str(tmp_path / "history"))
    for e in (both, history.in_order(both), lists.history(spark, str(tmp_path / "history"))):
        out = {r.channel: r for r in rank.creators(e, rank=True).collect()}
        assert (out["A"].channel_url, out["A"].sample_titles) == ("url-old", ["undated", "oldest", "middle", "newest", "same time, later source"])
        assert (out["A"].rank, out["B"].rank) == (0, 1), "equal counts go by the first event"


def test_places_in_history(spark):
    e = events(spark, [("v1", "t1", "A", None, "2024-01-01T00:00:00", "takeout"), ("v2", "t1", "A", "u", "bad", "takeout"), ("v3", "t2", "", None, "2024-01-05", "chrome"), ("v4", "x", None, None, None, "chrome"), ("v1", "t3", "A", "w", None, "firefox")])
    assert [r.ingest_ord for r in history.in_order(e).orderBy("history_ord").collect()] == [4, 3, 0, 2, 1]


def test_done_shards_and_missing(spark):
    ids = spark.createDataFrame([(x, i) for i, x in enumerate("abcdefg")], "id string, ingest_ord long")
    assert [r.id for r in planning.shard(ids, 1, 3, 1).collect()] == ["b"]
    srt = spark.createDataFrame([("a.en.srt", 5), ("b.en.srt", 0), ("c.txt", 3)], "file string, size long")
    txt = spark.createDataFrame([("d.txt",), ("e.md",)], "file string")
    missed = spark.createDataFrame([("  f none",), ("",), (" ",)], "value string")
    done = planning.done_ids(txt, srt, missed)
    assert sorted(r.id for r in planning.todo(ids, done).collect()) == ["b", "c", "e", "g"]
    assert sorted(r.id for r in planning.not_fetched(ids, srt).collect()) == list("cdefg")


SRT = "1\r\n00:00:01,000 --> 00:00:02,000\r\n42\r\nhello <b>there</b>\r\n7\r\n\r\n2\n00:00:03.000 --> x\n<i></i>\nworld &amp; co\n \n3\n00:00:04,000 --> y\n99\n"


def test_cues(spark):
    df = spark.createDataFrame([(SRT,), ("",), (None,), ("\ufeff1\n00:00:01,000 --> 2\na",)], "content string")
    assert [r[0] for r in df.select(captions.cues("content")).collect()] == [[["hello there", "7"], ["world & co"]], [], None, [["\ufeff1", "a"]]]


@pytest.mark.parametrize(("lines", "kept"), [("A B B B B A C", "A B C"), ("A B C D A", "A B C D A"), ("A", "A"), ("", "")])
def test_rolling_dedupe(spark, lines, kept):
    df = spark.createDataFrame([(lines.split(),)], "l array<string>")
    assert df.select(captions.rolling_dedupe("l"), captions.rolling_dedupe_long("l")).first() == (kept.split(), kept.split())


def test_transcripts(spark):
    text = "\n\n".join(f"1\n00:00:01,000 --> 2\nSentence number {i}." for i in range(20))
    files = spark.createDataFrame([("v.en-GB.srt", 1, "x"), ("v.en-orig.srt", 1, "y"), ("v.en.srt", 1, text), ("w.en.srt", 1, "1\nshort"), ("z.en.srt", 1, text)], S.SRT_FILE)
    done = spark.createDataFrame([("z",)], "id string")
    out = {r.id: r for r in captions.transcripts(files, done).collect()}
    assert set(out) == {"v", "w"} and out["v"].status == "written" and out["w"].status == "too_short"
    assert out["v"].body.split("\n\n")[0] == " ".join(f"Sentence number {i}." for i in range(5)) and out["v"].words == 60


def test_furniture(spark):
    leaves = [[f"  Slow Rivers, chapter {1 + i // 20}  ", f"Leaf {i}: water finds the low ground,", f"and turns {i} times.", f" {i} "] for i in range(40)]
    pages = "\f".join("\n".join(x) for x in leaves)
    texts = [pages, pages + "\fThe sea at last.", "Preface.\nMCM\fThanks.\n\n7", "", None, "Twice.\fTwice.\fTwice.\fTwice."]
    out = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(documents.without_furniture("t")).collect()]
    body = [x for leaf in leaves for x in leaf[1:3]]
    assert out == ["\n".join(body), "\n".join([*body, "The sea at last."]), "Preface.\nThanks.\n", "", None, "Twice.\nTwice.\nTwice.\nTwice."]
    rows = spark.createDataFrame([("b", i, t) for i, t in enumerate(pages.split("\f"))] + [("e", 0, "12")], "doc string, page int, text string")
    assert {r.doc: r.text for r in documents.stripped_pages(rows).collect()} == {"b": "\n".join(body), "e": ""}


def test_records_of_files(spark, tmp_path):
    (tmp_path / "Book (Ann).txt").write_text("one two three")
    (tmp_path / "bad.pdf").write_bytes(b"x")
    (tmp_path / "odd.docx").write_bytes(b"y")

    def broken(content):
        raise RuntimeError("no tool")

    files = docs_source.read_documents(spark, str(tmp_path), {**docs_source.EXTRACTORS, ".pdf": broken})
    out = {r.file: r for r in documents.records(files, 2).collect()}
    assert out["Book (Ann).txt"].status == "ok" and out["Book (Ann).txt"].author == "Ann" and out["Book (Ann).txt"].transcript == "transcripts/book.txt"
    assert out["Book (Ann).txt"].sha256 == hashlib.sha256(b"one two three").hexdigest() and out["Book (Ann).txt"].words == 3
    assert out["bad.pdf"].status == "error: no tool" and out["odd.docx"].status == "error: unsupported extension .docx" and out["odd.docx"].words is None
    assert documents.ingest_report(documents.records(files, 2)).first() == (3, 1, 3, 2)
    digest = docs_source.text_files(spark, str(tmp_path / "bad.pdf")).first().content_sha
    assert digest == hashlib.sha256(b"x").hexdigest()


def test_clusters(spark):
    t = spark.createDataFrame([("a", 10), ("b", 5), ("c", 1)], "id string, words long")
    v = spark.createDataFrame([("a", "Old", 1, 0), ("a", "Foo bar", 3, 1), ("b", "foo", None, 2)], "id string, title string, view_count long, ingest_ord long")
    rows = cluster.with_titles(t, v)
    taxonomy = [("foo", "FOO"), ("bar", "bar$"), ("none", "q")]
    hits = cluster.labelled(rows, taxonomy)
    table = lists.domain_table(spark, taxonomy)
    assert {(r.domain, r.place, r.id, r.views) for r in cluster.members(hits).collect()} == {("foo", 1, "a", 3), ("foo", 2, "b", 0), ("bar", 1, "a", 3)}
    assert {(r.domain, r.videos, r.words) for r in cluster.summary(hits, table).collect()} == {("foo", 2, 15), ("bar", 1, 10), ("none", 0, 0)}
    assert [r.id for r in cluster.unlabelled(rows, hits).collect()] == ["c"]
    assert cluster.coverage(rows, hits).first().unlabelled == 1
    assert {r.domain: len(r.members) for r in cluster.nested(hits, table).collect()} == {"foo": 2, "bar": 1, "none": 0}


ENTRY = {"titleUrl": "https://y/watch?v=abcdefghijkL", "title": "Watched one", "subtitles": [{"name": "C", "url": "u"}], "time": "2024-01-01T00:00:00Z"}
CELL = '<div class="outer-cell x">Watched <a href="https://y/watch?v=abcdefghijk">T &amp; t</a><br><a href="https://y/channel/1">Ch</a><br>10 Aug 2026, 14:37:27 ACST'


def test_exports(spark, tmp_path):
    raw = json.dumps([ENTRY, {**ENTRY, "header": "YouTube Music"}, {"title": "no url"}, {**ENTRY, "subtitles": []}])
    (tmp_path / "j").mkdir()
    with zipfile.ZipFile(tmp_path / "j/takeout-1.zip", "w") as z:
        z.writestr("Takeout/x/watch-history.html", "no")
        z.writestr("Takeout/x/watch-history.json", raw)
    out = takeout.read_export(spark, str(tmp_path / "j")).orderBy("ingest_ord").collect()
    assert [(r.video_id, r.title, r.channel, r.watched_at) for r in out] == [("abcdefghijk", "one", "C", "2024-01-01T00:00:00Z"), ("abcdefghijk", "one", None, "2024-01-01T00:00:00Z")]
    (tmp_path / "h").mkdir()
    page = ("head" + CELL + '<div class="outer-cell">YouTube Music' + CELL[5:]).encode()
    with tarfile.open(tmp_path / "h/takeout-2.tgz", "w:gz") as t:
        info = tarfile.TarInfo("T/watch-history.html")
        info.size = len(page)
        t.addfile(info, io.BytesIO(page))
    out = takeout.read_export(spark, str(tmp_path / "h")).collect()
    assert [(r.video_id, r.title, r.channel, r.channel_url, r.watched_at) for r in out] == [("abcdefghijk", "T & t", "Ch", "https://y/channel/1", "2026-08-10T14:37:27")]
    home = tmp_path / "home/Downloads"
    home.mkdir(parents=True)
    (home / "takeout-9.zip").write_bytes(b"")
    assert takeout.find_export(str(tmp_path / "home")) == str(home / "takeout-9.zip")


def test_browser_files(spark, tmp_path):
    profile = tmp_path / ".config/google-chrome/Default"
    profile.mkdir(parents=True)
    con = sqlite3.connect(profile / "History")
    con.execute("CREATE TABLE urls (url, title, last_visit_time INTEGER)")
    con.executemany("INSERT INTO urls VALUES (?, ?, ?)", [("https://www.YouTube.com/watch?v=abcdefghijk", "One - YouTube", 13_348_540_800_000_000), ("https://www.youtube.com/watch?v=bbbbbbbbbbb", None, 0), ("https://other", "x", 1)])
    con.commit()
    con.close()
    (frame,) = browser.read_browsers(spark, str(tmp_path))
    assert [(r.video_id, r.title, r.watched_at, r.source) for r in frame.orderBy("ingest_ord").collect()] == [("abcdefghijk", "One", "2024-01-01 00:00:00", "chrome"), ("bbbbbbbbbbb", "", None, "chrome")]


def test_lists_and_sinks(spark, tmp_path):
    listing = spark.createDataFrame([('{"id": "a", "title": "T", "view_count": 3}', 0), ("garbage", 1), ('{"id": "a", "title": "later"}', 2), ('{"title": "no id", "channel": ""}', 3), ('{"id": "b", "uploader": "U"}', 4)], "value string, ingest_ord long")
    raw = lists.raw_videos(listing)
    assert [(r.id, r.title) for r in videos.reduce_videos(raw).orderBy("ingest_ord").collect()] == [("a", "T"), ("b", None)]
    assert videos.channel_name(raw).first().channel == "U"
    path = str(tmp_path / "videos")
    sinks.json_lines(videos.reduce_videos(raw).drop("ingest_ord"), path)
    sinks.replaced(lists.videos(lines := lists.lines(spark, path)).drop("ingest_ord").withColumn("view_count", F.lit(9)), path)
    assert {r.view_count for r in lists.videos(lists.lines(spark, path)).collect()} == {9} and lines is not None
    (tmp_path / "cache.json").write_text('{"v": {"channel": "C"}, "m": {"channel": null, "channel_url": null}}')
    assert {(r.video_id, r.channel) for r in lists.channel_cache(spark, str(tmp_path / "cache.json")).collect()} == {("v", "C"), ("m", None)}
    assert lists.channel_cache(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "domains.json").write_text('{"x": "a.*", "y": "b"}')
    assert lists.domains(spark, str(tmp_path / "domains.json")) == [("x", "a.*"), ("y", "b")]
    with pytest.raises(FileNotFoundError):
        lists.domains(spark, str(tmp_path / "no.json"))
    sinks.json_document(spark.createDataFrame([(2, "b"), (1, None)], "k int, v string"), str(tmp_path / "doc"), "k")
    assert [tuple(r) for r in lists.document_rows(spark, str(tmp_path / "doc"), "struct<k: int, v: string>").orderBy("k").collect()] == [(1, None), (2, "b")]
    assert sinks.report(spark.range(1).withColumn("x", F.lit(None).cast("int"))).splitlines()[1].split() == ["0", "-"]


def test_backfill_keeps_zero(spark):
    v = spark.createDataFrame([("a", "t", "u", None, None, 0), ("b", "t", "u", "", 1.0, None)], S.VIDEO)
    info = spark.createDataFrame([("a", "20240101", 5, 2.0), ("b", "20240102", 6, 3.0)], S.INFO)
    out = {r.id: r for r in videos.backfill(v, info).collect()}
    assert (out["a"].view_count, out["a"].upload_date, out["a"].filled) == (0, "20240101", True)
    assert (out["b"].view_count, out["b"].upload_date, out["b"].duration, out["b"].filled) == (6, "", 1.0, False)


def test_incremental_conversion_and_cache(spark, tmp_path):
    text = "\n\n".join(f"1\n00:00:01,000 --> 2\nSentence number {i}." for i in range(20))
    source, target, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    for name in ("a", "b"):
        spark.createDataFrame([(f"{name}.en.srt", 1, text)], S.SRT_FILE).write.mode("append").parquet(source)
        incremental.convert_captions(spark, source, target, mark)
    assert sorted(r.id for r in incremental.converted(spark, target).collect()) == ["a", "b"]
    cache = spark.createDataFrame([("k", "K", None, "named"), ("t", None, None, "timeout")], "video_id string, channel string, channel_url string, status string")
    asked = spark.createDataFrame([("t",), ("m",), ("k",)], "video_id string")
    answers = spark.createDataFrame([("t", "T", "http://t")], S.CHANNEL_CACHE)
    after = incremental.merged_cache(cache, asked, answers)
    assert {(r.video_id, r.channel, r.status) for r in after.collect()} == {("k", "K", "named"), ("t", "T", "named"), ("m", None, "miss")}
    assert sorted(r.video_id for r in incremental.settled(cache).collect()) == ["k"]


def test_broken_exports_stop_the_query(spark, tmp_path):
    for i, text in enumerate(['[{"titleUrl": "x"', "", "[1, 2", "no json"]):
        (tmp_path / f"e{i}").mkdir()
        (tmp_path / f"e{i}" / "watch-history.json").write_text(text)
        with pytest.raises(Exception):
            takeout.read_export(spark, str(tmp_path / f"e{i}")).collect()


def test_replacement_keeps_the_old_table_on_failure(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.json_lines(spark.range(3), path)
    real = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    class Failing:
        def __init__(self, at):
            self.at, self.seen = at, 0

        def __getattr__(self, name):
            return getattr(real, name)

        def rename(self, a, b):
            self.seen += 1
            return False if self.seen == self.at else real.rename(a, b)

    for at in (1, 2):
        monkeypatch.setattr(sinks, "_file_system", lambda spark, path, at=at: Failing(at))
        with pytest.raises(OSError):
            sinks.replaced(spark.range(5), path)
        assert spark.read.json(path).count() == 3
    monkeypatch.undo()
    sinks.replaced(spark.range(5), path)
    assert spark.read.json(path).count() == 5


def test_repeated_info_records_do_not_multiply_videos(spark):
    v = spark.createDataFrame([("a", "t", "u", None, None, None)], S.VIDEO)
    info = spark.createDataFrame([("a", "20240101", 5, 2.0, "1.json"), ("a", "20240202", 6, 3.0, "2.json"), ("", "20250101", 1, 1.0, "3.json")], "id string, upload_date string, view_count long, duration double, file string")
    assert [(r.upload_date, r.view_count) for r in videos.backfill(v, info).collect()] == [("20240202", 6)]
    assert videos.backfill(v, info.drop("file")).count() == 1


def test_repeated_runs_of_sinks_add_nothing(spark, tmp_path):
    ids = spark.createDataFrame([("a",), ("b",), ("a",)], "id string")
    for _ in range(2):
        sinks.append_lines(ids, str(tmp_path / "ids"))
    assert sorted(r.value for r in lists.lines(spark, str(tmp_path / "ids")).collect()) == ["a", "b"]
    rows = spark.createDataFrame([("a", "one"), ("b", "two")], S.TRANSCRIPT)
    sinks.transcripts(rows.limit(1), str(tmp_path / "t"), "c")
    sinks.transcripts(rows.withColumn("body", F.lit("new")), str(tmp_path / "t"), "c")
    got = {r.id: r.body for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert len(got) == 2 and sorted(got.values()) in (["new\n", "one\n"], ["new\n", "two\n"])
    for _ in range(2):
        sinks.append_records(rows, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).count() == 4


def test_one_hot_group_is_spread(spark, monkeypatch):
    """A day, a count or a domain that holds every row still takes many ranges, each a bounded part."""
    from tidemark.operators import ordering

    made, real = [], ordering.staged
    monkeypatch.setattr(ordering, "staged", lambda df, name: made.append(real(df, name)) or made[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(20_000).selectExpr("id", "'same' as g", "1 as count")
        for within in (None, ["g"]):
            out = ordering.with_ordinal(rows, [F.desc("count"), F.desc("id")], "place", within)
            assert out.filter("place = 19999 - id").count() == 20_000
            assert max(r["count"] for r in made[-1].groupBy("__range").count().collect()) < 10_000
        assert ordering.with_ordinal(rows.limit(0), [F.col("id")], "place").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_shared_folder_is_named_on_a_cluster(spark):
    from types import SimpleNamespace

    from tidemark import staging

    conf = SimpleNamespace(get=lambda *_: None)
    with pytest.raises(ValueError):
        staging.shared_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077")))
