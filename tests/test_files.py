"""Readers, writers and incremental runs on files that are large, odd or cut off, and on runs that are killed."""

import io
import json
import pickle
import random
import re
import sqlite3
import tarfile
from pathlib import Path

import oracle
import pytest
from pyspark.sql import functions as F
from tables import DATA

from tidemark import file_sink, sinks
from tidemark import schemas as S
from tidemark.functions import dates, patterns
from tidemark.operators import cluster, videos
from tidemark.plans import registry
from tidemark.sources import browser, documents, exports, lists, openers, takeout
from tidemark.streaming import incremental


def in_blocks(data, n):
    return (data[i : i + n] for i in range(0, len(data), n))


def test_ranges_give_the_elements_and_cells_of_the_whole():
    rng = random.Random(1)
    for _ in range(150):
        value = [{"a": rng.choice(["x", '"q', "\\", "{[", "]},{", 'é\\"', "\\\\"]) * rng.randint(0, 3), "b": [{"c": rng.choice([1, None, "]"])}] * rng.randint(0, 2)} for _ in range(rng.randint(0, 12))]
        raw = json.dumps(value, indent=rng.choice([None, 1]), ensure_ascii=False).encode()
        n = rng.randint(1, 40)
        cuts = [*range(0, len(raw), n), len(raw)]
        depth, inside, found = 0, False, []
        for a, b in zip(cuts, cuts[1:]):
            escaped = exports._escaped(io.BytesIO(raw), a)
            found += [json.loads(x) for _, x in exports.elements(in_blocks(raw[a:], rng.randint(1, 9)), a, b, depth, inside, inside and escaped)]
            quotes, outside_first, inside_first = exports.changes(in_blocks(raw[a:b], rng.randint(1, 9)), escaped)
            depth, inside = depth + (inside_first if inside else outside_first), inside != bool(quotes)
        assert (depth, inside) == (0, False) and found == value
        page = ("<html>" + "".join(rng.choice(['<div class="outer-cell a">', '<DIV claſs="outer-cell', "txt é", "<div"]) for _ in range(rng.randint(0, 9)))).encode()
        cuts = [*range(0, len(page), n), len(page)]
        found = [x.decode() for a, b in zip(cuts, cuts[1:]) for _, x in exports.cells(in_blocks(page[a:], rng.randint(1, 9)), a, b)]
        assert found == re.split('(?i)<div class="outer-cell', page.decode())[1:]


@pytest.mark.parametrize("raw", ["", "[1, 2", "no json", '[{"titleUrl": "x"', "{}", "[{}] x", "[{},]", "[,{}]", "[{} {}]", "[[1]]", '["a"]', "[{}", "[{}]]"])
def test_a_broken_array_is_refused(raw):
    with pytest.raises(exports.Broken):
        list(exports.elements(in_blocks(raw.encode(), 3)))


def entry(i):
    return {"titleUrl": f"https://y/watch?v={i:011d}", "title": f'Watched "{i}" }},{{ \\', "time": "2024-01-01T00:00:00Z"}


def test_a_large_export_takes_several_tasks_and_files_have_places_of_their_own(spark, tmp_path):
    for name, ids in (("b", range(1000, 3000)), ("a", range(1000))):
        (tmp_path / f"{name}.json").write_text(json.dumps([entry(i) for i in ids]))
    read = takeout.read_export(spark, str(tmp_path), 1 << 14)
    assert read.rdd.getNumPartitions() > 10
    rows = read.orderBy("ingest_ord").collect()
    assert [int(r.video_id) for r in rows] == list(range(3000)) and len({r.ingest_ord for r in rows}) == 3000
    assert rows[7].title == '"7" },{ \\'
    (tmp_path / "a.json").write_text(json.dumps([entry(i) for i in range(1000)])[:-200])
    with pytest.raises(exports.Broken):
        takeout.read_export(spark, str(tmp_path), 1 << 14)


def test_many_small_ranges_share_tasks_that_hold_their_own_ranges_alone(spark, tmp_path):
    for name, ids in (("b", range(1000, 3000)), ("a", range(1000))):
        (tmp_path / f"{name}.json").write_text(json.dumps([entry(i) for i in ids]))
    read = takeout.read_export(spark, str(tmp_path), 1 << 8)
    cores = spark.sparkContext.defaultParallelism
    assert sum(p.stat().st_size for p in tmp_path.iterdir()) >> 8 > 1000 and cores < read.rdd.getNumPartitions() <= exports.TASKS * cores
    rows = read.orderBy("ingest_ord").collect()
    assert [int(r.video_id) for r in rows] == list(range(3000)) and len({r.ingest_ord for r in rows}) == 3000
    sizes = []
    for n in (100, 10_000):
        reader = exports._Reader({"ranges": exports._packed(exports.Range("u", 0, n, i, i + 1) for i in range(n)), "lot_bytes": "10"})
        lots = reader.partitions()
        assert [r.start for lot in lots for r in lot.ranges] == list(range(n)) and max(len(lot.ranges) for lot in lots) == 10
        sizes.append(len(pickle.dumps(reader)))
    assert sizes[0] == sizes[1]


def test_an_archive_is_read_as_it_is_unpacked(spark, tmp_path):
    page = ("head" + "".join(f'<div class="outer-cell x">Watched <a href="https://y/watch?v={i:011d}">T</a><br>{"x" * 2000}' for i in range(3000))).encode()
    with tarfile.open(tmp_path / "takeout-2.tgz", "w:gz") as t:
        info = tarfile.TarInfo("T/watch-history.html")
        info.size = len(page)
        t.addfile(info, io.BytesIO(page))
    sizes = [len(b) for b in exports.member(str(tmp_path / "takeout-2.tgz"))[1]]
    assert max(sizes) <= exports.BLOCK and sum(sizes) == len(page)
    assert [int(r.video_id) for r in takeout.read_export(spark, str(tmp_path)).orderBy("ingest_ord").collect()] == list(range(3000))
    (tmp_path / "none.tgz").write_bytes(b"")
    with pytest.raises(exports.Broken):
        takeout.read_export(spark, str(tmp_path))


def database(path, n=2000, journal=None):
    con = sqlite3.connect(path)
    if journal:
        con.execute(f"PRAGMA journal_mode={journal}")
    con.execute("CREATE TABLE urls (url, title, last_visit_time INTEGER)")
    con.executemany("INSERT INTO urls VALUES (?, ?, ?)", [(f"https://www.youtube.com/watch?v={i:011d}", f"t{i % 10}", i) for i in range(n)])
    con.commit()
    return con


def test_database_filters_columns_and_ranges_reach_sqlite(spark, tmp_path):
    database(tmp_path / "a.db").close()
    rows = browser.visits(spark, str(tmp_path / "a.db"), browser.CHROME, part_bytes=4096)
    assert rows.rdd.getNumPartitions() > 5 and rows.count() == 2000
    wanted = rows.filter("visited >= 100 and visited < 300 and title = 't3' and url like '%youtube%' and title is not null")
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert " Filter " not in plan, plan
    assert sorted(r.visited for r in wanted.collect()) == [i for i in range(100, 300) if i % 10 == 3]
    assert rows.filter("url like 'https://www.youtube.com/watch?v=0000000000%'").count() == 10
    assert rows.filter("length(title) = 2 and visited in (1, 2)").count() == 2
    few = browser.visits(spark, str(tmp_path / "a.db"), browser.CHROME, "visited long")
    assert few.columns == ["visited"] and few.filter("visited > 1990").count() == 9
    assert [r.ingest_ord for r in rows.orderBy("visited").limit(3).collect()] == [1, 2, 3]


def test_a_database_that_a_browser_has_open_is_copied_with_its_journal(spark, tmp_path):
    con = database(tmp_path / "w.db", 50, "wal")
    assert (tmp_path / "w.db-wal").exists()
    assert browser.visits(spark, str(tmp_path / "w.db*"), browser.CHROME).count() == 50
    con.close()


def test_files_are_whole_or_not_there(spark, tmp_path):
    rows = spark.createDataFrame([("a", "one"), ("b", "two\r\né")], S.TRANSCRIPT)
    path = tmp_path / "t"
    sinks.transcript_files(rows, f"file://{path}")
    sinks.transcript_files(rows.withColumn("body", F.lit("new")).unionByName(spark.createDataFrame([("c", "three")], S.TRANSCRIPT)), f"file://{path}")
    assert {p.name: p.read_bytes() for p in path.iterdir()} == {"a.txt": b"one\n", "b.txt": "two\r\né\n".encode(), "c.txt": b"three\n"}
    many = spark.range(0, 40, 1, 4).select(F.concat("id", F.lit(".x")).alias("name"), F.when(F.col("id") == 39, F.raise_error(F.lit("stop"))).otherwise(F.repeat(F.lit("z"), 1000)).alias("content"))
    broken = tmp_path / "broken"
    with pytest.raises(Exception):
        file_sink.write_files(many, str(broken))
    left = list(broken.rglob("*")) if broken.exists() else []
    assert all(p.is_file() and p.stat().st_size == 1000 for p in left) and not {f"{i}.x" for i in range(30, 40)} & {p.name for p in left}
    for name in ("../x", "a/b", ".x", ""):
        with pytest.raises(Exception):
            file_sink.write_files(spark.createDataFrame([(name, "y")], "name string, content string"), str(tmp_path / "names"))


def captions(*tracks):
    return [(f, 1, "\n\n".join(f"1\n00:00:01,000 --> 2\n{word} number {i}." for i in range(n))) for f, word, n in tracks]


def test_small_files_are_written_beside_each_other_and_read_in_few_tasks(spark, tmp_path, monkeypatch):
    from tidemark.plans import files as plans
    from tidemark.sources import openers

    for i in range(2500):
        (tmp_path / f"{i}.info.json").write_text(json.dumps({"id": str(i)}))
    rows = lists.info_records(spark, f"file://{tmp_path}")
    assert 1 < rows.rdd.getNumPartitions() <= openers.TASKS * spark.sparkContext.defaultParallelism
    assert sorted(int(r.id) for r in rows.select("id").collect()) == list(range(2500))
    seen, real = [], lists.info_records
    monkeypatch.setattr(plans.lists, "info_records", lambda s, path: seen.append(path) or real(s, path))
    found = plans.info_files(spark, str(DATA / "sf0.001")).count()
    written = list(Path(seen[0].removeprefix("file://")).rglob("*"))
    assert len(written) == found + 1 and all(p.is_file() for p in written)


def test_captions_of_very_many_blank_and_index_lines_are_parsed_in_small_batches(spark):
    from tidemark.operators import captions as O

    texts = ["\n" * 20_000, "7\n" * 20_000 + "said", "1\n00:00:01,000 --> 2\n<i>a &amp; b</i>\n42\n&#10;\n \n7\nnext"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, content string").select("id", O.cues("content").alias("c")).orderBy("id").collect()
    assert [r.c for r in rows] == [[], [["said"]], [["a & b", "42"], ["next"]]]
    best = O.best_track(spark.createDataFrame([("v.en.srt", 1, "x" * 300)], S.SRT_FILE))
    made = O.transcripts(best, chosen=True)
    assert [(r.id, r.rank, r.file, r.status) for r in made.collect()] == [("v", 0, "v.en.srt", "written")]
    assert "Window" not in O.transcripts(spark.createDataFrame([("v", 0, "f", "x")], "id string, rank int, file string, content string"), chosen=True)._jdf.queryExecution().executedPlan().toString()
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1024


class Killed(Exception):
    pass


def test_a_killed_batch_is_taken_again_and_each_video_is_converted_once(spark, tmp_path, monkeypatch):
    lots = [captions(("v.en-orig.srt", "auto", 30), ("s.en.srt", "short", 1)), captions(("v.en.srt", "manual", 30), ("w.en.srt", "other", 30), ("s.en-orig.srt", "long", 40)), captions(("x.en.srt", "last", 30))]
    results = {}
    for later in (incremental.KEEP_FIRST, incremental.TAKE_BETTER):
        for kill in (None, "made", "tried") if later == incremental.KEEP_FIRST else ("tried",):
            source, target, mark = (str(tmp_path / f"{later}-{kill}-{x}") for x in ("in", "out", "mark"))
            for n, lot in enumerate(lots):
                spark.createDataFrame(lot, S.SRT_FILE).write.mode("append").parquet(source)
                if kill and n == 1:
                    real = incremental.freed if kill == "tried" else incremental.captions.transcripts

                    def stop(*_, **__):
                        raise Killed

                    with monkeypatch.context() as m:
                        m.setattr(incremental, "freed", stop) if kill == "tried" else m.setattr(incremental.captions, "transcripts", stop)
                        with pytest.raises(Exception):
                            incremental.convert_captions(spark, source, target, mark, later=later)
                    assert real
                incremental.convert_captions(spark, source, target, mark, later=later, fold_every=1 if kill == "made" else 2)
            rows = incremental.converted(spark, target).collect()
            assert len(rows) == len({r.id for r in rows})
            results[later, kill] = {r.id: r.body.split()[0] for r in rows}
    assert all(results["first", k] == {"v": "auto", "w": "other", "x": "last"} for k in (None, "made", "tried"))
    assert results["better", "tried"] == {"v": "manual", "w": "other", "x": "last"}


def test_a_killed_cache_batch_leaves_the_cache_of_one_run(spark, tmp_path, monkeypatch):
    lots = [[("a", "A", None, "answer", 0), ("b", None, None, "none", 0), ("c", None, None, "timeout", 0)], [("a", None, None, "none", 0), ("c", "C", "u", "answer", 0), ("c", "C2", "u2", "answer", 1)], [("b", None, None, "timeout", 0), ("d", None, None, "timeout", 0), (None, "x", None, "answer", 0)]]
    want = {("a", "A", None, "named"), ("b", None, None, "miss"), ("c", "C2", "u2", "named"), ("d", None, None, "timeout")}
    for kill in (False, True):
        source, target, mark = (str(tmp_path / f"{kill}-{x}") for x in ("in", "out", "mark"))
        for n, lot in enumerate(lots):
            spark.createDataFrame(lot, incremental.LOOKUP).write.mode("append").parquet(source)
            if kill and n == 1:
                with monkeypatch.context() as m:
                    m.setattr(incremental, "_kept", lambda *_: 1 / 0)  # after the batch, before it is folded in
                    with pytest.raises(Exception):
                        incremental.keep_cache(spark, source, target, mark, compact_every=2)
                assert not (tmp_path / "True-out/upto=1").exists()
            incremental.keep_cache(spark, source, target, mark, compact_every=2)
        assert (tmp_path / f"{kill}-out/upto=1/_SUCCESS").exists()
        assert {tuple(r) for r in incremental.kept_cache(spark, target).collect()} == want
    assert incremental.kept_cache(spark, str(tmp_path / "none")).count() == 0


def test_thousands_of_patterns_find_what_trying_all_finds(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeiksXYZéſK .") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    taxonomy = [(f"d{i}", rng.choice([r"\b{0}\b", "{0}|{1}", "({0})?{1}", "(?P<x>{0}).*(?P=x)", "[{1}]{0}+", "(?:{0}){{2,}}", "^.", "(?i:{0})(?!{1})", "(?x) {0}  {1}"]).format(*(re.escape(rng.choice(words)) or "a" for _ in range(2)))) for i in range(2000)]
    taxonomy = [(n, p) for n, p in taxonomy if _compiles(p)]
    titles = [" ".join(rng.choice(words).upper() if rng.random() < 0.3 else rng.choice(words) for _ in range(6)) for _ in range(120)] + ["", None, "İSTANBUL ıssık"]
    match = patterns.Matcher(taxonomy)
    want = {t: [n for n, p in taxonomy if re.search(p, t or "", re.IGNORECASE)] for t in titles}
    assert all(match(t or "") == want[t] for t in titles)
    assert sum(len(match.likely(t or "")) for t in titles) < len(titles) * len(taxonomy) / 2
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "id int, title string")
    hits = cluster.labelled_by_index(rows, taxonomy)
    assert "NestedLoop" not in hits._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in hits.collect():
        got.setdefault(r.title, set()).add(r.domain)
    assert got == {t: set(d) for t, d in want.items() if d}
    assert sorted(map(str, cluster.labelled_by_table(rows, lists.domain_table(spark, taxonomy)).collect())) == sorted(map(str, hits.collect()))
    table = lists.domain_table(spark, [("twice", "(?P<x>foo) (?P=x)")])
    assert [r.id for r in cluster.labelled_by_table(spark.createDataFrame([(1, "Foo foo"), (2, "foo")], "id int, title string"), table).collect()] == [1]


def _compiles(p):
    try:
        return bool(re.compile(p))
    except re.error:
        return False


def test_values_that_were_lost_or_stopped_the_query(spark, tmp_path):
    cells = spark.createDataFrame([("x ١ Feb 2025, 09:05:07",), ("1 Feb ２０25, 9:٠5:07 PM",), ("2 Feb 2025, 09:05:07",)], "cell string")
    assert [r[0] for r in cells.select(dates.locale_stamp("cell")).collect()] == ["2025-02-01T09:05:07", "２０25-02-01T21:05:07", "2025-02-02T09:05:07"]
    us = spark.createDataFrame([(13_348_540_799_999_999,), (13_348_540_800_000_000,), (-1,), (None,)], "t long")
    assert [r[0] for r in us.select(dates.from_epoch_1601("t")).collect()] == ["2023-12-31 23:59:59", "2024-01-01 00:00:00", "1600-12-31 23:59:59", None]
    raw = lists.raw_videos(spark.createDataFrame([('{"id": "a", "view_count": 3.0, "duration": "1.5"}', 0), ('{"id": "b", "view_count": "7"}', 1), ('{"id": "c", "view_count": "many"}', 2)], "value string, ingest_ord long"))
    assert [(r.view_count, r.duration) for r in raw.orderBy("ingest_ord").collect()] == [(3, 1.5), (7, None), (None, None)]
    assert videos.channel_record(raw, "slug", "u").first().channel is None
    (tmp_path / "w.txt").write_bytes(b"compre-\r\nhension\rend\r\n\r\n")
    assert documents.text_files(spark, str(tmp_path / "w.txt")).first().text == documents.plain(b"compre-\r\nhension\rend\r\n\r\n") == "compre-\nhension\nend\n\n"
    path = tmp_path / "h"
    path.mkdir()
    for number in (100000, 20000):
        (path / f"part-{number}-x.json").write_text("".join(json.dumps({"video_id": f"{number}-{i}", "ingest_ord": 0}) + "\n" for i in range(2)))
    assert [r.video_id for r in lists.history(spark, str(path)).orderBy("history_ord").collect()] == ["20000-0", "20000-1", "100000-0", "100000-1"]


def test_documents_in_parts_are_one_document_when_joined(spark, tmp_path):
    def read(name):
        sinks.joined(spark, f"file://{tmp_path}/{name}", f"file://{tmp_path}/{name}.json")
        return json.loads((tmp_path / f"{name}.json").read_text())

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(5000).selectExpr("5000 - id as k", "if(id % 3 = 0, null, concat('\"], {', char(10), id)) as v")
        sinks.json_document(rows, f"file://{tmp_path}/d", "k")
        parts = [p for p in (tmp_path / "d").glob("part-*") if p.stat().st_size]
        assert len(parts) > 2 and max(p.stat().st_size for p in parts) < sum(p.stat().st_size for p in parts) / 2
        assert read("d") == [r.asDict() for r in rows.orderBy("k").collect()]
        assert lists.document_rows(spark, f"file://{tmp_path}/d", "struct<k: long, v: string>").count() == 5000
        sinks.json_document(rows.limit(0), f"file://{tmp_path}/e", "k")
        assert read("e") == []
        heads = spark.createDataFrame([(0, "none"), (1, "all"), (2, "one")], "ord int, domain string")
        members = spark.range(3000).selectExpr("1 as ord", "id + 1 as place", "cast(id as string) as id").unionByName(spark.createDataFrame([(2, 1, "z")], "ord int, place long, id string"))
        sinks.json_groups(heads, members, f"file://{tmp_path}/g", "ord", "place", "members")
        assert read("g") == [{"ord": 0, "domain": "none", "members": []}, {"ord": 1, "domain": "all", "members": [{"id": str(i)} for i in range(3000)]}, {"ord": 2, "domain": "one", "members": [{"id": "z"}]}]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


EVENT = "video_id string, title string, channel string, channel_url string, watched_at string, source string, ingest_ord long"


def test_a_ranking_over_runs_is_that_of_all_events(spark, tmp_path):
    from tidemark.operators import history, rank
    from tidemark.streaming import rankings

    rng = random.Random(11)
    rows = [(f"v{rng.randint(0, 40)}", f"t{rng.randint(0, 60)}", rng.choice(["A", "B", "", None]), rng.choice(["u1", "u2", "", None]), rng.choice([f"2024-01-{rng.randint(1, 28):02d}T00:00:00", None, "odd"]), "s", i) for i in range(900)]
    lots = [spark.createDataFrame(rows[i::3], EVENT) for i in range(3)]
    cache = spark.createDataFrame([(f"v{i}", rng.choice(["A", "C", None]), rng.choice(["u9", None])) for i in range(20)], S.CHANNEL_CACHE)
    path = f"file://{tmp_path}/r"
    for number in (0, 1, 1, 2):
        rankings.add_run(spark, path, number, lots[number], titles=5)
    (tmp_path / "r/titles/run=7").mkdir()  # a run that was killed
    union = history.union_sources(*lots)
    for known in (None, cache):
        want = rank.creators(union, known, min_videos=1, titles=5, rank=True).drop("first_ord")
        got = rankings.creators(spark, path, known, min_videos=1, titles=5, rank=True).drop("first_ord")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert rankings.history_stats(spark, path).first() == history.history_stats(union).first()


def test_late_views_change_no_session_and_are_counted(spark, tmp_path):
    from tidemark.streaming import sessions

    schema = "viewer string, at timestamp, video_id string"
    lots = [[("a", "2024-01-01 00:00:00", "1"), ("a", "2024-01-01 00:20:00", "2")], [("a", "2024-01-01 09:00:00", "3"), ("b", "2024-01-01 09:10:00", "4")], [("a", "2024-01-01 00:25:00", "late"), ("b", "2024-01-01 00:00:00", "late"), (None, "2024-01-01 20:00:00", "5")]]
    late = []
    for lot in lots:
        spark.createDataFrame(lot, "viewer string, at string, video_id string").withColumn("at", F.col("at").cast("timestamp")).write.mode("append").parquet(str(tmp_path / "in"))
        stream = incremental.new_files(spark, str(tmp_path / "in"), schema)
        late.append(sessions.run(sessions.sessions(stream), str(tmp_path / "out"), str(tmp_path / "mark")))
    found = sorted((r.viewer, str(r.start)[11:16], str(r.end)[11:16], r.views, r.first_video, r.last_video) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert found == [("a", "00:00", "00:20", 2, "1", "2"), ("a", "09:00", "09:00", 1, "3", "3"), ("b", "09:10", "09:10", 1, "4", "4")]
    assert late[:2] == [0, 0] and late[2] == 2


ODD_TEXTS = ("Two words.\nVi", "12", "One.\niv\nTwo.", "re-\njoined", "Head\na b\f" * 6, "a\u00a0b\x0bc\x85d", "\u00ad x", "a\r\nb\rc", "+/ \U0001f600", "", " \n", None)


@pytest.mark.parametrize(("name", "ids"), [("document_kinds", (-9, -8, -7, None)), ("document_files", ()), ("plain_files", ())])
def test_words_and_records_of_odd_documents_are_those_of_sql(spark, tmp_path, monkeypatch, name, ids):
    """Lines that look like page numbers, page heads, hyphens at line ends, empty files, and what is no file."""
    rows = [(100 * (4 * n + k) + k, x) for n, x in enumerate(ODD_TEXTS) for k in range(4) if x is not None or name == "document_kinds"] + [(i, "A b c d.") for i in ids]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    sql = registry.ORACLES[name].replace(" FROM documents", f" FROM '{tmp_path}/documents.parquet/*.parquet'")
    monkeypatch.setattr(oracle, "TABLES", [])
    oracle.check(spark, registry.QUERIES[name], sql, str(tmp_path))


def test_files_without_a_byte_are_read(spark, tmp_path):
    names = {"a b+c%20\u00e9.txt": b"", "e.pdf": b"", "q.txt": b"x", "_h.txt": b""}
    for n, x in names.items():
        (tmp_path / n).write_bytes(x)
    for path in (str(tmp_path), f"file://{tmp_path}/*"):
        assert sorted((r.path, bytes(r.content)) for r in openers.whole_files(spark, path).collect()) == sorted((f"file:{tmp_path}/{n}", x) for n, x in names.items() if n[0] != "_")
    assert documents.text_files(spark, str(tmp_path / "a b*")).first().text == ""
