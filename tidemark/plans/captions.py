"""Queries on captions: parsing, dedupe, paragraphs, tracks, conversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import captions as O
from . import fixtures as T

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _srt(spark, d):
    """A caption file of each conversation: a cue of two lines for each turn, with tags and index lines."""
    c = T.table(spark, d, "conversations")
    said = F.regexp_replace("text", r"[\s&<>]+", " ")
    cue = F.concat(F.col("turn").cast("string"), F.lit("\n00:00:0"), (F.col("turn") % 10).cast("string"), F.lit(",000 --> 00:00:59,000 x\n42\n<i>"), F.trim(said), F.lit("</i>\n7\n<b></b>\n \n"))
    return c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", cue.alias("cue")))), lambda x: x["cue"]), "").alias("content"))


_SAID = r"trim(regexp_replace(text, '[\s&<>]+', ' ', 'g'))"


@query(
    rf"""
SELECT conv_id, dense_rank() OVER (PARTITION BY conv_id ORDER BY turn) AS cue, n::BIGINT AS line, CASE n WHEN 1 THEN s ELSE '7' END AS said
FROM (SELECT conv_id, turn, {_SAID} AS s FROM conversations), (VALUES (1), (2)) v(n) WHERE s <> '' AND NOT regexp_full_match(s, '\d+')
"""
)
def srt_parse(spark, d):
    rows = _srt(spark, d).select("conv_id", F.posexplode(O.cues("content")).alias("cue", "lines"))
    return rows.select("conv_id", (F.col("cue") + 1).cast("long").alias("cue"), F.posexplode("lines").alias("line", "said")).withColumn("line", (F.col("line") + 1).cast("long"))


def _rolling(spark, d):
    c = T.table(spark, d, "conversations")
    line = F.when(F.col("turn") % 3 == 2, "again").otherwise(F.col("text"))
    lines = c.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("x")))), lambda x: x["x"]).alias("l"))
    # every line comes back one and two cues later, as rolling captions do
    return lines.select("conv_id", F.flatten(F.transform("l", lambda x, i: F.concat(F.slice("l", F.greatest(i - 1, F.lit(1)), F.lit(2)), F.array(x)))).alias("l"))


_ROLLING = """
WITH l AS (SELECT conv_id, list(CASE WHEN turn % 3 = 2 THEN 'again' ELSE text END ORDER BY turn) AS l FROM conversations GROUP BY conv_id),
r AS (SELECT conv_id, flatten(list_transform(range(0, len(l)), lambda i: list_concat(l[greatest(i - 1, 1) : greatest(i - 1, 1) + 1], [l[i + 1]]))) AS l FROM l)
SELECT conv_id, array_to_string(list_reduce(l, lambda a, x: CASE WHEN list_contains(a[greatest(len(a) - 2, 1) : len(a)], x[1]) THEN a ELSE list_concat(a, x) END), '|') AS said
FROM (SELECT conv_id, list_concat([[]::VARCHAR[]], list_transform(l, lambda x: [x])) AS l FROM r)
"""


@query(_ROLLING)
def rolling_dedupe(spark, d):
    return _rolling(spark, d).select("conv_id", F.array_join(O.rolling_dedupe("l"), "|").alias("said"))


@query(_ROLLING)
def rolling_dedupe_long(spark, d):
    return _rolling(spark, d).select("conv_id", F.array_join(O.rolling_dedupe_long("l"), "|").alias("said"))


_REFLOW = r"""(SELECT id, array_to_string(list_transform(range(0, (len(s) + 4) // 5), lambda i: array_to_string(s[i * 5 + 1 : i * 5 + 5], ' ')), chr(10) || chr(10)) AS body
FROM (SELECT id, string_split(regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '([.!?]) ', '\1' || chr(1), 'g'), chr(1)) AS s FROM {0}))"""
_DOCS = "(SELECT doc_id::VARCHAR AS id, text FROM documents)"


@query(f"SELECT id, body FROM {_REFLOW.format(_DOCS)}")
def reflow(spark, d):
    return T.documents(spark, d).select("id", O.reflow("text").alias("body"))


@query("SELECT conv_id::VARCHAR AS id, file FROM (SELECT conv_id, file, row_number() OVER (PARTITION BY conv_id ORDER BY CASE WHEN file = conv_id::VARCHAR || '.en.srt' THEN 0 WHEN file = conv_id::VARCHAR || '.en-orig.srt' THEN 1 ELSE 2 END, file) AS r FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR || CASE role WHEN 'system' THEN '.en.srt' WHEN 'assistant' THEN '.en-orig.srt' ELSE '.en-GB.srt' END AS file FROM conversations)) WHERE r = 1")
def pick_best_track(spark, d):
    c = T.table(spark, d, "conversations")
    name = F.when(F.col("role") == "system", ".en.srt").when(F.col("role") == "assistant", ".en-orig.srt").otherwise(".en-GB.srt")
    return O.best_track(c.select(F.concat(F.col("conv_id").cast("string"), name).alias("file")).distinct()).select("id", "file")


def _converted(spark, d):
    docs = T.documents(spark, d)
    lines = F.array_join(F.transform(X.sentences(F.regexp_replace("text", r"[\s&<>]+", " ")), lambda s: F.concat(F.lit("1\n00:00:01,000 --> 00:00:02,000\n"), F.lit("- "), s)), "\n\n")
    files = docs.select(F.concat("id", F.lit(".en.srt")).alias("file"), lines.alias("content"))
    done = docs.filter("ingest_ord % 10 = 0").select("id")
    return O.transcripts(files, done), done


_CONVERTED = rf"""(SELECT id, body, len(regexp_extract_all(body, '\S+'))::BIGINT AS words, CASE WHEN length(body) >= 200 THEN 'written' ELSE 'too_short' END AS status FROM {_REFLOW.format("(SELECT id, array_to_string(list_reduce(l, lambda a, x: CASE WHEN list_contains(a[greatest(len(a) - 2, 1) : len(a)], x[1]) THEN a ELSE list_concat(a, x) END), ' ') AS text FROM (SELECT id, list_concat([[]::VARCHAR[]], list_transform(string_split(regexp_replace(t, '([.!?]) ', chr(92) || '1' || chr(1), 'g'), chr(1)), lambda x: [trim('- ' || x)])) AS l FROM (SELECT doc_id::VARCHAR AS id, regexp_replace(text, '[ \t\n\r&<>]+', ' ', 'g') AS t FROM documents WHERE doc_id % 10 <> 0)))")})"""


@query(f"SELECT id, sha256(body) AS body_sha, words, status FROM {_CONVERTED}")
def transcripts(spark, d):
    return _converted(spark, d)[0].select("id", F.sha2("body", 256).alias("body_sha"), "words", "status")


@query(f"SELECT count(*) FILTER (WHERE status = 'written') AS written, count(*) FILTER (WHERE status <> 'written') AS too_short, sum(words) FILTER (WHERE status = 'written')::BIGINT AS words, (SELECT count(*) FROM documents WHERE doc_id % 10 = 0) AS already, count(*) + (SELECT count(*) FROM documents WHERE doc_id % 10 = 0) AS groups FROM {_CONVERTED}")
def conversion_report(spark, d):
    return O.conversion_report(*_converted(spark, d))
