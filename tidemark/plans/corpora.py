"""Queries on documents: names, checksums, cleaning, furniture, gates, records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import documents as O
from . import fixtures as T

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_SLUG = "coalesce(nullif(substr(lower(trim(regexp_replace({0}, '[^A-Za-z0-9]+', '-', 'g'), '-')), 1, 80), ''), 'doc')"


@query(f"SELECT c_custkey, {_SLUG.format('c_name || chr(32) || c_mktsegment')} AS slug, {_SLUG.format('repeat(c_name, 9)')} AS long_slug, 'doc' AS empty_slug FROM customer")
def doc_slug_ascii(spark, d):
    c = T.table(spark, d, "customer")
    return c.select("c_custkey", X.doc_slug(F.concat("c_name", F.lit(" "), "c_mktsegment")).alias("slug"), X.doc_slug(F.repeat("c_name", F.lit(9))).alias("long_slug"), X.doc_slug(F.lit("!!!")).alias("empty_slug"))


@query()
def doc_slug_unicode(spark, d):
    return T.documents(spark, d).select("id", X.doc_slug("text").alias("slug"))


@query("SELECT page_id, regexp_replace(replace(replace(replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&copy;', chr(169)), '&middot;', chr(183)), '&amp;?', '&', 'g') AS page FROM pages")
def html_unescape(spark, d):
    return T.table(spark, d, "pages").select("page_id", X.unescape_html("html").alias("page"))


@query("SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS bare FROM pages")
def tag_strip(spark, d):
    return T.table(spark, d, "pages").select("page_id", X.strip_tags("html").alias("bare"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name ELSE p_name || ' (Series)' END AS title, CASE WHEN p_size % 3 <> 0 THEN p_brand END AS author FROM part")
def title_author(spark, d):
    stem = F.when(F.col("p_size") % 3 == 0, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" (Series) - ("), "p_brand", F.lit(") tail")))
    return T.table(spark, d, "part").select("p_partkey", X.title_of(stem).alias("title"), X.author_of(stem).alias("author"))


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def sha256_docs(spark, d):
    return T.table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


_CLEAN = r"regexp_replace(regexp_replace(regexp_replace(replace(t, chr(173), ''), '([\p{L}\p{N}_])-\n([\p{L}\p{N}_])', '\1\2', 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')"


@query(rf"SELECT doc_id, regexp_replace({_CLEAN}, '^[\s]+|[\s]+$', '', 'g') || chr(10) AS body FROM (SELECT doc_id, '  re' || chr(173) || 'ading compre-' || chr(10) || 'hension' || chr(9) || ' a-' || chr(10) || 'b-' || chr(10) || 'c' || chr(10) || chr(10) || chr(10) || chr(10) || text || ' ' || chr(10) AS t FROM documents)")
def clean_text(spark, d):
    t = F.concat(F.lit("  re\u00adading compre-\nhension\t a-\nb-\nc\n\n\n\n"), "text", F.lit(" \n"))
    return T.table(spark, d, "documents").select("doc_id", X.clean_text(t).alias("body"))


@query(r"SELECT doc_id, len(regexp_extract_all(text, '[^\s]+'))::BIGINT AS words FROM documents")
def word_counts(spark, d):
    return T.table(spark, d, "documents").select("doc_id", X.word_count("text").alias("words"))


@query(r"SELECT doc_id, CASE WHEN len(regexp_extract_all(text, '[^\s]+')) < 500 THEN 'too_short' ELSE 'ok' END AS status FROM documents")
def too_short_gate(spark, d):
    rows = T.table(spark, d, "documents").withColumn("words", X.word_count("text"))
    return rows.select("doc_id", F.when(F.col("words") < 500, "too_short").otherwise("ok").alias("status"))


def _pages(spark, d):
    docs = T.table(spark, d, "documents")
    number = F.col("doc_id") % 2000
    page = F.concat(F.lit("HEAD OF "), F.upper("source"), F.lit("\n"), F.col("text"), F.lit("\n"), F.when(F.col("doc_id") % 7 == 0, "xiv").otherwise(number.cast("string")))
    return docs.select(F.col("source").alias("doc"), F.col("doc_id").alias("page"), page.alias("text"))


_BY_SOURCE = "(SELECT source AS doc, doc_id AS page, 'HEAD OF ' || upper(source) || chr(10) || text || chr(10) || CASE WHEN doc_id % 7 = 0 THEN 'xiv' ELSE (doc_id % 2000)::VARCHAR END AS text FROM documents)"
_FURNITURE = r"""
l AS (SELECT doc, page, unnest(x) AS line, generate_subscripts(x, 1) AS pos, len(x) AS last FROM (SELECT doc, page, string_split(text, chr(10)) AS x FROM {pages})),
b AS (SELECT *, trim(line, ' ' || chr(9)) AS bare FROM l WHERE trim(line, ' ' || chr(9)) <> ''),
r AS (SELECT *, row_number() OVER (PARTITION BY doc, page ORDER BY pos) AS f, row_number() OVER (PARTITION BY doc, page ORDER BY pos DESC) AS z FROM b),
c AS (SELECT doc, bare, count(DISTINCT page) AS n FROM r WHERE (f <= 3 OR z <= 3) AND length(bare) < 80 GROUP BY 1, 2),
k AS (SELECT doc, greatest(5, count(*) // 20) AS need FROM {pages} GROUP BY doc),
g AS (SELECT c.doc, bare, n FROM c JOIN k ON c.doc = k.doc WHERE n >= need)"""
_STRIPPED = """WITH """ + _FURNITURE.strip() + """,
s AS (SELECT l.doc, string_agg(line, chr(10) ORDER BY page, pos) AS text FROM l LEFT JOIN g ON g.doc = l.doc AND g.bare = trim(line, ' ' || chr(9))
  WHERE g.bare IS NULL AND NOT regexp_full_match(trim(line, ' ' || chr(9)), '(?i)([ivxlcdm]+|[0-9]{{1,4}})') AND NOT (line = '' AND pos = last) GROUP BY l.doc)
SELECT k.doc, sha256(coalesce(s.text, '')) AS text_sha, length(coalesce(s.text, '')) AS n_chars FROM k LEFT JOIN s ON s.doc = k.doc"""


@query(f"WITH {_FURNITURE.strip().format(pages=_BY_SOURCE)} SELECT doc, bare AS line, n FROM g")
def furniture_lines(spark, d):
    return O.furniture_lines(_pages(spark, d))


@query(_STRIPPED.format(pages=_BY_SOURCE))
def page_furniture(spark, d):
    out = O.stripped_pages(_pages(spark, d))
    return out.select("doc", F.sha2("text", 256).alias("text_sha"), F.length("text").cast("long").alias("n_chars"))


_IN_ROW = "(SELECT doc_id AS doc, p AS page, 'Folio of ' || doc_id::VARCHAR || chr(10) || array_to_string(x[p * 4 + 1 : p * 4 + 4], chr(10)) || chr(10) || (p + 1)::VARCHAR AS text FROM (SELECT doc_id, x, unnest(range(0, (len(x) + 3) // 4)) AS p FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents)))"


@query(_STRIPPED.format(pages=_IN_ROW))
def page_furniture_in_row(spark, d):
    """Every document as a book of pages of four lines each, with a head and a page number."""
    lines = F.split("text", "\n")
    head = F.concat(F.lit("Folio of "), F.col("doc_id").cast("string"), F.lit("\n"))

    def pages(x):
        firsts = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / 4).cast("int"))
        return F.transform(firsts, lambda p: F.concat(head, F.array_join(F.slice(x, p * 4 + 1, 4), "\n"), F.lit("\n"), (p + 1).cast("string")))

    rows = T.table(spark, d, "documents").withColumn("t", F.array_join(X.let(lines, pages), "\f"))
    out = rows.select(F.col("doc_id").alias("doc"), O.without_furniture("t").alias("text"))
    return out.select("doc", F.sha2("text", 256).alias("text_sha"), F.length("text").cast("long").alias("n_chars"))


def _files(spark, d):
    docs = T.table(spark, d, "documents")
    k = F.col("doc_id") % 5
    ext = F.when(k == 0, ".PDF").when(k == 1, ".epub").when(k == 2, ".txt").when(k == 3, ".docx").otherwise(".txt")
    stem = F.concat(F.lit("Book "), F.col("doc_id").cast("string"), F.lit(" (Ann Author)"))
    return docs.select(
        F.concat(F.lit("/in/"), stem, ext).alias("path"),
        F.when(k != 4, F.sha2("text", 256)).alias("content_sha"),
        F.when(k < 3, F.col("text")).alias("text"),
        F.when(k == 4, "unreadable").alias("error"),
    )


_STATUS = r"""SELECT '/in/Book ' || doc_id::VARCHAR || ' (Ann Author)' || e AS source, CASE WHEN k <> 4 THEN 'Book ' || doc_id::VARCHAR END AS title, CASE WHEN k <> 4 THEN 'Ann Author' END AS author,
  CASE WHEN k <> 4 THEN sha256(text) END AS sha256, CASE k WHEN 0 THEN 'pdftotext' WHEN 1 THEN 'pandoc' WHEN 2 THEN 'copy' END AS extractor, CASE WHEN k < 3 THEN w END AS words,
  CASE WHEN k = 4 THEN 'error: unreadable' WHEN k = 3 THEN 'error: unsupported extension .docx' WHEN w < 300 THEN 'too_short' ELSE 'ok' END AS status,
  CASE WHEN k < 3 AND w >= 300 THEN 'transcripts/book-' || doc_id::VARCHAR || '.txt' END AS transcript
FROM (SELECT *, doc_id % 5 AS k, CASE doc_id % 5 WHEN 0 THEN '.PDF' WHEN 1 THEN '.epub' WHEN 3 THEN '.docx' ELSE '.txt' END AS e, len(regexp_extract_all(text, '[^\s]+'))::BIGINT AS w FROM documents)"""


@query(_STATUS)
def ingest_status(spark, d):
    return O.records(_files(spark, d), 300).drop("body", "file")


@query(f"SELECT count(*) AS records, count(*) FILTER (WHERE status = 'ok') AS ok, coalesce(sum(words) FILTER (WHERE status = 'ok'), 0)::BIGINT AS words, count(*) FILTER (WHERE status <> 'ok') AS failed FROM ({_STATUS})")
def ingest_report(spark, d):
    return O.ingest_report(O.records(_files(spark, d), 300))


@query("SELECT 'transcripts/' || coalesce(nullif(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'doc') || '.txt' AS transcript, count(DISTINCT p_partkey) AS files, count(*) AS records FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) > 1")
def slug_collisions(spark, d):
    p = T.table(spark, d, "part")
    return O.slug_collisions(p.select(F.concat(F.lit("transcripts/"), X.doc_slug("p_name"), F.lit(".txt")).alias("transcript"), F.col("p_partkey").cast("string").alias("sha256")))


@query("SELECT page_id, string_split(n, '.')[1] AS file_stem, substr(n, 1, greatest(length(n) - 4, 0)) AS no_suffix, '.srt' AS ext FROM (SELECT page_id, string_split(url, '/')[-1] || '.en.SRT' AS n FROM pages)")
def file_names(spark, d):
    name = F.concat(F.substring_index("url", "/", -1), F.lit(".en.SRT"))
    return T.table(spark, d, "pages").select("page_id", X.file_stem(name).alias("file_stem"), X.without_suffix(name).alias("no_suffix"), X.suffix(name).alias("ext"))
