"""Documents to corpus text: page furniture, cleaning, gates, records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

MIN_WORDS = 5000
EDGE, SHORT = 3, 80

# Extensions and the extractors named in records.
EXTRACTORS = {".pdf": "pdftotext", ".epub": "pandoc", ".txt": "copy"}


def edge_lines(page) -> Column:
    """The distinct first and last lines (three each) of a page, white space aside, that are short."""
    bare = F.filter(F.transform(X.split_lines(page), X.strip), lambda x: x != "")

    def ends(lines: Column) -> Column:
        both = F.array_union(F.slice(lines, 1, EDGE), F.slice(lines, F.greatest(F.size(lines) - EDGE + 1, F.lit(1)), EDGE))
        return F.filter(both, lambda x: F.length(x) < SHORT)

    return X.let(bare, ends)


def threshold(pages: Column) -> Column:
    """Pages on which a line must stand at an edge to be furniture."""
    return F.greatest(F.lit(5), F.floor(pages / 20)).cast("int")


def without_furniture(text) -> Column:
    """A text of pages (form feeds between them) without running heads, feet and page numbers.

    The counts come from sorting the edge lines of the row, so a document needs no shuffle.
    """

    def frequent(edges: Column, need: Column) -> Column:
        places = F.when(F.size(edges) >= need, F.sequence(need, F.size(edges))).otherwise(F.array().cast("array<int>"))
        again = F.filter(places, lambda i: F.element_at(edges, i) == F.element_at(edges, i - need + 1))
        return F.array_distinct(F.transform(again, lambda i: F.element_at(edges, i)))

    def kept(pages: Column, furniture: Column) -> Column:
        lines = F.flatten(F.transform(pages, X.split_lines))
        return F.array_join(F.filter(lines, lambda x: X.let(X.strip(x), lambda bare: ~F.array_contains(furniture, bare) & ~X.is_page_number(bare))), "\n")

    def of(pages: Column) -> Column:
        edges = F.array_sort(F.flatten(F.transform(pages, edge_lines)))
        furniture = X.let(edges, lambda e: X.let(threshold(F.size(pages)), lambda need: frequent(e, need)))
        return X.let(furniture, lambda f: kept(pages, f))

    return X.let(X.split_pages(text), of)


def furniture_lines(pages: DataFrame, doc: str = "doc", page: str = "page", text: str = "text") -> DataFrame:
    """The furniture of documents whose pages are rows: doc, line, pages it stands on."""
    seen = pages.select(doc, F.explode(edge_lines(text)).alias("line")).groupBy(doc, "line").agg(F.count("*").alias("n"))
    sizes = pages.groupBy(doc).agg(threshold(F.count("*")).alias("need"))
    return seen.join(sizes, doc).filter("n >= need").select(doc, "line", "n")


def stripped_pages(pages: DataFrame, doc: str = "doc", page: str = "page", text: str = "text") -> DataFrame:
    """The same documents, a row each, without furniture and page numbers; those of which nothing stays have empty text."""
    lines = pages.select(doc, page, F.posexplode(X.split_lines(text)).alias("at", "line")).withColumn("bare", X.strip("line"))
    gone = furniture_lines(pages, doc, page, text).select(doc, F.col("line").alias("bare"))
    kept = lines.filter(~X.is_page_number("bare")).join(gone, [doc, "bare"], "left_anti")
    text_of = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(page, "at", "line"))), lambda x: x["line"]), "\n")
    return pages.select(doc).distinct().join(kept.groupBy(doc).agg(text_of.alias("text")), doc, "left").withColumn("text", F.coalesce("text", F.lit("")))


def extractor(path) -> Column:
    kind = X.suffix(path)
    out = None
    for ext, name in EXTRACTORS.items():
        out = F.when(kind == ext, name) if out is None else out.when(kind == ext, name)
    return out


def records(files: DataFrame, min_words: int = MIN_WORDS, *more: Column) -> DataFrame:
    """Document records and their text.

    files: path, content_sha (hex), text (extracted; null on failure), error (null, or what went wrong). A file of
    unknown kind has title, author and checksum and an error; one that could not be read has only the error.
    more: further columns, of what files has.
    """
    leaf = F.substring_index("path", "/", -1)
    stem = F.regexp_replace(leaf, r"(?s)^(.+)\.[^.]*$", "$1")
    unread = F.col("content_sha").isNull()
    how = extractor("path")
    body = X.clean_text(F.when(how == "pdftotext", without_furniture("text")).otherwise(F.col("text")))
    rows = files.withColumns({"file": leaf, "stem": stem, "how": how, "body": body, "unread": unread}).withColumn("count", X.word_count("body"))
    failed = F.when(F.col("unread"), F.col("error")).when(F.col("how").isNull(), F.concat(F.lit("unsupported extension "), X.suffix("path"))).when(F.col("text").isNull(), F.coalesce("error", F.lit("no text")))
    status = F.when(failed.isNotNull(), F.concat(F.lit("error: "), failed)).when(F.col("count") < min_words, "too_short").otherwise("ok")
    rows = rows.withColumn("status", status)
    title = F.when(~F.col("unread"), X.title_of("stem"))
    failed_now = F.col("status").startswith("error")
    rows = rows.withColumn("title", title)
    return rows.select(
        F.col("path").alias("source"),
        "file",
        "title",
        F.when(~F.col("unread"), X.author_of("stem")).alias("author"),
        F.col("content_sha").alias("sha256"),
        F.when(~failed_now, F.col("how")).alias("extractor"),
        F.when(~failed_now, F.col("count")).alias("words"),
        "status",
        F.when(F.col("status") == "ok", F.concat(F.lit("transcripts/"), X.doc_slug("title"), F.lit(".txt"))).alias("transcript"),
        F.when(F.col("status") == "ok", F.col("body")).alias("body"),
        *more,
    )


def ingest_report(records: DataFrame) -> DataFrame:
    """ok of all records, words of those that are ok, and the rest."""
    ok = F.col("status") == "ok"
    return records.agg(F.count("*").alias("records"), F.count_if(ok).alias("ok"), F.coalesce(F.sum(F.when(ok, F.col("words"))), F.lit(0)).alias("words"), F.count_if(~ok).alias("failed"))


def slug_collisions(records: DataFrame) -> DataFrame:
    """Transcript names that different files share, of which only one would stay on disk."""
    made = records.filter("transcript is not null")
    return made.groupBy("transcript").agg(F.count_distinct("sha256").alias("files"), F.count("*").alias("records")).filter("files > 1")
