"""Captions to prose: cue parsing, rolling dedupe, paragraphs, track choice.

A file is one row throughout, so nothing here shuffles but the choice among a video's tracks.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions.text import SPACE
from ..session import importable, small_batches

#: Texts whose lines are Python strings together.
AT_ONCE = 32
#: White space inside a line; most characters fail the first ranges.
_BLANK = rf"[\x00-\x20\x7f-\x{{10FFFF}}&&{SPACE.replace(r'\t-\r', r'\t\x0b\x0c')}]"
#: Lines already emitted that a new one is held against.
WINDOW = 3


def cues(content, unescape: bool = True) -> Column:
    """The cues of caption text, each a list of lines.

    Timing lines go first and do not end a cue; blank lines do. In a cue, lines of digits are index lines until
    text has been accepted. Tags go, entities are replaced (in Python, and only where there are any), white space
    collapses, and lines without text are no lines.
    """
    # whole-text patterns that begin with a plain character: an expression for each line costs several times as much
    def changed(text: Column, *pairs: tuple[str, str]) -> Column:
        for pattern, by in pairs:
            text = F.regexp_replace(text, pattern, by)
        return text

    stop = r"(?![^\n\r])"
    lines = F.replace(F.replace(F.concat(F.lit("\n"), X._col(content)), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    timed = changed(lines, (rf"\n\d{{2}}:\d{{2}}:\d{{2}}[,.]\d{{3}}{_BLANK}*-->[^\n]*", ""))
    marked = changed(
        F.replace(timed, F.lit("\n"), F.lit("\n-")),  # a mark for each line: # is that of index lines
        (rf"\n-(?={_BLANK}*\p{{Nd}}+{_BLANK}*{stop})", "\n#"),
        (rf"(?:\n-{_BLANK}*{stop})++", "\r"),  # blank lines: \r stands between cues from here on
        (r"<[^>\n\r]+>", ""),
    )
    text = X.unescape_lines(marked, content) if unescape else marked
    kept = changed(
        text,
        (f"{_BLANK}+", " "),
        (r"(\n[-#]) ", "$1"),
        (rf" {stop}", ""),
        (rf"\n-{stop}", ""),  # lines without text
        (r"(?<![^\r])(?:\n#[^\n\r]*)++", ""),  # index lines before a cue's first line of text
    )
    return F.transform(F.filter(F.split(kept, "\r"), lambda cue: cue != ""), lambda cue: F.split(F.substr(cue, F.lit(3)), "\n[-#]"))


def rolling_dedupe(lines) -> Column:
    """Lines that are not among the last WINDOW emitted ones; a fold for short lists."""
    return F.aggregate(
        X._col(lines),
        F.array().cast("array<string>"),
        lambda out, x: F.when(F.array_contains(F.slice(out, F.greatest(F.size(out) - (WINDOW - 1), F.lit(1)), WINDOW), x), out).otherwise(F.concat(out, F.array(x))),
    )


def emitted(lines: Iterable[str]) -> Iterator[str]:
    """The same over any lines, in turn; only the last WINDOW are held."""
    recent: deque[str] = deque(maxlen=WINDOW)
    for line in lines:
        if line in recent:
            continue
        recent.append(line)
        yield line


@F.pandas_udf(T.ArrayType(T.StringType()))
def rolling_dedupe_long(lines: pd.Series) -> pd.Series:
    """The same in time proportional to the lines, for whole transcripts."""
    return lines.map(lambda rows: None if rows is None else list(emitted(rows)))


def _joined(rows: DataFrame) -> DataFrame:
    """Rows (lines, and other columns) with said for lines: the deduped lines of each row, joined."""
    small_batches(importable(rows.sparkSession))
    carried = [f for f in rows.schema.fields if f.name != "lines"]
    names = [f.name for f in carried]

    def run(batches):
        import pyarrow as pa

        for b in batches:
            lines, said = b.column(len(names)), []
            for i in range(0, len(lines), AT_ONCE):
                said += [" ".join(emitted(x or [])) for x in lines.slice(i, AT_ONCE).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(said, pa.string())], [*names, "said"])

    return rows.select(*names, "lines").mapInArrow(run, T.StructType([*carried, T.StructField("said", T.StringType())]))


def reflow(text, size: int = 5) -> Column:
    """Text as paragraphs of `size` sentences, an empty line between them."""

    def joined(parts: Column) -> Column:
        firsts = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / size).cast("int"))
        return F.array_join(F.transform(firsts, lambda i: F.array_join(F.slice(parts, i * size + 1, size), " ")), "\n\n")

    return X.let(X.sentences(X.strip(X.collapse_space(text))), joined)


def best_track(files: DataFrame) -> DataFrame:
    """One caption file for each video, and its rank: the manual English track (0), else the original automatic one (1), else any (2); ties by name."""
    video = X.file_stem("file")
    rank = F.when(F.col("file") == F.concat("id", F.lit(".en.srt")), 0).when(F.col("file") == F.concat("id", F.lit(".en-orig.srt")), 1).otherwise(2)
    rows = files.filter(F.col("file").endswith(".srt")).withColumn("id", video)
    rows = rows.withColumn("rank", rank)
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy("id").orderBy("rank", "file"))).filter("__r = 1").drop("__r")


def transcripts(files: DataFrame, done: DataFrame | None = None, min_chars: int = 200, chosen: bool = False) -> DataFrame:
    """id, body, words, status (written or too_short) of each video's best track; those in done are skipped.

    chosen: the rows are what `best_track` gave, and its rank and the file stay.
    """
    best, carried = files if chosen else best_track(files), ("rank", "file") if chosen else ()
    if done is not None:
        best = best.join(done.select("id"), "id", "left_anti")
    said = _joined(best.select("id", *carried, F.flatten(cues("content")).alias("lines")))
    body = said.select("id", *carried, reflow("said").alias("body"))
    return body.select("id", "body", X.word_count("body").alias("words"), F.when(F.length("body") >= min_chars, "written").otherwise("too_short").alias("status"), *carried)


def conversion_report(made: DataFrame, already: DataFrame) -> DataFrame:
    """written, already, too_short and all groups of a conversion, and the words written."""
    wrote = F.col("status") == "written"
    report = made.agg(F.count_if(wrote).alias("written"), F.count_if(~wrote).alias("too_short"), F.coalesce(F.sum(F.when(wrote, F.col("words"))), F.lit(0)).alias("words"))
    return report.join(F.broadcast(already.agg(F.count_distinct("id").alias("already"))), F.lit(True)).withColumn("groups", F.col("written") + F.col("already") + F.col("too_short"))
