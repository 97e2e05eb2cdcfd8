"""Browser histories in SQLite files, as a Python data source that tests filters inside SQLite and reads by row ranges."""

from __future__ import annotations

import glob
import json
import os
import shutil
import tempfile
from contextlib import ExitStack, contextmanager
from urllib.parse import quote, unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import dates as D
from ..functions import text as X
from ..session import importable
from . import openers
from .takeout import video_id

# Profiles of each browser, the table with its visits, and the time column with its epoch.
CHROME = ("urls", "last_visit_time", 1601)
FIREFOX = ("moz_places", "last_visit_date", 1970)
PROFILES = (
    ("chrome", "~/.config/google-chrome/*/History", CHROME),
    ("chromium", "~/.config/chromium/*/History", CHROME),
    ("firefox", "~/.mozilla/firefox/*/places.sqlite", FIREFOX),
    ("firefox", "~/snap/firefox/common/.mozilla/firefox/*/places.sqlite", FIREFOX),
)
SITE = "%youtube.com/watch%"
JOURNALS = ("-wal", "-shm", "-journal")


#: Bytes of a database for each task that reads it in place, and bits of an input place for a row's number in its file.
PART_BYTES, ROW_BITS = 64 << 20, 32

# Conditions on the source's columns that SQLite tests as Spark does, by filter: text with {} for the column.
_TESTS = {
    "EqualTo": "{} = ? COLLATE BINARY",
    "GreaterThan": "{} > ? COLLATE BINARY",
    "GreaterThanOrEqual": "{} >= ? COLLATE BINARY",
    "LessThan": "{} < ? COLLATE BINARY",
    "LessThanOrEqual": "{} <= ? COLLATE BINARY",
    "StringContains": "instr({}, ?) > 0",
    "StringStartsWith": "substr({}, 1, ?) = ? COLLATE BINARY",
    "IsNotNull": "{} IS NOT NULL",
    "IsNull": "{} IS NULL",
}


class Part(InputPartition):
    """One of the stretches, alike in row numbers, of a database."""

    def __init__(self, uri: str, number: int, part: int, parts: int):
        self.uri, self.number, self.part, self.parts = uri, number, part, parts


class _Reader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.files = json.loads(options["files"])
        self.part_bytes = int(options.get("part_bytes", PART_BYTES))
        self.columns = {"url": "url", "title": "title", "visited": options["time"]}
        self.table, self.wanted = options["table"], columns
        if not (self.table.isidentifier() and options["time"].isidentifier()):
            raise ValueError("table and time must be names")
        self.where: list[tuple[str, list]] = [("url LIKE ?", [options["like"]])] if options.get("like", "%") != "%" else []

    def pushFilters(self, filters):
        for f in filters:
            kind, attribute = type(f).__name__, getattr(f, "attribute", ())
            column = self.columns.get(attribute[0]) if len(attribute) == 1 else None
            values = [f.value] if hasattr(f, "value") else []
            if column is None or kind not in _TESTS or not all(isinstance(v, (str, int)) for v in values):
                yield f
            elif kind == "StringStartsWith":
                self.where.append((_TESTS[kind].format(column), [len(f.value), f.value]))
            else:
                self.where.append((_TESTS[kind].format(column), values))

    def partitions(self):
        out = []
        for number, (uri, size) in enumerate(self.files):
            parts = max(1, -(-size // self.part_bytes)) if _in_place(uri) else 1
            out += [Part(uri, number, i, parts) for i in range(parts)]
        return out

    def read(self, part):
        if part is None:  # there are no files
            return
        with _database(part.uri) as base:
            tests, values = [t for t, _ in self.where], [v for _, x in self.where for v in x]
            low, high = base.execute(f"SELECT min(rowid), max(rowid) FROM {self.table}").fetchone()
            if low is None:
                return
            if high >> ROW_BITS or low < 0:
                raise ValueError(f"{part.uri} has row numbers beyond {1 << ROW_BITS}")
            step = high - low + 1
            tests += ["rowid >= ?", "rowid < ?"]
            values += [low + step * part.part // part.parts, low + step * (part.part + 1) // part.parts]
            names = {**self.columns, "ingest_ord": f"rowid + {part.number << ROW_BITS}"}
            wanted = ", ".join(names[c] for c in self.wanted) or "NULL"
            yield from base.execute(f"SELECT {wanted} FROM {self.table} WHERE {' AND '.join(tests)} ORDER BY rowid", values)


def _local(uri: str) -> str | None:
    parts = urlsplit(uri)
    return (unquote(parts.path) if parts.scheme else uri) if parts.scheme in ("", "file") else None


def _in_place(uri: str) -> bool:
    """Whether a database can be read where it is: a local file that no browser has open."""
    path = _local(uri)
    return path is not None and not any(os.path.exists(path + x) for x in JOURNALS)


@contextmanager
def _database(uri: str):
    """A database to read: in place, or a copy in the task's own folder together with its journals."""
    import sqlite3

    with ExitStack() as stack:
        if _in_place(uri):
            path, mode = _local(uri), "mode=ro&immutable=1"
        else:
            path, mode = os.path.join(stack.enter_context(tempfile.TemporaryDirectory()), "snapshot.db"), "mode=rw"
            for end in ("", *JOURNALS):
                try:
                    source = openers.opened(uri + end)
                except FileNotFoundError:
                    if not end:
                        raise
                    continue
                with source, open(path + end, "wb") as copy:
                    shutil.copyfileobj(source, copy, openers.BLOCK)
        base = sqlite3.connect(f"file:{quote(path)}?{mode}", uri=True)
        stack.callback(base.close)
        yield base


class BrowserHistory(DataSource):
    """Options: files (JSON: address and size), table, time (its column), like (a filter on addresses), part_bytes."""

    @classmethod
    def name(cls):
        return "browser_history"

    def schema(self):
        return "url string, title string, visited long, ingest_ord long"

    def reader(self, schema):
        return _Reader(self.options, schema.names)


def visits(spark: SparkSession, path: str, kind: tuple[str, str, int], columns: str | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """url, title, visited, ingest_ord (or the columns named, as DDL) of the site's rows in the databases at paths or patterns, by commas.

    Filters on these columns are tested inside SQLite, columns that are not named are not read, and a large database is
    read by several tasks. Databases may be in any file system; those that are not local are copied by one task each.
    """
    importable(spark).dataSource.register(BrowserHistory)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    files = [f for p in path.split(",") for f in openers.listed(spark, p) if not f[0].endswith(JOURNALS)]
    table, time, _ = kind
    read = spark.read.format("browser_history").options(files=json.dumps(files), table=table, time=time, like=SITE, part_bytes=part_bytes)
    return (read.schema(columns) if columns else read).load()


def browser_events(rows: DataFrame, label: str, epoch: int) -> DataFrame:
    """Watch events of url, title, visited (microseconds since the epoch), ingest_ord: one for each address, never with a channel."""
    when = D.from_epoch_1601("visited") if epoch == 1601 else D.from_epoch_1970("visited")
    kept = rows.filter(F.col("url").ilike(SITE)).withColumn("video_id", video_id("url")).filter("video_id is not null")
    return kept.select(
        "video_id",
        X.page_title(F.coalesce("title", F.lit(""))).alias("title"),
        F.lit(None).cast("string").alias("channel"),
        F.lit(None).cast("string").alias("channel_url"),
        D.visited_at(when).alias("watched_at"),
        F.lit(label).alias("source"),
        "ingest_ord",
    )


def read_browsers(spark: SparkSession, home: str | None = None) -> list[DataFrame]:
    """The events of every browser profile that is there."""
    out = []
    for label, pattern, kind in PROFILES:
        paths = sorted(glob.glob(pattern.replace("~", home, 1) if home else os.path.expanduser(pattern)))
        if paths:
            out.append(browser_events(visits(spark, ",".join(paths), kind), label, kind[2]))
    return out
