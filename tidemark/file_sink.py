"""A file for each row, written by tasks: a Python data source writer with commit and abort.

A task writes its files into a folder of its own and moves them to their places when all of them are whole, so nobody
meets half a file, and a task that fails or is run twice leaves none. If the job fails its folders go; files of tasks
that had ended stay, whole and right, and the next run writes over them, or with `keep` passes them by.
"""

from __future__ import annotations

import os
import shutil
import uuid
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .session import importable


class _Local:
    def make(self, path: str) -> None:
        os.makedirs(path, exist_ok=True)

    def size(self, path: str) -> int:
        return os.path.getsize(path) if os.path.exists(path) else -1

    def write(self, path: str, content: bytes) -> None:
        with open(path, "wb") as f:
            f.write(content)

    def move(self, a: str, b: str) -> None:
        os.replace(a, b)

    def remove(self, path: str) -> None:
        shutil.rmtree(path, ignore_errors=True)


class _Remote:
    def __init__(self, system):
        self.system = system

    def make(self, path: str) -> None:
        self.system.create_dir(path, recursive=True)

    def size(self, path: str) -> int:
        found = self.system.get_file_info(path)
        return found.size if found.is_file else -1

    def write(self, path: str, content: bytes) -> None:
        with self.system.open_output_stream(path) as f:
            f.write(content)

    def move(self, a: str, b: str) -> None:
        if self.size(b) >= 0:
            self.system.delete_file(b)
        self.system.move(a, b)

    def remove(self, path: str) -> None:
        self.system.delete_dir(path)


def _system(uri: str):
    """What writes to an address, and its path there: local files, or one of Arrow's file systems."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return _Local(), unquote(parts.path) if parts.scheme else uri
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return _Remote(system), path


@dataclass
class Written(WriterCommitMessage):
    files: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.keep = options["path"], options.get("keep", "false").lower() == "true"
        self.pending = f"_pending-{uuid.uuid4().hex}"

    def write(self, batches):
        system, top = _system(self.path)
        own, names = f"{top}/{self.pending}/{uuid.uuid4().hex}", []
        system.make(own)
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not name or "/" in name or name[0] in "._":
                    raise ValueError(f"{name!r} can't be a file's name")
                if content is None or (self.keep and system.size(f"{top}/{name}") > 0):
                    continue
                system.write(f"{own}/{name}", content)
                names.append(name)
        for name in dict.fromkeys(names):
            system.move(f"{own}/{name}", f"{top}/{name}")
        return Written(len(names))

    def _cleared(self) -> None:
        system, top = _system(self.path)
        system.remove(f"{top}/{self.pending}")

    def commit(self, messages) -> None:
        self._cleared()

    def abort(self, messages) -> None:
        self._cleared()


class FileSet(DataSource):
    """Rows of name and content; options: path, keep (files that are there and not empty stay as they are)."""

    @classmethod
    def name(cls):
        return "file_set"

    def schema(self):
        return "name string, content binary"

    def writer(self, schema, overwrite):
        return _Writer(self.options)


def write_files(rows: DataFrame, path: str, keep: bool = False) -> None:
    """A file for each row of (name, content); of rows with one name in a task the last counts."""
    importable(rows.sparkSession).dataSource.register(FileSet)
    rows.select("name", F.col("content").cast("binary").alias("content")).write.format("file_set").option("keep", str(keep).lower()).mode("append").save(path)
