"""Documents of several kinds to text, through a registry of extractors that run on the executors."""

from __future__ import annotations

import subprocess
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import importable, small_batches
from .openers import whole_files

Extractor = Callable[[bytes], str]

# External commands by extension; {} is the file.
COMMANDS = {".pdf": ["pdftotext", "-enc", "UTF-8", "{}", "-"], ".epub": ["pandoc", "-t", "plain", "--wrap=none", "{}"]}
TIMEOUT_S = 600


def command(ext: str) -> Extractor:
    """An extractor that runs the external command of an extension."""

    def run(content: bytes) -> str:
        with tempfile.NamedTemporaryFile(suffix=ext) as f:
            f.write(content)
            f.flush()
            done = subprocess.run([f.name if x == "{}" else x for x in COMMANDS[ext]], capture_output=True, timeout=TIMEOUT_S)
        if done.returncode:
            raise RuntimeError(f"{COMMANDS[ext][0]} failed: {done.stderr.decode('utf-8', 'replace').strip()[:200]}")
        return plain(done.stdout)

    return run


def plain(content: bytes) -> str:
    """Bytes as text, line ends of any system as line feeds."""
    return content.decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n")


EXTRACTORS: dict[str, Extractor] = {".pdf": command(".pdf"), ".epub": command(".epub"), ".txt": plain}


def extracted(files: DataFrame, extractors: dict[str, Extractor] | None = None) -> DataFrame:
    """path, content_sha, text, error of files (path, content); one file's failure is a value, not the query's."""
    small_batches(importable(files.sparkSession))
    known = extractors or EXTRACTORS

    def run(batches):
        import hashlib

        import pyarrow as pa

        for b in batches:
            rows = []
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                leaf = path.rpartition("/")[2]
                ext = "." + leaf.rpartition(".")[2].lower() if "." in leaf[1:] else ""
                text = error = None
                if ext in known:
                    try:
                        text = known[ext](content)
                    except Exception as e:
                        error = str(e)
                rows.append((path, hashlib.sha256(content).hexdigest(), text, error))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)] if rows else [pa.array([], pa.string())] * 4, ["path", "content_sha", "text", "error"])

    return files.select("path", "content").mapInArrow(run, "path string, content_sha string, text string, error string")


def read_documents(spark: SparkSession, path: str, extractors: dict[str, Extractor] | None = None) -> DataFrame:
    return extracted(whole_files(spark, path), extractors)


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """Plain text alone, without Python: path, content_sha, text."""
    rows = whole_files(spark, path)
    return rows.select("path", F.sha2("content", 256).alias("content_sha"), X.universal_newlines(X.decoded("content")).alias("text"), F.lit(None).cast("string").alias("error"))
