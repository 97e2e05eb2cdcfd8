"""What the training-data operators share: shared-folder tables, worker set-up, word hashes."""

from __future__ import annotations

import os
import zlib
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import freed, staged  # noqa: F401 - the operators take these from here

#: ASCII white space, the only separators of the word contracts.
ASCII_SPACE = " \t\n\x0b\x0c\r"
#: Rows of an Arrow batch; texts are long, so fewer than Spark's default.
BATCH_ROWS = 1024
_ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this library, and keep Arrow batches of long texts small."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "")
    if _ROOT not in paths.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, paths) if x)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


#: By operator, what its tasks remember in a worker process.
_memories: dict[str, list] = {}


def remembered(owner: str, memory):
    """Note a memory (anything with clear) as that of an operator's tasks."""
    _memories.setdefault(owner, []).append(memory)
    return memory


def working(owner: str) -> None:
    """A task of an operator starts: what those of other operators left in this worker goes."""
    for other, memories in _memories.items():
        if other != owner:
            for m in memories:
                m.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of_id(doc_id) -> F.Column:
    """crc32 of a document's id as text."""
    return F.crc32(F.col(doc_id).cast("string"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """These names, changed where df has columns of the same ones (upper and lower case are one to Spark)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, kept up to a bound; the same in every process."""

    def __init__(self, most: int = 150_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = zlib.crc32(word) << 32 | zlib.crc32(word[::-1] + b"\x01")
        return h


def mixed(x):
    """Finaliser of a 64-bit integer hash, over a numpy array."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes, n: int = 5):
    """64-bit hash of every window of n words; of the whole text where it has fewer words, and none where it has none."""
    import numpy as np

    h = np.asarray(hashes, dtype=np.uint64)
    n = min(n, len(h))
    m = len(h) - n + 1 if n else 0
    out = np.full(m, n, dtype=np.uint64)
    for k in range(n):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[k : k + m]
    return mixed(out)
