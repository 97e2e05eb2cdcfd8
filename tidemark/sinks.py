"""Writers. Tables go to new paths; nothing overwrites what it reads from."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import file_sink
from .sources import lists, openers


def json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines in the frame's order, null fields kept, text beyond ASCII as it is."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def _parts(lines: DataFrame, path: str, order: list[str], first: str, rest, last: str) -> None:
    """Lines (order, rest, value) as a document in parts: ranges of the order, a line for each row, what stands before it in front."""
    ranges = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    value = F.concat(F.when(F.monotonically_increasing_id() == 0, F.lit(first)).otherwise(rest), "value")  # the first range has the first row
    ranges.select(value.alias("value")).write.mode("overwrite").text(path)
    empty = all(not size for _, size in openers.listed(lines.sparkSession, path))
    openers.put(lines.sparkSession, f"{path}/part-end.txt", (f"[\n{']'}\n" if empty else f"{last}\n").encode())


def json_document(df: DataFrame, path: str, order: str) -> None:
    """A JSON array in parts, a row a line, that make one document when they are joined in order; order must differ between rows."""
    row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    _parts(df.select(F.col(order).alias("__o"), row.alias("value")), path, ["__o"], "[", F.lit(","), "]")


def json_groups(heads: DataFrame, members: DataFrame, path: str, key: str, place: str, name: str) -> None:
    """A JSON array of objects, each with an array of its members, in parts like `json_document`'s: a member a line, so a group of any size is split.

    heads: a row for each object; members: key, place (from 1 in each group) and the member's fields.
    """
    head = F.regexp_replace(F.to_json(F.struct(*heads.columns), {"ignoreNullFields": "false"}), r"\}$", "")
    opened = heads.select(F.col(key).alias("__k"), F.lit(0).cast("long").alias("__p"), F.concat(head, F.lit(f',"{name}":[')).alias("value"))
    fields = [c for c in members.columns if c not in (key, place)]
    own = members.select(F.col(key).alias("__k"), F.col(place).cast("long").alias("__p"), F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))
    before = F.when(F.col("__p") == 0, "]},").when(F.col("__p") == 1, "").otherwise(",")
    _parts(opened.unionByName(own), path, ["__k", "__p"], "[", before, "]}]")


def joined(spark, path: str, to: str) -> None:
    """A document's parts as one file, in order: by the file system where it can join files, else streamed into it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    end = "part-end.txt"
    parts = sorted((p for p, size in openers.listed(spark, path) if size), key=lambda p: (p.endswith(end), int(p.rsplit("/part-", 1)[1].split("-")[0]) if not p.endswith(end) else 0))
    at = jvm.org.apache.hadoop.fs.Path(to)
    fs = _file_system(spark, at)
    paths = [jvm.org.apache.hadoop.fs.Path(p) for p in parts]
    try:
        fs.create(at).close()
        array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(paths))
        for i, p in enumerate(paths):
            array[i] = p
        fs.concat(at, array)
    except Exception as e:
        if "supported" not in str(e).lower():  # as local files and object stores say
            raise
        out = fs.create(at, True)
        for p in paths:
            source = fs.open(p)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
            source.close()
        out.close()


def json_object(row: DataFrame, path: str) -> None:
    """One JSON object of a frame of one row (a channel's summary)."""
    row.limit(1).select(F.to_json(F.struct(*row.columns), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def append_lines(ids: DataFrame, path: str) -> None:
    """Ids after those that are there; a repeated run adds nothing."""
    spark = ids.sparkSession
    new = ids.select(F.col(ids.columns[0]).cast("string").alias("value")).distinct()
    if lists.exists(spark, path):
        new = new.join(spark.read.text(path), "value", "left_anti")
    new.write.mode("append").text(path)


def append_records(records: DataFrame, path: str) -> None:
    """Records after those that are there; a document taken in again has several."""
    json_lines(records, path, "append")


def transcripts(df: DataFrame, path: str, corpus: str) -> None:
    """id and body under their corpus, so that a run reads only its own; ids that are there stay as they are."""
    spark, mine = df.sparkSession, f"{path}/corpus={corpus}"
    new = df.select("id", F.concat("body", F.lit("\n")).alias("body"))
    if lists.exists(spark, mine):
        new = new.join(spark.read.schema("id string").parquet(mine), "id", "left_anti")
    new.write.mode("append").parquet(mine)


def transcript_files(df: DataFrame, path: str) -> None:
    """A text file for each transcript (id, body), named by its id; files that are there and not empty stay as they are."""
    file_sink.write_files(df.select(F.concat("id", F.lit(".txt")).alias("name"), F.encode(F.concat("body", F.lit("\n")), "UTF-8").alias("content")), path, keep=True)


def raw_and_reduced(raw: DataFrame, reduced: DataFrame, path: str) -> None:
    """The listing as it came beside the reduced one."""
    raw.write.mode("overwrite").json(f"{path}/raw")
    json_lines(reduced, f"{path}/videos")


def enumerated(raw: DataFrame, reduced: DataFrame, channel: DataFrame, path: str) -> None:
    """A channel's listing, its videos, and its summary as one object."""
    raw_and_reduced(raw, reduced, path)
    json_object(channel, f"{path}/channel")


def _file_system(spark, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def replaced(df: DataFrame, path: str) -> None:
    """A table in place of the one at path, which df may read: written beside it, then renamed.

    If a rename fails the old table is put back and the call fails; nothing is deleted before the new one is in place.
    On object stores a rename copies, and readers may meet neither table for that time.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    new, old, at = (jvm.org.apache.hadoop.fs.Path(x) for x in (f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}", path))
    df.write.option("ignoreNullFields", "false").json(new.toString())
    fs = _file_system(spark, at)
    was = fs.exists(at)
    if was and not fs.rename(at, old):
        raise OSError(f"{path} could not be moved aside; the new table is at {new.toString()}")
    if not fs.rename(new, at):
        if was:
            fs.rename(old, at)
        raise OSError(f"{path} is as it was; the new table is at {new.toString()}")
    if was:
        fs.delete(old, True)


def report(df: DataFrame, n: int = 40) -> str:
    """A small report as text."""
    head = df.limit(n).collect()
    cells = [df.columns, *([("-" if x is None else str(x)) for x in r] for r in head)]
    wide = [max(map(len, c)) for c in zip(*cells)]
    return "\n".join("  ".join(x.ljust(w) for x, w in zip(r, wide)).rstrip() for r in cells)
