"""A content-addressed WARC archive: payload bytes stand once under their SHA-256, record headers apart, and joins give the records back.

An archive is a folder of two tables: `headers` (a row for each record: its exact WARC header block and the digest of
its payload) and `payloads` (digest and bytes, once). Of records with equal payloads of at least `LEAST` bytes the one
with the largest page_id is the response and the others are revisits that refer to it; smaller payloads are all
responses, and equal ones still stand once.

Digests are verified: copies that share a SHA-256 must share SHA-1 and length when written, and stored bytes are
hashed again when read; a difference stops the query. Payloads that occur once are written where they are read. To know
them, hashes (mod `SLOTS`) of the digests that occur more than once are broadcast, `SLOTS` whole numbers at most; the
payloads that meet one of them are combined by digest before they shuffle, so a payload that a third of all pages have
is sent once by each task. Decisions are made on digests alone.

A null html counts as empty. A null page_id comes before all others and stays null. Rows that repeat are records of
their own: of those with the largest page_id one is the response. A null url stands as an empty one; control characters
in a url are percent-encoded, so no url can end a header. An empty table gives an empty archive and result. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import openers
from .base import prepare, staged

#: Bytes of the smallest payload that copies refer to.
LEAST = 1000
SLOTS = 1 << 20
#: Bytes of payload that a reader of WARC files hands on together, about.
OUT_BYTES = 8_000_000
# Line end, version line and the profile of revisits.
CRLF, VERSION = "\r\n", "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _payload() -> Column:
    return F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")


def _field(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))).otherwise(F.lit(""))


def _record_id(page: Column, number: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), number.cast("string"), F.lit(">"))


def _slot() -> Column:
    return F.pmod(F.xxhash64("sha256"), F.lit(SLOTS)).cast("int")


def described(pages: DataFrame) -> DataFrame:
    """A row for each page: page_id, url, size and digests of its payload, kind, and which record a revisit refers to."""
    rows = pages.select("page_id", "url", _payload().alias("p"))
    rows = staged(rows.select("page_id", "url", F.octet_length("p").cast("long").alias("size"), F.unhex(F.sha1("p")).alias("sha1"), F.unhex(F.sha2("p", 256)).alias("sha256"), F.monotonically_increasing_id().alias("number")), "pages")
    shared = rows.groupBy("sha256").agg(
        F.count("*").alias("copies"),
        F.max(F.struct("page_id", "number")).alias("chosen"),
        F.min(F.struct("size", "sha1")).alias("low"),
        F.max(F.struct("size", "sha1")).alias("high"),
    )
    shared = shared.filter("copies > 1").select("sha256", F.when(F.col("low") == F.col("high"), F.col("chosen")).otherwise(F.raise_error(F.lit("payloads of one SHA-256 differ"))).alias("chosen"))
    shared = staged(shared, "shared")
    out = rows.join(shared, "sha256", "left")
    revisit = (F.col("size") >= LEAST) & F.col("chosen").isNotNull() & (F.col("chosen.number") != F.col("number"))
    out = out.withColumn("kind", F.when(revisit, "revisit").otherwise("response")).withColumn("chosen", F.when(revisit, F.col("chosen")))
    out._tidemark_shared = shared
    return out


def header_block() -> Column:
    """The exact header of a record, up to its empty line."""
    safe = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    refers = F.when(F.col("kind") == "revisit", _record_id(F.col("chosen.page_id"), F.col("chosen.number")))
    return F.concat(
        F.lit(VERSION + CRLF),
        _field("WARC-Type", F.col("kind")),
        _field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("number"))),
        _field("WARC-Target-URI", safe),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.lower(F.hex("sha1")))),
        _field("WARC-Refers-To", refers),
        _field("WARC-Profile", F.when(F.col("kind") == "revisit", PROFILE)),
        _field("Content-Type", F.lit("text/html; charset=utf-8")),
        _field("Content-Length", F.when(F.col("kind") == "revisit", 0).otherwise(F.col("size")).cast("string")),
        F.lit(CRLF),
    )


def write_archive(pages: DataFrame, path: str) -> str:
    """Write the archive of pages (page_id, url, html) to a new folder."""
    prepare(pages.sparkSession)
    records = described(pages)
    records.select(header_block().alias("header"), F.col("sha256").alias("payload_sha256")).write.parquet(f"{path}/headers")
    repeated = F.broadcast(records._tidemark_shared.select(_slot().alias("slot")).distinct())  # SLOTS rows at most
    payload = pages.select(_payload().alias("payload")).withColumn("sha256", F.unhex(F.sha2("payload", 256))).withColumn("slot", _slot())
    once = payload.join(repeated, "slot", "left_anti").select("sha256", "payload")
    rest = payload.join(repeated, "slot", "left_semi").groupBy("sha256").agg(F.first("payload").alias("payload"))
    once.write.parquet(f"{path}/payloads")
    rest.write.mode("append").parquet(f"{path}/payloads")
    return path


def header_value(name: str) -> Column:
    """A field of a header block; null where there is none."""
    return F.nullif(F.regexp_extract("header", rf"(?:^|\n){name}: ([^\r\n]*)\r\n", 1), F.lit(""))


def records(spark: SparkSession, path: str) -> DataFrame:
    """header, payload, payload_sha256 of every record of an archive; a revisit has the payload that it refers to."""
    heads = spark.read.parquet(f"{path}/headers")
    stored = spark.read.parquet(f"{path}/payloads")
    right = F.unhex(F.sha2("payload", 256)) == F.col("sha256")
    stored = stored.select(F.col("sha256").alias("payload_sha256"), F.when(right, F.col("payload")).otherwise(F.raise_error(F.lit("a stored payload has another digest"))).alias("payload"))
    return heads.join(stored, "payload_sha256", "left").withColumn("payload", F.coalesce("payload", F.raise_error(F.lit("a record's payload is not in the archive")))).select("header", "payload", "payload_sha256")


def page_of(field: Column) -> Column:
    return F.nullif(F.regexp_extract(field, "^<urn:page:([^:]*):", 1), F.lit(""))


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """page_id_text, payload_bytes, payload_digest, record_type, refers_to_text of every record; each payload is held against its header."""
    rows = records(spark, path).select("header", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    kind, stated = header_value("WARC-Type"), header_value("WARC-Payload-Digest")
    fine = (stated == F.concat(F.lit("sha1:"), "payload_digest")) & (header_value("Content-Length").cast("long") == F.when(kind == "revisit", 0).otherwise(F.col("payload_bytes")))
    return rows.select(
        page_of(header_value("WARC-Record-ID")).alias("page_id_text"),
        "payload_bytes",
        F.when(fine, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a payload differs from what its header states"))).alias("payload_digest"),
        kind.alias("record_type"),
        page_of(header_value("WARC-Refers-To")).alias("refers_to_text"),
    )


def write_warc(spark: SparkSession, path: str, to: str) -> None:
    """The archive's records as WARC files; a record ends with two line ends, which Spark's text writer puts."""
    block = F.when(header_value("WARC-Type") == "revisit", F.lit("")).otherwise(F.col("payload").cast("string"))
    records(spark, path).select(F.concat("header", block).alias("value")).write.option("lineSep", CRLF + CRLF).text(to)


def parsed(file) -> Iterator[tuple[bytes, bytes]]:
    """Header block and content of the records of an open WARC file, one at a time; a file that ends inside a record stops the reader."""
    end = CRLF.encode()
    while line := file.readline():
        lines = [line]
        while line != end:
            if not (line := file.readline()):
                raise ValueError("a WARC file ends inside a header")
            lines.append(line)
        size = next((int(x.partition(b":")[2]) for x in lines if x.lower().startswith(b"content-length:")), None)
        if size is None or not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {lines[0][:40]!r}")
        content = file.read(size)
        if len(content) < size or file.read(4) != end + end:
            raise ValueError("a WARC file ends inside a record, or a record is longer than it states")
        yield b"".join(lines), content


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """header and content of the records of WARC files (plain or gzip) at a path or pattern; a file a task, a record at a time."""
    prepare(spark)
    files = [uri for uri, _ in openers.listed(spark, path)]

    def run(batches):
        import gzip

        import pyarrow as pa

        for b in batches:
            for uri in b.column(0).to_pylist():
                with openers.opened(uri) as file:
                    heads, contents, held = [], [], 0
                    for header, content in parsed(gzip.open(file) if uri.endswith(".gz") else file):
                        heads.append(header.decode("utf-8", "replace"))
                        contents.append(content)
                        held += len(content)
                        if held >= OUT_BYTES or len(heads) >= 1024:
                            yield pa.RecordBatch.from_arrays([pa.array(heads, pa.string()), pa.array(contents, pa.binary())], ["header", "content"])
                            heads, contents, held = [], [], 0
                    if heads:
                        yield pa.RecordBatch.from_arrays([pa.array(heads, pa.string()), pa.array(contents, pa.binary())], ["header", "content"])

    rows = spark.createDataFrame([(u,) for u in files], "uri string").repartition(max(1, len(files)))
    return rows.mapInArrow(run, "header string, content binary")
