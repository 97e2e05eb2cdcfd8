"""Exact dedup by a heavy-hitter split.

Texts are equal when identical after deleting ASCII white space. Each partition keeps a Misra-Gries summary of
its digests; the merged summary names at most `k` candidates, which hold every digest of more than 2n/(k+1)
rows. Their exact counts and winners are computed with map-side combining and broadcast (at most k rows), so
rows of hot groups never shuffle. The remaining digests, none of more than 2n/(k+1) rows, go through an
ordinary shuffle and a window.

Of equal texts the row with the most code points in its original text stays, then the smallest doc_id (null
ids last). A null text counts as empty, and empty texts form one group. Rows that repeat with the same id and
text form a group like any other copies: exactly one of them stays; of rows of one id and length whose white space
differs, the one whose text has the smallest hash. An empty table gives an empty result. Texts are read whole, whatever
their length. Other columns are ignored by `exact_dedup` and carried along by `keep_first`, whatever their names.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import ASCII_SPACE, freed, prepare, staged, unused

#: Candidates of the Misra-Gries summaries, and so rows of the broadcast.
HEAVY = 1024


def text_digest(text="text"):
    return F.unhex(F.sha2(F.translate(F.coalesce(F.col(text), F.lit("")), ASCII_SPACE, ""), 256))


def _summary(k: int):
    def of(batches):
        import pyarrow as pa

        seen: Counter = Counter()
        for b in batches:
            seen.update(b.column(0).to_pylist())
            if len(seen) > k:  # the Misra-Gries merge: subtract the (k+1)th largest count
                cut = sorted(seen.values(), reverse=True)[k]
                seen = Counter({v: n - cut for v, n in seen.items() if n > cut})
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["digest", "n"])

    return of


def heavy_winners(rows: DataFrame, k: int = HEAVY, tie: tuple[str, ...] = ()) -> DataFrame:
    """At most k verified frequent digests of rows (digest, n_chars, doc_id): digest, group_size, winner.

    The summed lower bounds of the summaries decide on the candidates; counts and winners are exact.
    """
    local = rows.select("digest").mapInArrow(_summary(k), "digest binary, n long")
    likely = local.groupBy("digest").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "digest").limit(k).select("digest")
    return (
        rows.join(F.broadcast(likely), "digest")
        .groupBy("digest")
        .agg(F.count("*").alias("group_size"), F.min(_order(*tie)).alias("winner"))
        .filter("group_size > 1")
    )


def _order(*tie: str):
    return F.struct((-F.col("n_chars")).alias("o"), F.col("doc_id").isNull().alias("z"), F.col("doc_id"), *map(F.col, tie))


def exact_dedup(docs: DataFrame, k: int = HEAVY) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and heavy (removed on the map side) for every row."""
    prepare(docs.sparkSession)
    rows = staged(
        docs.select("doc_id", text_digest().alias("digest"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"), F.xxhash64("text").alias("raw")).withColumn("rid", F.monotonically_increasing_id()),
        "digests",
    )
    heavy = staged(heavy_winners(rows, k, ("raw", "rid")), "heavy")
    marked = rows.join(F.broadcast(heavy), "digest", "left")
    hot = marked.filter("winner is not null").select("doc_id", F.col("winner.doc_id").alias("keep_id"), "group_size", (F.col("winner.rid") == F.col("rid")).alias("kept"), "digest", F.lit(True).alias("heavy"))
    group = Window.partitionBy("digest")
    first = F.min(_order("raw", "rid")).over(group)
    rest = marked.filter("winner is null").select("doc_id", "digest", "rid", first.alias("w"), F.count("*").over(group).alias("group_size"))
    rest = rest.select("doc_id", F.col("w.doc_id").alias("keep_id"), "group_size", (F.col("w.rid") == F.col("rid")).alias("kept"), "digest", F.lit(False).alias("heavy"))
    return hot.unionByName(rest).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"), "heavy")


def keep_first(docs: DataFrame, k: int = HEAVY) -> DataFrame:
    """The rows of docs that stay, with all their columns.

    Losers of heavy groups go on the map side; what is left shuffles by digest once.
    """
    prepare(docs.sparkSession)
    digest, chars, raw, winner, rank = unused(docs, "__tm_digest", "__tm_chars", "__tm_raw", "__tm_winner", "__tm_rank")
    full = docs.withColumns({digest: text_digest(), chars: F.length(F.coalesce("text", F.lit(""))).cast("long"), raw: F.xxhash64("text")})
    rows = staged(full.select(F.col(digest).alias("digest"), F.col(chars).alias("n_chars"), "doc_id", F.col(raw).alias("raw")), "digests")
    heavy = staged(heavy_winners(rows, k, ("raw",)).select(F.col("digest").alias(digest), F.col("winner").alias(winner)), "heavy")
    freed(rows)
    mine = (F.col(f"{winner}.o") == -F.col(chars)) & F.col(f"{winner}.doc_id").eqNullSafe(F.col("doc_id")) & (F.col(f"{winner}.raw") == F.col(raw))
    left = full.join(F.broadcast(heavy), digest, "left").filter(F.col(winner).isNull() | mine)
    order = Window.partitionBy(digest).orderBy(F.desc(chars), F.col("doc_id").asc_nulls_last(), raw)
    return left.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) == 1).drop(digest, chars, raw, winner, rank)
