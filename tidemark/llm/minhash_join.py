"""N-gram Jaccard join by MinHash banding.

A text's n-grams are its windows of five words (in lower case, split at ASCII white space); a shorter text is one
n-gram, an empty one has none and links to nothing. Texts of the same words are copies and form one text class;
only one representative of it goes on, so copies are never paired.

Bands and rows follow from the target recall: the fewest rows for which pairs of low similarity seldom meet, then
as many bands as make a pair at the threshold meet with that probability (`banding`). Representatives shuffle on
band hashes; a bucket of several gives star links to its smallest member (as many as members), and the components
of the stars are the candidate groups: every pair that shares a bucket lies in one. The full n-gram sets of the
members, built again from whole texts, then meet by candidate group, and every pair inside is verified there on the
full sets, in blocks: a group of many members is cut into g blocks, and pairs of blocks are separate units of
work. A unit gives a row for each member (its links and the root of its verified links), never the pairs.

Jaccard distance is a metric, so in a large group the exact distance to one member (its pivot) settles most pairs:
members within half the distance allowed of the pivot, the group's core, are all linked with one another. Of `PIVOTS`
members the one with the largest core is taken. Only pairs with a member outside the core meet in blocks, so a group of
many near copies of one text is read about once.
Components of the roots are the near-duplicate classes.

Result for every row: class_id (smallest doc_id of its class), n_links (different texts at the threshold or
above), text_id (smallest doc_id of its copies) and n_copies. Rows that repeat count as copies. Null ids sort last;
a class of null ids alone has a null class_id. A null text counts as empty. Long texts are read whole. An empty table
gives an empty result. Other columns are ignored by `minhash_join` and carried along by `keep_one`, whatever their
names. Texts are found again by a hash of the text beside the id, so ids that are null or stand on many texts cost no
more than others.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import WordHashes, freed, prepare, remembered, shingles, staged, unused, working

WORDS, SIMILARITY, RECALL = 5, 0.8, 0.995
#: Pairs of similarity LOW shall meet with this probability at most.
LOW, LOW_RATE = 0.25, 1e-3
#: Members of a block, and n-grams of it, about.
BLOCK_ROWS, BLOCK_GRAMS = 512, 250_000
#: Members of a large group that are tried as its pivot.
PIVOTS = 8
#: Rows (of at most some 40 bytes) up to which a side is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
_hashes = remembered("minhash_join", WordHashes())


def banding(similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[int, int]:
    """(bands, rows): a pair at the similarity meets with probability recall, at LOW with LOW_RATE at most."""
    for rows in range(1, 33):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if 1 - (1 - LOW**rows) ** bands <= LOW_RATE:
            break
    return bands, rows


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def gram_set(words: list[bytes]):
    """Sorted distinct n-gram hashes."""
    import numpy as np

    return np.unique(shingles(np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words)), WORDS))


def text_class(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


class MinHash:
    def __init__(self, bands: int, rows: int):
        import numpy as np

        rng = np.random.default_rng(20_011)
        self.bands, self.rows = bands, rows
        k = bands * rows
        self.a = (rng.integers(0, 1 << 32, k, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
        self.c = rng.integers(0, 1 << 32, k, dtype=np.uint64).astype(np.uint32)[:, None]
        self.buffer = np.empty((k, 256), np.uint32)

    def keys(self, grams) -> list[int]:
        """The band hashes of a set, each with its band in it."""
        import numpy as np

        h = (grams >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(h), 256):
            part = h[None, i : i + 256]
            buf = self.buffer[:, : part.shape[1]]
            np.multiply(self.a, part, out=buf)
            np.add(buf, self.c, out=buf)
            np.minimum(low, buf.min(1), out=low)
        sig = low.reshape(self.bands, self.rows).astype(np.uint64)
        out = np.arange(1, self.bands + 1, dtype=np.uint64)
        for r in range(self.rows):
            x = out * np.uint64(0x9E3779B97F4A7C15) + sig[:, r]
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            out = x ^ (x >> np.uint64(32))
        return out.view(np.int64).tolist()


def signatures(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, cls (of the words), n_grams, bands and raw (a hash of the text) of every row."""
    prepare(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        working("minhash_join")
        m = MinHash(bands, rows)
        for b in batches:
            cls, n, keys = [], [], []
            for t in b.column(1).to_pylist():
                w = words_of(t)
                g = gram_set(w)
                cls.append(text_class(w))
                n.append(len(g))
                keys.append(m.keys(g) if len(g) else [])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cls, pa.binary()), pa.array(n, pa.int64()), pa.array(keys, pa.list_(pa.int64())), b.column(2)], ["doc_id", "cls", "n_grams", "bands", "raw"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text", "xxhash64(text) raw").mapInArrow(run, "doc_id long, cls binary, n_grams long, bands array<long>, raw long")


def _side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df for the small side of a join: broadcast if it is small, else the build side of a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df.hint("shuffle_hash")


def components(edges: DataFrame) -> DataFrame:
    """v, root for every vertex of edges (a, b): the smallest vertex that it is connected with.

    Each round takes the smallest label of the neighbours, hooks the old root to it, and jumps; rounds grow with
    the logarithm of the longest chain. Every round is a written table.
    """
    both = staged(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "edges")
    last = now = staged(both.groupBy("a").agg(F.min("b").alias("n")).select(F.col("a").alias("v"), F.least("a", "n").alias("root")), "labels")
    while True:
        near = both.join(now.select(F.col("v").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("n"))
        seen = now.join(near.withColumnRenamed("a", "v"), "v").select("v", "root", F.least("root", "n").alias("best"))
        asked = seen.select("v", "best").union(seen.select("root", "best"))
        hooked = staged(asked.groupBy("v").agg(F.min("best").alias("up")), "hooked")
        jumped = hooked.join(hooked.select(F.col("v").alias("up"), F.col("up").alias("top")), "up").select("v", "top")
        after = staged(now.join(jumped, "v").select("v", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")), "labels")
        freed(hooked, last)
        if after.filter("moved").isEmpty():
            freed(both)
            return after.select("v", "root")
        last, now = after, after.select("v", "root")


def verified(sets: list, left, right, similarity: float):
    """Boolean matrix of pairs (left member, right member) whose Jaccard similarity reaches the threshold."""
    import numpy as np

    size = np.array([len(s) for s in sets])
    n = len(sets)
    if n <= 6:
        inter = np.zeros((len(left), len(right)))
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                if x != y and min(size[x], size[y]) >= similarity * max(size[x], size[y]):
                    inter[i, j] = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
    else:
        flat = np.concatenate(sets)
        known, at, times = np.unique(flat, return_inverse=True, return_counts=True)
        doc = np.repeat(np.arange(n), size)
        shared = times > 1
        place = np.cumsum(shared) - 1
        keep = shared[at]
        doc, col = doc[keep], place[at[keep]]
        order = np.argsort(col, kind="stable")
        doc, col = doc[order], col[order]
        inter = np.zeros((len(left), len(right)), np.float32)
        width = int(shared.sum())
        for lo in range(0, width, 4096):
            hi = min(lo + 4096, width)
            a, b = np.searchsorted(col, [lo, hi])
            m = np.zeros((n, hi - lo), np.float32)
            m[doc[a:b], col[a:b] - lo] = 1
            inter += m[left] @ m[right].T
    whole = size[left][:, None] + size[right][None, :] - inter
    return (inter >= similarity * whole - 1e-9) & (np.asarray(left)[:, None] != np.asarray(right)[None, :]) & (whole > 0)


def _unit(similarity: float):
    def run(table):
        """Members of one block, or of a pair of blocks: links of each, and the root of its links."""
        import numpy as np
        import pyarrow as pa

        cls = table.column("cls").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
        block = np.array(table.column("block").to_pylist())
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        everyone = np.arange(len(cls))
        left, right = (everyone, everyone) if lo == hi else (everyone[block == lo], everyone[block == hi])
        links = np.zeros(len(cls), np.int64)
        root = sorted(range(len(cls)), key=cls.__getitem__)
        rank = np.empty(len(cls), np.int64)
        rank[root] = everyone
        if len(left) and len(right):
            ok = verified(sets, left, right, similarity)
            links[left] += ok.sum(1)
            if lo != hi:
                links[right] += ok.sum(0)
            x, y = np.nonzero(ok)
            x, y = left[x], right[y]
            while True:  # smallest rank among linked members
                before = rank.copy()
                np.minimum.at(rank, x, rank[y])
                np.minimum.at(rank, y, rank[x])
                if (rank == before).all():
                    break
        at = [cls[root[r]] for r in rank]
        return pa.table({"cls": pa.array(cls, pa.binary()), "root": pa.array(at, pa.binary()), "links": pa.array(links, pa.int64()), "parts": table.column("parts")})

    return run


def near_groups(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """(members, classes): doc_id and cls of every row; cls, text_id, n_copies, class_id, n_links of every text."""
    prepare(docs.sparkSession)
    bands, rows = banding(similarity, recall)
    sig = staged(signatures(docs, bands, rows), "signatures")
    texts = staged(sig.groupBy("cls").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "raw")).alias("one"), F.count("*").alias("n_copies"), F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands")).selectExpr("cls", "one.doc_id text_id", "one.raw raw", "n_copies", "n_grams", "bands"), "texts")
    keys = texts.select("cls", F.explode("bands").alias("key"))
    multi = staged(keys.groupBy("key").agg(F.count("*").alias("n"), F.min("cls").alias("head")).filter("n > 1").select("key", "head"), "buckets")
    stars = keys.join(multi, "key").select(F.col("cls").alias("a"), F.col("head").alias("b")).filter("a <> b")
    group = components(stars)
    found = staged(group.join(texts.select(F.col("cls").alias("v"), "text_id", "raw", "n_grams"), "v").select(F.col("v").alias("cls"), "text_id", "raw", "n_grams", F.col("root").alias("candidates")), "candidates")
    freed(multi)
    big = staged(
        found.groupBy("candidates")
        .agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n_grams") / BLOCK_GRAMS)).alias("parts"), F.count("*").alias("n"))
        .selectExpr("candidates", "cast(least(parts, n) as int) parts")
        .filter("parts > 1"),
        "large",
    )
    sets = _sets(docs, found.select("cls", "text_id", "raw", "candidates"))
    zero = F.lit(0)
    units = sets.join(_side(big), "candidates", "left_anti").select("candidates", "cls", "grams", zero.alias("block"), F.lit(1).alias("parts"), zero.alias("lo"), zero.alias("hi"))
    split = core = None
    if not big.isEmpty():
        split, cut = _large(sets.join(_side(big), "candidates"), similarity)
        units = units.unionByName(_pairs_of_blocks(split, cut))
        core = cut.filter("n_core > 0").select("candidates", "first", "n_core")
    verified_links = units.groupBy("candidates", "lo", "hi").applyInArrow(_unit(similarity), "cls binary, root binary, links long, parts int")
    if core is not None:
        sure = split.filter("core").join(_side(core), "candidates").select("cls", F.col("first").alias("root"), (F.col("n_core") - 1).alias("links"), F.lit(2).alias("parts"))
        verified_links = verified_links.unionByName(sure)
    done = staged(verified_links, "links")
    freed(sets, big, *((split, cut) if split is not None else ()))
    # a group of one unit has its roots; those of several units join over their units
    joined = components(done.filter("parts > 1 and cls <> root").select(F.col("cls").alias("a"), F.col("root").alias("b")))
    linked = done.groupBy("cls").agg(F.sum("links").alias("n_links"), F.min("root").alias("root")).filter("n_links > 0")
    linked = linked.join(joined.select(F.col("v").alias("cls"), F.col("root").alias("over")), "cls", "left").select("cls", "n_links", F.coalesce("over", "root").alias("root"))
    linked = staged(linked.join(found.select("cls", "text_id"), "cls"), "linked")
    heads = linked.groupBy("root").agg(F.min("text_id").alias("class_id"))
    classes = linked.join(heads, "root").select("cls", "n_links", "class_id")
    classes = texts.select("cls", "text_id", "n_copies").join(classes, "cls", "left").select("cls", "text_id", "n_copies", F.when(F.col("n_links").isNull(), F.col("text_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    classes = staged(classes, "classes")
    freed(found, done, linked, texts)
    return sig.select("doc_id", "cls"), classes


def _to_pivot(similarity: float):
    def run(table):
        """Members of a block of a large group, and its pivots: a bit for each pivot whose core has the member."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        few = table.filter(table.column("pivot"))
        pivots = [np.frombuffer(x, np.uint64) for _, x in sorted(zip(few.column("cls").to_pylist(), few.column("grams").to_pylist()))]
        table = table.filter(pc.invert(table.column("pivot")))
        sets = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
        size = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        cores = np.zeros(len(sets), np.int64)
        for i, pivot in enumerate(pivots):
            shared = pivot[np.minimum(np.searchsorted(pivot, flat), len(pivot) - 1)] == flat
            inter = np.add.reduceat(shared, size.cumsum() - size, dtype=np.int64) if sets else size
            cores |= (1 - inter / (size + len(pivot) - inter) <= (1 - similarity) / 2 - 1e-12).astype(np.int64) << i
        return pa.table({"candidates": table.column("candidates"), "cls": table.column("cls"), "grams": table.column("grams"), "n": pa.array(size, pa.int64()), "cores": pa.array(cores, pa.int64())})

    return run


def _large(members: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Members of large groups (candidates, cls, grams, n, core), and for each group its blocks and its core.

    members: cls, candidates, grams, parts. The pivots tried are a group's smallest members, by a hash of their words.
    """
    own = members.select("candidates", "cls", "grams", F.lit(False).alias("pivot"), F.pmod(F.xxhash64("cls"), F.col("parts")).alias("block"))
    first = F.row_number().over(Window.partitionBy("candidates").orderBy("cls"))
    pivots = members.withColumn("place", first).filter(F.col("place") <= PIVOTS)
    pivots = pivots.select("candidates", "cls", "grams", F.lit(True).alias("pivot"), F.explode(F.expr("sequence(0L, parts - 1L)")).alias("block"))
    near = staged(own.unionByName(pivots).groupBy("candidates", "block").applyInArrow(_to_pivot(similarity), "candidates binary, cls binary, grams binary, n long, cores long"), "cores")
    inside = F.array(*(F.count_if(F.col("cores").bitwiseAND(F.lit(1 << i)) != 0) for i in range(PIVOTS)))
    best = near.groupBy("candidates").agg(inside.alias("c")).selectExpr("candidates", "cast(array_position(c, array_max(c)) - 1 as int) best")
    split = staged(near.join(_side(best), "candidates").selectExpr("candidates", "cls", "grams", "n", "(shiftright(cores, best) & 1) = 1 core"), "split")
    freed(near)

    def blocks(of):
        count = F.count(F.when(of, 1))
        return F.least(count, F.greatest(F.ceil(count / BLOCK_ROWS), F.ceil(F.coalesce(F.sum(F.when(of, F.col("n"))), F.lit(0)) / BLOCK_GRAMS)))

    core = F.col("core")
    cut = split.groupBy("candidates").agg(blocks(core).alias("core_blocks"), blocks(~core).alias("rest_blocks"), F.count(F.when(core, 1)).alias("n_core"), F.min(F.when(core, F.col("cls"))).alias("first"))
    return split, staged(cut, "cut")


def _pairs_of_blocks(split: DataFrame, cut: DataFrame) -> DataFrame:
    """Units of large groups: every pair of blocks but those of two blocks of the core; rest blocks have the first numbers."""
    rows = split.join(_side(cut.select("candidates", "core_blocks", "rest_blocks")), "candidates")
    block = F.expr("if(core, rest_blocks + pmod(xxhash64(cls), greatest(core_blocks, 1L)), pmod(xxhash64(cls), greatest(rest_blocks, 1L)))")
    most = F.expr("if(core, rest_blocks, rest_blocks + core_blocks)")
    others = F.explode(F.expr("if(most > 0, sequence(0L, greatest(most, 1L) - 1L), cast(array() as array<bigint>))"))
    rows = rows.withColumns({"block": block, "most": most}).withColumn("other", others)
    return rows.select("candidates", "cls", "grams", F.col("block").cast("int").alias("block"), F.lit(2).alias("parts"), F.least("block", "other").cast("int").alias("lo"), F.greatest("block", "other").cast("int").alias("hi"))


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """cls, candidates and the full n-gram set (sorted 64-bit hashes) of wanted texts, once each."""
    side = _side(wanted.selectExpr("cls", "candidates", "text_id wanted_id", "raw wanted"))
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text", "xxhash64(text) raw").join(side, (F.col("raw") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("wanted_id"))).select("text", "cls", "candidates")

    def run(batches):
        import pyarrow as pa

        working("minhash_join")
        for b in batches:
            cls, grp, grams = [], [], []
            for t, c, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                w = words_of(t)
                if text_class(w) == c:  # an id may stand on several texts
                    cls.append(c)
                    grp.append(g)
                    grams.append(gram_set(w).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.binary()), pa.array(grp, pa.binary()), pa.array(grams, pa.binary())], ["cls", "candidates", "grams"])

    return staged(rows.mapInArrow(run, "cls binary, candidates binary, grams binary").dropDuplicates(["cls"]), "sets")


def minhash_join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links, text_id, n_copies for every row."""
    members, classes = near_groups(docs, similarity, recall)
    return members.join(classes, "cls").select("doc_id", "class_id", "n_links", "text_id", "n_copies")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The rows of docs but those of a class that another document stands for; one of each class stays, with all columns.

    An id goes only where none of its rows stands for a class. Rows that repeat the id and words of the one that stays
    all stay (exact dedup removes those), and so do rows of null id.
    """
    members, classes = near_groups(docs, similarity, recall)
    told = members.join(classes, "cls").select("doc_id", "class_id")
    gone = told.filter("doc_id <> class_id").select("doc_id").distinct().join(classes.select(F.col("class_id").alias("doc_id")), "doc_id", "left_anti")
    (name,) = unused(docs, "__tm_gone")
    gone = staged(gone.select(F.col("doc_id").alias(name)), "gone")
    return docs.join(_side(gone), F.col("doc_id").cast("long") == F.col(name), "left_anti")
