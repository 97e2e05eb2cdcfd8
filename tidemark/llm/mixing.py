"""Mixing sources to target weights by Pfair scheduling.

Weights become whole numbers k out of Q = `FRAME`, so finely that no stream comes near the end of a frame. Block j
of a source is released at slot floor(j*Q/k) and due before slot ceil((j+1)*Q/k); in every slot the released block
with the earliest deadline runs. For unit blocks whose weights add up to one this meets every deadline, so at any
point of the stream each source is less than one block away from its target weight. The driver works out which
source has each slot of the stream, and the place of every document follows from its place within its source. Blocks
have `BLOCK` rows, or twice as many, and so on, until the stream has at most `MOST_SLOTS` slots or larger blocks of small
sources would make it longer. So what the driver works out, and what is broadcast of it, is bounded by `MOST_SLOTS` or
by about the inverse of the least source's share of the weights, and does not grow with the rows beyond that.

A source's documents are ordered by a hash of the id (SHA-256, its first 60 bits). To find the order without gathering a
source in one task, the hashes of each source are cut into ranges in proportion to its rows: counts of ranges give each
range's first place, and rows are numbered within ranges. A source that runs out begins again (a new epoch) until the source
that lasts longest for its weight has been used up: every document comes at least once, and weights hold
throughout. By default weights are proportional to rows to the power `ALPHA`, which lifts small sources.

Weights given must be above zero, and every source must have one; else the query stops. A null source is a source of its own. Sources beyond the `MAX_SOURCES` largest
share queues of about `QUEUE_SOURCES`, which weigh what their sources do and are worked out in tasks: the slots of a
queue are given to its sources in the same way by their own weights, so each is less than two blocks away from its own. Repeated rows
are scheduled as often as they come; ties of the order are between equal ids, and go by a hash of what is carried. Null ids and texts are scheduled
like any others. An empty table gives an empty result. Texts are carried whole, whatever their length. Columns other than
doc_id and source are not read by `mix`; `mixed` carries all of them along as one value, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections import deque
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import prepare, staged

ALPHA = 0.7
#: Slots of a stream at most, where sources have rows enough for larger blocks.
MOST_SLOTS = 1 << 21
#: Times its length that a stream may have with larger blocks.
LONGER = 1.05
#: Documents of a block, and slots of a frame.
BLOCK, FRAME = 16, 1 << 48
MAX_SOURCES, QUEUE_SOURCES = 50_000, 4096
#: Rows of a bucket at least, and buckets altogether, about.
BUCKET_ROWS, BUCKETS = 512, 100_000
#: Blocks of a source whose slots are looked up together.
PART = 256
#: Slots whose rows `mixed` keeps together in order.
CHUNK_SLOTS = 64


def quotas(weights: list[float], slots: int) -> list[int]:
    """Whole slots of a frame by largest remainders, one at least for every source."""
    order, left, total = deque(sorted(range(len(weights)), key=lambda i: (weights[i], i))), slots, math.fsum(weights)
    while order and weights[order[0]] * left < total:
        total -= weights[order.popleft()]
        left -= 1
    total = math.fsum(weights[i] for i in order)
    exact = {i: weights[i] / total * left for i in order}
    out = [int(exact.get(i, 1)) for i in range(len(weights))]
    for i in sorted(order, key=lambda i: (int(exact[i]) - exact[i], i))[: slots - sum(out)]:
        out[i] += 1
    return out


def frame(k: list[int], blocks: list[int] | None = None) -> Iterator[tuple[int, int]]:
    """(source, block) of every slot of a frame, earliest deadline first; given blocks, up to where every source has had as many."""
    slots = sum(k)
    missing = sum(x > 0 for x in blocks) if blocks else 0
    ready = [(-(-slots // n), s, 0) for s, n in enumerate(k)]
    heapq.heapify(ready)
    coming: dict[int, list[tuple[int, int, int]]] = {}
    for t in range(slots):
        for job in coming.pop(t, ()):
            heapq.heappush(ready, job)
        due, s, j = heapq.heappop(ready)
        if due <= t:
            raise AssertionError("a block missed its deadline")
        yield s, j
        if blocks and j + 1 == blocks[s]:
            missing -= 1
            if not missing:
                return
        after = -(-(j + 2) * slots // k[s]), s, j + 1
        if (release := (j + 1) * slots // k[s]) <= t + 1:
            heapq.heappush(ready, after)
        else:
            coming.setdefault(release, []).append(after)


def _release(j: str, k: str):
    """The first slot for a source's block j (SQL) of k blocks in a frame."""
    return F.expr(f"(cast({j} as decimal(20,0)) * cast({FRAME} as decimal(16,0))) div cast({k} as decimal(16,0))")


def _deadline(j: str, k: str):
    """The slot before which j blocks have run."""
    return F.expr(f"(cast({j} as decimal(20,0)) * cast({FRAME} as decimal(16,0)) + {k} - 1) div cast({k} as decimal(16,0))")


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """A row for each time that a document comes, from __at, __n and __run: __epoch, __block, __inside."""
    rows = rows.withColumn("__epoch", F.explode(F.expr("sequence(0L, (__run - 1 - __at) div __n)")))
    return rows.withColumns({"__block": F.expr(f"(__at + __epoch * __n) div {block}"), "__inside": F.expr(f"(__at + __epoch * __n) % {block}")})


def _key():
    """The place of a document in its source's order, from 0 to before 2^60."""
    return F.conv(F.substr(F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 256), F.lit(1), F.lit(15)), 16, 10).cast("long")


def _queue(table, weight):
    """Number, sources, rows, weights and quotas of a queue, in the same order wherever they are worked out."""
    rows = sorted(zip(table.column("source").to_pylist(), table.column("n").to_pylist()), key=lambda x: (x[0] is None, x[0]))
    w = [weight(*x) for x in rows]
    if min(w) <= 0:
        raise ValueError("weights must be above zero")
    return table.column("__queue")[0].as_py(), rows, w, quotas(w, FRAME)


def _totals(weight, block: int):
    def run(table):
        import pyarrow as pa

        q, rows, w, k = _queue(table, weight)
        blocks = max(-(-(-(-n // block)) * FRAME // x) for (_, n), x in zip(rows, k))  # by then all have come
        return pa.table({"__queue": pa.array([q], pa.int64()), "w": [math.fsum(w)], "blocks": pa.array([blocks], pa.int64())})

    return run


def _turns(weight, of: dict):
    """For each source of a queue, which of the queue's blocks are its own; of: source number, quota and blocks of a queue."""

    def run(table):
        import pyarrow as pa

        q, rows, _, k = _queue(table, weight)
        number, outer, length = of[q]
        own: list[list[int]] = [[] for _ in rows]
        for g, (s, _) in enumerate(islice(frame(k), length)):
            own[s].append(g)
        out = [(s, p) for s, x in enumerate(own) for p in range(-(-len(x) // PART))]
        long = lambda x: pa.array(x, pa.int64())
        return pa.table({
            "__name": pa.array([rows[s][0] for s, _ in out], table.schema.field("source").type), "__source": pa.array([number] * len(out), pa.int32()), "__k": long([outer] * len(out)), "__n": long([rows[s][1] for s, _ in out]),
            "__own": long([k[s] for s, _ in out]), "__blocks": long([len(own[s]) for s, _ in out]), "__part": long([p for _, p in out]), "__turns": pa.array([own[s][p * PART : (p + 1) * PART] for s, p in out], pa.list_(pa.int64())),
        })

    return run


def _parts(spark, order, had) -> DataFrame:
    """__source, __part, __slots: where the blocks of each source run, PART of them in a row."""
    import numpy as np
    import pyarrow as pa

    parts = -(-had // PART)
    source = np.repeat(np.arange(len(had), dtype=np.int32), parts)
    part = np.arange(len(source)) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = np.append(np.repeat(np.cumsum(had) - had, parts) + part * PART, len(order)).astype(np.int32)
    slots = pa.ListArray.from_arrays(pa.array(starts), pa.array(np.argsort(order, kind="stable").astype(np.int32)))
    return spark.createDataFrame(pa.table({"__source": pa.array(source), "__part": pa.array(part.astype(np.int64)), "__slots": slots}), "__source int, __part long, __slots array<int>")


def block_rows(n: list[int], w: list[float], most: int = MOST_SLOTS) -> int:
    """Rows of a block: BLOCK, doubled until a stream of sources with n rows and weights w has few enough slots, or small sources would make it longer."""
    block, total = BLOCK, math.fsum(w)

    def slots(block: int) -> float:
        return max((-(-x // block) * total / y for x, y in zip(n, w)), default=0)

    while slots(block) > most and 2 * block * slots(2 * block) <= LONGER * BLOCK * slots(BLOCK):
        block *= 2
    return block


def schedule(docs: DataFrame, weights: dict | None = None, alpha: float = ALPHA, block: int | None = None, carry: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """A row for each time that a document (doc_id, source, perhaps others) comes: the carried columns, then __source, __epoch, __block, __slot, __release, __deadline, __position."""
    import numpy as np

    spark = prepare(docs.sparkSession)
    sizes = docs.groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.col("source").asc_nulls_last()).limit(MAX_SOURCES + 1).collect()
    names = [r.source for r in sizes[:MAX_SOURCES]]
    n = [r.n for r in sizes[:MAX_SOURCES]]

    def weight(s, x):
        if weights is None:
            return x**alpha
        if s not in weights:
            raise ValueError(f"source {s!r} has no weight")
        return weights[s]

    if block is None:
        block = block_rows(n, [weight(s, x) for s, x in zip(names, n)])
    w, blocks = [weight(s, x) for s, x in zip(names, n)], [-(-x // block) for x in n]
    tail, queues = None, []
    if len(sizes) > MAX_SOURCES:
        largest = F.broadcast(spark.createDataFrame([(s,) for s in names], docs.select(F.col("source").alias("__name")).schema))
        tail = docs.groupBy("source").agg(F.count("*").alias("n")).join(largest, F.col("source").eqNullSafe(F.col("__name")), "left_anti")
        tail = staged(tail, "tail")
        tail = tail.withColumn("__queue", F.pmod(F.xxhash64("source"), F.lit(-(-tail.count() // QUEUE_SOURCES))))
        queues = sorted(tail.groupBy("__queue").applyInArrow(_totals(weight, block), "__queue long, w double, blocks long").collect())
        w, blocks = w + [q.w for q in queues], blocks + [q.blocks for q in queues]
    if min(w, default=1) <= 0:
        raise ValueError("weights must be above zero")
    k = quotas(w, FRAME)
    order = np.array(array("i", (s for s, _ in frame(k, blocks))), np.int32) if n else np.zeros(0, np.int32)
    had = np.bincount(order, minlength=len(w))
    runs = [int(x) * block for x in had]
    per = max(BUCKET_ROWS, -(-sum(n) // BUCKETS))
    about = spark.createDataFrame([(s, names[s], x, k[s], runs[s], -(-x // per)) for s, x in enumerate(n)], "__source int, __name string, __n long, __k long, __run long, __buckets long")
    rows = docs.join(F.broadcast(about), docs["source"].cast("string").eqNullSafe(F.col("__name")))
    rows = rows.withColumn("__key", _key()).withColumn("__bucket", F.expr("(__key div 268435456) * __buckets div 4294967296"))  # 2^28 and 2^32
    counts = staged(rows.groupBy("__source", "__bucket").agg(F.count("*").alias("__rows")), "buckets")
    before = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("__source", "__bucket", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__first"))
    keep = list(carry)
    tie = F.xxhash64(*keep)
    inside = Window.partitionBy("__source", "__bucket").orderBy("__key", "__tie")
    rows = rows.select(*keep, tie.alias("__tie"), "__source", "__bucket", "__key", "__n", "__k", "__run").withColumn("__r", F.row_number().over(inside) - 1)
    rows = rows.join(F.broadcast(firsts), ["__source", "__bucket"])  # at most BUCKETS rows and one for each source
    place = F.col("__first") + F.col("__r")
    rows = _blocks(rows.withColumn("__at", place), block).withColumns({"__turn": F.col("__block"), "__from": F.col("__block"), "__to": F.col("__block") + 1})
    mine = [*keep, "__source", "__k", "__epoch", "__block", "__inside", "__turn", "__from", "__to"]
    rows = rows.select(*mine)
    if queues:
        of = {q["__queue"]: (len(n) + i, k[len(n) + i], int(had[len(n) + i])) for i, q in enumerate(queues)}
        kind = docs.schema["source"].dataType.simpleString()
        turns = staged(tail.groupBy("__queue").applyInArrow(_turns(weight, of), f"__name {kind}, __source int, __k long, __n long, __own long, __blocks long, __part long, __turns array<long>"), "turns")
        firsts = turns.filter("__part = 0").drop("__part", "__turns")
        few = docs.join(firsts, docs["source"].eqNullSafe(F.col("__name")))
        few = few.withColumn("__at", F.row_number().over(Window.partitionBy("__name").orderBy(_key(), tie)).cast("long") - 1)
        few = _blocks(few.withColumn("__run", F.col("__blocks") * block), block).withColumn("__part", F.expr(f"__block div {PART}"))
        at = turns.selectExpr("__name as __which", "__part as __piece", "__turns")
        few = few.join(at, F.col("__name").eqNullSafe(F.col("__which")) & (F.col("__part") == F.col("__piece")))
        few = few.withColumns({"__turn": F.get("__turns", (F.col("__block") % PART).cast("int")), "__from": _release("__block", "__own"), "__to": _deadline("__block + 1", "__own")})
        rows = rows.unionByName(few.select(*mine))
    rows = rows.withColumn("__part", F.expr(f"__turn div {PART}")).join(F.broadcast(_parts(spark, order, had)), ["__source", "__part"])  # a number for each slot
    rows = rows.withColumn("__slot", F.get("__slots", (F.col("__turn") % PART).cast("int")))
    release, deadline = _release("__from", "__k"), _deadline("__to", "__k")
    return rows.select(*keep, "__source", "__epoch", "__block", "__slot", release.alias("__release"), deadline.alias("__deadline"), (F.col("__slot").cast("long") * block + F.col("__inside")).alias("__position"))


def mix(docs: DataFrame, weights: dict | None = None, alpha: float = ALPHA, block: int | None = None) -> DataFrame:
    """doc_id, source, epoch, block, slot, release, deadline, position: the mixed stream; positions have no gaps."""
    out = schedule(docs.select("doc_id", "source"), weights, alpha, block)
    return out.select("doc_id", "source", *(F.col(f"__{c}").cast("long").alias(c) for c in ("epoch", "block", "slot", "release", "deadline", "position")))


def mixed(docs: DataFrame, weights: dict | None = None, alpha: float = ALPHA, block: int | None = None) -> DataFrame:
    """The documents in the order of the mixed stream, with all their columns; stretches of CHUNK_SLOTS slots stay together."""
    quoted = [f"`{c.replace('`', '``')}`" for c in docs.columns]
    whole = docs.select(F.col("doc_id"), F.col("source"), F.struct(*quoted).alias("__document"))
    out = schedule(whole, weights, alpha, block, ("__document",))
    return out.repartition(F.floor(F.col("__slot") / CHUNK_SLOTS)).sortWithinPartitions("__position").select("__document.*")
