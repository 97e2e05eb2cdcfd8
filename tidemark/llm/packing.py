"""Hierarchical multi-length packing of tokenised documents.

Tiers are powers of two up to the context size. A document first gives whole windows of the largest size; what
remains goes to the smallest tier that holds it. Every tier is packed from the largest down: a window's gap takes
the largest whole remainder of a shorter tier that fits (best fit), and a gap that no whole remainder fits is
closed by cutting one. Windows that still have a gap give up their pieces to fill one another, and the last
tail becomes windows of the tiers it holds, so that at most one sequence of a shard is padded. Sequences of a
shard then go to step groups of equal token budget; in order of attention cost (sum of squared piece lengths)
they are dealt back and forth, which balances the groups.

A shard is what one task reads, up to `SHARD_TOKENS` at a time: packing needs no shuffle, keeps bounded memory
(the longest document at most beyond it), and a lost task is redone from its own input. Sequence ids hold the
task and a running number.

A null or empty text gives its end id alone. Rows that repeat are packed as often as they come, those of null id too.
Texts are tokenised whole, whatever their length. An empty table gives an empty result. Columns other than doc_id and
text are not read, whatever their names.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from bisect import bisect_right, insort

from pyspark.sql import DataFrame

from .base import prepare, remembered, working

TIERS = (2048, 1024, 512, 256)
END = 1
SHARD_TOKENS = 1 << 20
#: Token budget of a step group, in windows of the largest size.
STEP_WINDOWS = 16
#: Chunks of text whose ids a worker remembers.
REMEMBERED = 250_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier long, step_group long"
#: Characters for which NFC is the identity, str.lower works letter by letter, and split() splits at the normaliser's white space.
_PLAIN = re.compile("[^\x00-\x1b\x20-\x84\x86-įı-ž]")

#: What the vocabulary's splitter makes of such characters in lower case (letters, digits one by one, symbols).
_LETTER, _DIGIT = "a-zªµºß-öø-ſ", "0-9²³¹¼-¾"
_RUNS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^\\s{_LETTER}{_DIGIT}]+").findall


class Encoder(dict):
    """chunk between spaces -> its ids as little-endian unsigned 32-bit bytes.

    The vocabulary's normaliser turns white space to a space and lowers case, and its splitter never crosses a
    space, so ids of a text are the ids of its chunks in turn; within a chunk of plain characters, those of its
    letter runs, digits and symbol runs in turn. What has not been used for `REMEMBERED` new chunks is forgotten.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.older: dict[str, bytes] = {}
        self.full = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.full.model)  # neither normaliser nor added tokens
        self.bare.pre_tokenizer = self.full.pre_tokenizer
        self.added = [t.content for t in self.full.get_added_tokens_decoder().values()]
        # how the splitter writes each plain character's bytes: a run of them goes to the model as it would send it
        plain = (c for c in map(chr, range(0x180)) if _PLAIN.search(c) is None and not c.isspace())
        self.written = {ord(c): "".join(p for p, _ in self.full.pre_tokenizer.pre_tokenize_str(c)) for c in plain}
        self.ascii = all(w == chr(c) for c, w in self.written.items() if 0x20 < c < 0x7F)

    def clear(self) -> None:
        super().clear()
        self.older = {}

    def __missing__(self, chunk: str) -> bytes:
        if len(self) > REMEMBERED:
            self.older = dict(self)
            super().clear()
        found = self.older.get(chunk)
        if found is None:
            runs = _RUNS(chunk) if _PLAIN.search(chunk) is None else ()
            if len(runs) > 1:
                found = b"".join(map(self.__getitem__, runs))
            elif runs == [chunk]:
                written = chunk if self.ascii and chunk.isascii() and chunk.isprintable() else chunk.translate(self.written)
                found = array("I", [t.id for t in self.full.model.tokenize(written)]).tobytes()
            else:
                found = array("I", self.bare.encode(chunk, add_special_tokens=False).ids).tobytes()
        self[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        if any(a in text for a in self.added):
            return array("I", self.full.encode(text, add_special_tokens=False).ids).tobytes()
        chunks = text.lower().split() if _PLAIN.search(text) is None else self.full.normalizer.normalize_str(text).split(" ")
        return b"".join(map(self.__getitem__, chunks))


@functools.cache
def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return remembered("packing", Encoder(path))


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences (padded length, [(document, start, length), ...]) of documents with the given token counts."""
    top, least = tiers[0], tiers[-1]
    done: list[tuple[int, list[tuple[int, int, int]]]] = []
    pool: list[tuple[int, int, int]] = []  # (length, document, start) of remainders, ascending
    for d, n in enumerate(lengths):
        whole = n // top * top
        done += [(top, [(d, s, top)]) for s in range(0, whole, top)]
        if n > whole:
            pool.append((n - whole, d, whole))
    pool.sort()
    short: list[tuple[int, int, list[tuple[int, int, int]]]] = []  # windows with a gap: (gap, tier, pieces)
    while pool:
        n, d, s = pool.pop()
        tier = next(t for t in reversed(tiers) if n <= t)
        pieces, gap = [(d, s, n)], tier - n
        while gap and pool and pool[0][0] <= gap:  # best fit of whole remainders
            m, e, u = pool.pop(bisect_right(pool, (gap, len(lengths), 0)) - 1)
            pieces.append((e, u, m))
            gap -= m
        if gap and pool:  # cut one of the shortest tier that has enough
            m, e, u = pool.pop(bisect_right(pool, (max(gap, least), len(lengths), 0)) - 1 if pool[0][0] <= max(gap, least) else 0)
            if m > gap:
                pieces.append((e, u, gap))
                insort(pool, (m - gap, e, u + gap))
                gap = 0
            else:
                pieces.append((e, u, m))
                gap -= m
        if gap:
            short.append((gap, tier, pieces))
        else:
            done.append((tier, pieces))
    loose = [p for _, _, pieces in short for p in pieces]  # only where the pool ran out: a few windows
    left = sum(n for _, _, n in loose)
    while left:
        size = next((t for t in tiers if t <= left), top)
        pieces, room = [], size
        while room and loose:
            d, s, n = loose.pop()
            take = min(n, room)
            pieces.append((d, s, take))
            if take < n:
                loose.append((d, s + take, n - take))
            room -= take
        left -= size - room
        done.append((size, pieces))
    return done


def step_groups(sequences: list[tuple[int, list[tuple[int, int, int]]]], budget: int) -> list[int]:
    """The step group of each sequence: equal budgets, attention cost dealt back and forth."""
    n = max(1, round(sum(size for size, _ in sequences) / budget))
    cost = sorted(range(len(sequences)), key=lambda i: (-sequences[i][0], -sum(m * m for _, _, m in sequences[i][1]), i))
    group = [0] * len(sequences)
    for k, i in enumerate(cost):
        at = k % (2 * n)
        group[i] = at if at < n else 2 * n - 1 - at
    return group


def packed(docs: DataFrame, path: str, tiers: tuple[int, ...] = TIERS, end: int = END) -> DataFrame:
    """A row for each piece: its document, place, checksum, sequence and step group."""
    prepare(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        working("packing")
        enc, last = encoder(path), array("I", [end]).tobytes()
        task = TaskContext.get().partitionId() << 40
        sequence = group = 0
        ids: list[bytes] = []
        names: list = []
        tokens = 0
        fields = [x.split()[0] for x in SCHEMA.split(", ")]

        def flush():
            nonlocal sequence, group, tokens
            made = pack([len(x) // 4 for x in ids], tiers)
            groups = step_groups(made, STEP_WINDOWS * tiers[0])
            rows = []
            for (size, pieces), g in zip(made, groups):
                at = 0
                # only a window without a gap keeps its tier; any other is padded to the largest
                tier = size if sum(n for _, _, n in pieces) == size else tiers[0]
                for d, s, n in pieces:
                    rows.append((names[d], s, n, zlib.crc32(ids[d][4 * s : 4 * (s + n)]), len(ids[d]) // 4, task + sequence, at, tier, task + group + g))
                    at += n
                sequence += 1
            group += max(groups, default=-1) + 1
            ids.clear()
            names.clear()
            tokens = 0
            return [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i : i + 20_000])], fields) for i in range(0, len(rows), 20_000)]

        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                for d, x in zip(part.column(0).to_pylist(), (enc.encode(t or "") for t in part.column(1).to_pylist())):
                    ids.append(x + last)
                    names.append(d)
                    tokens += len(x) // 4 + 1
                    if tokens >= SHARD_TOKENS:
                        yield from flush()
        if ids:
            yield from flush()

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)
