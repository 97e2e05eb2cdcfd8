"""Scores by masked pseudo-likelihood.

A small bidirectional network predicts every word of a text from the `SIDE` words on its left and right (beyond the
ends stands a mark), in two steps that are both conditioned on both sides: the word's ending, then its beginning given
the ending (a hierarchical softmax of `UNITS` and `UNITS` choices). Endings and beginnings are subword units: the
`WHOLE` most frequent words are endings of their own, the others are the most frequent suffixes and prefixes of up to
`LONGEST` bytes, and a word has the longest that fits. So rare and unseen words have units too, as targets and as
neighbours. The last factor, the word given its two units, comes from the counts of the whole corpus: its count in
their cell where it was counted twice or more, else the cell's mass of other words times its spelling (bytes between
beginning and end, each given the one before, under the corpus's other words). The sum of the logarithms over all words
is the text's score, and its mean per word ranks texts of any length.

The `VOCABULARY` most frequent words and their counts go to every task. Counts of all others, however many, stay in a
table: a task scores such a word as spelled and names it beside its text, and a join by word then adds what each word
that was counted twice or more gains by its count. So every count is exact, and the probabilities of a cell never add up
to more than one. Gains are whole numbers (`GAIN_PARTS`), so their sums don't depend on order.

Training reads every text and predicts every word of it once. A hash of a row's id and text gives its round (of
`ROUNDS`) and its shard of about `SHARD_WORDS` words, so copies of a text spread over all of them. Texts are looked up once:
their units (two bytes a word) are written by round, trained on, and scored. The shards of a round train side by side from the same weights, each in the order of its
hashes; the mean of their weights, by words, starts the next round. Shards follow from the corpus alone, and means are
added up in whole numbers, so scores don't depend on partitions or the order of rows. A lost task costs its own shard.

Words are in lower case and split at ASCII white space. A text without words (or null) has 0 words, sum 0 and a null
mean. An empty table, or one without words, gives scores without a model: none is needed. Repeated rows train and
return as often as they come. Other columns are ignored, whatever their names. Long texts are read whole.

Words are split and told apart for many texts at once by Arrow, and each distinct one is looked up once among them. The
network scores words of many texts together, but no matrix product has rows of two texts, so a text scores the same
whatever stands beside it.
"""

from __future__ import annotations

import math
from itertools import repeat

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import freed, prepare, staged, working

VOCABULARY, UNITS, WHOLE, LONGEST, SIDE = 65_536, 64, 24, 3, 2
EMBEDDING, HIDDEN = 4, 16
ROUNDS, SHARD_WORDS = 8, 1_000_000
BATCH, POOL, RATE = 512, 32, 0.7
#: Fractions of the unit of log probabilities in the gains.
GAIN_PARTS = 1 << 20
#: Characters of texts whose words are counted and looked up together, and words scored together.
COUNTED, LOOKED_UP, TOGETHER = 1 << 24, 1 << 22, 1 << 16
#: Rows that the network scores at a time, and rows of a matrix product: a text takes whole ones, since a row's last bits follow from its place in the product.
BLOCK, ROW_STEP = 960, 48
#: Fractions of a weight's unit in the whole-number means, and words that weigh one.
UNIT_PARTS, WORDS_PER_WEIGHT = 1 << 24, 1024
_END = 256  # of the spelled middle, and as the state before it; above it: a beginning and ending that overlap


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def groups(items, size, most: int):
    """Items in turn, in lists whose sizes reach `most`."""
    held, n = [], 0
    for x in items:
        held.append(x)
        n += size(x)
        if n >= most:
            yield held
            held, n = [], 0
    if held:
        yield held


def _characters(text: str | None) -> int:
    return len(text or "") + 1


def distinct_words(texts: list[str | None]):
    """Distinct words of the texts (an Arrow array), the place among them of each word in turn, and each text's number of words; words are those of `words_of`."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    split = pc.ascii_split_whitespace(pa.array([(t or "").lower() for t in texts], pa.large_string()))
    ends = split.offsets.to_numpy()
    found = split.values.dictionary_encode()
    words, at = found.dictionary, found.indices.to_numpy()
    blank = pc.index(words, "").as_py()
    if blank >= 0:  # before a text's first word, after its last, or all of it
        full = at != blank
        ends = np.append(0, full.cumsum())[ends]
        at = at[full]
        at = at - (at > blank)
        words = pa.concat_arrays([words[:blank], words[blank + 1 :]])
    return words.cast(pa.large_binary()).cast(pa.binary()), at, np.diff(ends)


def listed(words) -> list[bytes]:
    """An Arrow array's words; a tenth of the time that `to_pylist` takes."""
    return words.to_numpy(zero_copy_only=False).tolist()


def word_counts(docs: DataFrame) -> DataFrame:
    """w (binary), n over all texts; each task adds up its own before the counts meet."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        working("lm_score")
        for part in groups((t for b in batches for t in b.column(0).to_pylist()), _characters, COUNTED):
            words, at, _ = distinct_words(part)
            if len(words):
                yield pa.RecordBatch.from_arrays([words, pa.array(np.bincount(at, minlength=len(words)), pa.int64())], ["w", "n"])

    return docs.select("text").mapInArrow(run, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))


class Units:
    """Endings and beginnings of words: which of them a word has."""

    def __init__(self, whole: list[bytes], endings: list[bytes], beginnings: list[bytes]):
        import numpy as np

        self.whole = {w: i for i, w in enumerate(whole)}
        self.sides = []  # for each side and length: sorted codes and their units
        for first, parts, ending in ((len(whole), endings, True), (0, beginnings, False)):
            side = []
            for n in range(1, LONGEST + 1):
                codes = sorted((int.from_bytes(p if not ending else p[::-1], "little"), first + 1 + i) for i, p in enumerate(parts) if len(p) == n)
                side.append((np.array([c for c, _ in codes], np.int64), np.array([u for _, u in codes], np.int64)))
            self.sides.append((first, side))  # the unit `first` is that of words without any of the parts

    def of(self, words: list[bytes]):
        """Ending, beginning and the bytes each takes, of words that are not whole units."""
        import numpy as np

        size = np.fromiter(map(len, words), np.int64, len(words))
        ends = size.cumsum()
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        out = []
        for (first, side), at, step in zip(self.sides, (ends - 1, ends - size), (-1, 1)):
            unit, taken, code = np.full(len(words), first), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
            for n, (codes, units) in enumerate(side, 1):
                fits = size >= n
                code += np.where(fits, flat[np.where(fits, at + step * (n - 1), 0)], 0) << 8 * (n - 1)
                if len(codes):
                    near = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                    hit = fits & (codes[near] == code)
                    unit[hit], taken[hit] = units[near[hit]], n
            out += [unit, taken]
        return out[0], out[2], out[1], out[3]

    def spelled(self, words: list[bytes], end_taken, begin_taken):
        """State and next symbol at every step of the words' middles, and the first step of each word."""
        import numpy as np

        size = np.fromiter(map(len, words), np.int64, len(words))
        ends = size.cumsum()
        flat = np.frombuffer(b"".join(words), np.uint8)
        middle = size - end_taken - begin_taken
        steps = np.maximum(middle, 0) + 1
        last = steps.cumsum()
        first = last - steps
        place = np.repeat(ends - size + begin_taken - first, steps) + np.arange(last[-1] if len(words) else 0)
        symbol = flat[np.clip(place, 0, max(len(flat) - 1, 0))].astype(np.int64)
        symbol[last - 1] = _END + np.maximum(-middle, 0)
        state = np.empty_like(symbol)
        state[1:] = symbol[:-1]
        state[first] = _END
        return state, symbol, first


STATES, SYMBOLS = 257, 257 + 2 * LONGEST


class Lexicon:
    """What the corpus's counts say: words, units, cells and letters; made on the driver, sent to the tasks."""

    def __init__(self, units: Units, top: list[tuple[bytes, int]], cells, others, letters):
        """cells, others: tokens by ending and beginning, of all words and of those without a count of their own."""
        import numpy as np

        self.units = units
        self.ids = {w: i for i, (w, _) in enumerate(top)}
        plain = [w for w, _ in top]
        self.ending, self.beginning, *_ = units.of(plain)
        for w, i in units.whole.items():
            self.ending[self.ids[w]] = i
        n = np.array([x for _, x in top], np.float64)
        self.cells = cells.astype(np.float64) + 1
        self.log_cell = np.log(self.cells)
        self.log_other = np.log((others + 1.0) / self.cells)
        self.log_word = np.log(n) - self.log_cell[self.ending, self.beginning]
        total = self.cells.sum(1)
        self.log_ending = np.log(total / total.sum()).astype(np.float32)
        self.log_beginning = np.log(self.cells / total[:, None]).astype(np.float32)
        self.log_letter = np.log((letters + 0.01) / (letters + 0.01).sum(1, keepdims=True))

    def encode(self, words: list[bytes], tails: bool = False):
        """Ending and beginning of each word, and the log share of the word in their cell (or None): of one beyond the vocabulary, as spelled."""
        return self.looked_up(words, tails)[:3]

    def looked_up(self, words: list[bytes], tails: bool = False):
        """What `encode` gives, and the places of words beyond the vocabulary."""
        import numpy as np

        if not words:
            return (np.zeros(0, np.int64),) * 4
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        a, b = self.ending[ids], self.beginning[ids]
        tail = self.log_word[ids] if tails else None
        at = np.flatnonzero(ids < 0)
        if len(at):
            rare = [words[i] for i in at.tolist()]
            ra, rb, end_taken, begin_taken = self.units.of(rare)
            a[at], b[at] = ra, rb
            if tails:
                tail[at] = self._spelled(rare, ra, rb, end_taken, begin_taken)
        return a, b, tail, at

    def _spelled(self, rare, a, b, end_taken, begin_taken):
        import numpy as np

        state, symbol, first = self.units.spelled(rare, end_taken, begin_taken)
        return self.log_other[a, b] + np.add.reduceat(self.log_letter[state, symbol], first)

    def gains(self, words: list[bytes], n):
        """By how much the log shares of counted words exceed what their spelling gives, in whole parts."""
        import numpy as np

        a, b, end_taken, begin_taken = self.units.of(words)
        return np.rint((np.log(n) - self.log_cell[a, b] - self._spelled(words, a, b, end_taken, begin_taken)) * GAIN_PARTS).astype(np.int64)


class Model:
    """The network: embeddings of units, a tanh layer, and two softmaxes over logits that start at the corpus's shares."""

    def __init__(self, lexicon: Lexicon):
        import numpy as np

        self.held = self.held_places = None
        rng = np.random.default_rng(4)
        self.log_beginning = lexicon.log_beginning
        wide = 4 * SIDE * EMBEDDING
        self.shapes = [(2 * (UNITS + 1), EMBEDDING), (wide, HIDDEN), (HIDDEN,), (HIDDEN, 2 * UNITS), (2 * UNITS,)]
        self.weights = [
            rng.normal(0, 0.3, self.shapes[0]).astype(np.float32),
            rng.normal(0, 1 / math.sqrt(wide), self.shapes[1]).astype(np.float32),
            np.zeros(HIDDEN, np.float32),
            np.zeros(self.shapes[3], np.float32),
            np.concatenate([lexicon.log_ending, np.zeros(UNITS, np.float32)]),
        ]

    def flat(self):
        import numpy as np

        return np.concatenate([w.ravel() for w in self.weights])

    def set_flat(self, x) -> None:
        import numpy as np

        at = 0
        for i, shape in enumerate(self.shapes):
            n = math.prod(shape)
            # a new array: one that was pickled has a type object of its own, which numpy's fast ways do not know
            self.weights[i] = np.empty(shape, np.float32)
            self.weights[i][...] = x[at : at + n].reshape(shape)
            at += n

    @staticmethod
    def padded(a, b):
        """A text's units with marks beyond its ends; beginnings come after endings among the embeddings."""
        import numpy as np

        out = np.empty((len(a) + 2 * SIDE, 2), np.int32)
        out[:SIDE] = out[-SIDE:] = UNITS, 2 * UNITS + 1
        out[SIDE:-SIDE, 0] = a
        np.add(b, UNITS + 1, out=out[SIDE:-SIDE, 1], casting="unsafe")
        return out

    @staticmethod
    def windows(padded, first: int, last: int):
        """The units of the neighbours of the words from first to before last, not of the words themselves."""
        import numpy as np

        return np.concatenate([padded[first + d : last + d] for d in (*range(SIDE), *range(SIDE + 1, 2 * SIDE + 1))], 1)

    def buffers(self, n: int) -> list:
        """Arrays for n words that every batch uses again: fresh ones of this size cost more than what is done in them."""
        import numpy as np

        if self.held is None or len(self.held[0]) < n:
            wide = self.shapes[1][0]
            self.held = [np.empty((max(n, BATCH), k), np.float32) for k in (wide, HIDDEN, 2 * UNITS, UNITS, HIDDEN, wide)]
        return [x[:n] for x in self.held]

    def places(self, near):
        """Where the embeddings' numbers of these units stand among all, flat."""
        import numpy as np

        if self.held_places is None or len(self.held_places[1]) < near.size:
            self.held_places = np.arange(math.prod(self.shapes[0])).reshape(self.shapes[0]), np.empty((near.size, EMBEDDING), np.int64)
        each, out = self.held_places
        return np.take(each, near.reshape(-1), 0, out=out[: near.size], mode="clip").reshape(-1)

    @staticmethod
    def mine(ending, beginning):
        """Where the logits of words' own endings, then beginnings, stand among all, flat."""
        import numpy as np

        row = np.arange(len(ending)) * (2 * UNITS)
        return np.concatenate([row + ending, row + (UNITS + beginning)])

    def forward(self, near, ending, rows: int | None = None):
        """Layer inputs and a row of exponents for each word (of endings, then of beginnings given the ending), with each half's sum; products are taken of so many rows at a time, or of all."""
        import numpy as np

        e, w1, b1, w2, b2 = self.weights
        x, h, z, row, _, _ = self.buffers(len(near))
        np.take(e, near.reshape(-1), 0, out=x.reshape(-1, EMBEDDING), mode="clip")
        apart = (len(near) // rows, rows) if rows else (1, len(near))
        np.matmul(x.reshape(*apart, -1), w1, out=h.reshape(*apart, -1))
        h += b1
        np.tanh(h, out=h)
        np.matmul(h.reshape(*apart, -1), w2, out=z.reshape(*apart, -1))
        z += b2
        np.take(self.log_beginning, ending, 0, out=row, mode="clip")
        z[:, UNITS:] += row
        halves = z.reshape(-1, UNITS)
        if z.max() > 60:  # else nothing overflows
            most = halves.max(1, keepdims=True)
            halves -= np.where(most > 60, most, 0)  # of other rows nothing, so none depends on those beside it
        np.exp(halves, out=halves)
        return x, h, z, (halves.reshape(apart[0], -1, UNITS) @ np.ones(UNITS, np.float32)).reshape(-1)

    def log_units(self, near, ending, beginning, rows: int | None = None):
        """log P(ending | both sides) + log P(beginning | ending, both sides)."""
        import numpy as np

        _, _, z, total = self.forward(near, ending, rows)
        mine = np.maximum(z.reshape(-1)[self.mine(ending, beginning)].reshape(2, -1), np.float32(1e-37))
        ending, beginning = np.log(mine / total.reshape(-1, 2).T)
        return ending + beginning

    def step(self, near, ending, beginning, rate: float) -> None:
        """One step of gradient descent on a batch."""
        import numpy as np

        e, w1, b1, w2, b2 = self.weights
        x, h, z, total = self.forward(near, ending)
        *_, dh, dx = self.buffers(len(near))
        halves = z.reshape(-1, UNITS)
        halves *= (1 / total)[:, None]
        z.reshape(-1)[self.mine(ending, beginning)] -= 1
        one, rate = np.ones(len(near), np.float32), np.float32(rate / len(near))
        np.matmul(z, w2.T, out=dh)
        w2 -= rate * (h.T @ z)
        b2 -= rate * (one @ z)
        h *= h
        np.subtract(1, h, out=h)
        dh *= h
        np.matmul(dh, w1.T, out=dx)
        w1 -= rate * (x.T @ dh)
        b1 -= rate * (one @ dh)
        dx *= -8 * rate
        np.add.at(e.reshape(-1), self.places(near), dx.reshape(-1))  # faster flat

    def score(self, a, b, tail) -> float:
        """The log probability of a text with these units and shares (or their sum)."""
        return next(self.scores([(a, b, tail)]))

    def scores(self, texts):
        """The same of each text in turn."""
        import numpy as np

        for part in groups(texts, lambda x: len(x[0]), TOGETHER):
            size = np.array([len(a) for a, _, _ in part])
            wide = -(-size // ROW_STEP) * ROW_STEP
            first = wide.cumsum() - wide
            rows = -(-int(wide.sum()) // BLOCK) * BLOCK
            here = np.arange(size.sum()) + np.repeat(first - size.cumsum() + size, size)  # of each word among the rows; the others have a mark, and are not read
            padded = np.concatenate([self.padded(x, y) for x, y, _ in part])
            at, a, b = np.full(rows, SIDE), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            at[here] = np.arange(size.sum()) + np.repeat(SIDE * (2 * np.arange(len(part)) + 1), size)
            a[here], b[here] = (np.concatenate([x[k] for x in part]) for k in (0, 1))
            logs = np.zeros(rows)
            for i in range(0, rows, BLOCK):
                s = slice(i, i + BLOCK)
                near = padded[at[s, None] + np.array([d for d in range(-SIDE, SIDE + 1) if d])].reshape(BLOCK, -1)
                logs[s] = self.log_units(near, a[s], b[s], ROW_STEP)
            sums, full = np.zeros(len(part)), size > 0
            if full.any():
                sums[full] = np.add.reduceat(logs[here], (size.cumsum() - size)[full])
            yield from (float(np.sum(x[2])) + s for x, s in zip(part, sums.tolist()))


def _units(counts: DataFrame, top: list[tuple[bytes, int]]) -> Units:
    whole = [w for w, _ in top[: min(WHOLE, len(top) // 2)]]
    rest = counts.filter(~F.col("w").isin([bytearray(w) for w in whole])) if whole else counts
    parts = [F.struct(F.lit(side).alias("side"), F.when(F.length("w") >= n, F.expr(f"substring(w, {-n if side else 1}, {n})")).alias("part")) for side in (0, 1) for n in range(1, LONGEST + 1)]
    mass = rest.select("n", F.explode(F.array(*parts)).alias("p")).filter("p.part is not null").groupBy("p.side", "p.part").agg(F.sum("n").alias("n"))
    best = mass.withColumn("r", F.expr("row_number() over (partition by side order by n desc, part)")).filter(f"r < {UNITS}").orderBy("side", "r").collect()
    of = [[bytes(r.part) for r in best if r.side == side] for side in (0, 1)]
    return Units(whole, of[1][: UNITS - 1 - len(whole)], of[0][: UNITS - 1])


def _cells(counts: DataFrame, units: Units, ids: dict) -> DataFrame:
    """i, n: tokens by cell, tokens of words counted once by cell, and steps of their spelling, one after the other."""
    sent = counts.sparkSession.sparkContext.broadcast((units, ids))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        u, known = sent.value
        square = UNITS * UNITS
        out = np.zeros(2 * square + STATES * SYMBOLS, np.int64)
        for batch in batches:
            words, n = listed(batch.column(0)), batch.column(1).to_numpy()
            a, b, end_taken, begin_taken = u.of(words)
            for i, w in enumerate(words):
                if w in u.whole:
                    a[i] = u.whole[w]
            cell = a * UNITS + b
            out[:square] += np.bincount(cell, n, square).astype(np.int64)
            once = np.fromiter((k == 1 and w not in known for w, k in zip(words, n.tolist())), bool, len(words))
            out[square : 2 * square] += np.bincount(cell[once], minlength=square)
            if once.any():
                state, symbol, _ = u.spelled([w for w, k in zip(words, once.tolist()) if k], end_taken[once], begin_taken[once])
                out[2 * square :] += np.bincount(state * SYMBOLS + symbol, minlength=STATES * SYMBOLS)
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(out[at], pa.int64())], ["i", "n"])

    return counts.mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n"))


def _gains(rest: DataFrame, lex: Lexicon) -> DataFrame:
    """w, gain of counted words beyond the vocabulary (w, n)."""
    sent = rest.sparkSession.sparkContext.broadcast(lex)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            words = listed(b.column(0))
            if words:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sent.value.gains(words, b.column(1).to_numpy()), pa.int64())], ["w", "gain"])

    return staged(rest.select("w", "n").mapInArrow(run, "w binary, gain long"), "gains")


def lexicon(docs: DataFrame, vocabulary: int = VOCABULARY) -> tuple[Lexicon | None, int, DataFrame | None]:
    """What the counts of all texts say, how many words there are, and the gains of words beyond the vocabulary; None where there are none."""
    import numpy as np

    prepare(docs.sparkSession)
    counts = staged(word_counts(docs), "words")
    first = staged(counts.orderBy(F.desc("n"), "w").limit(vocabulary), "vocabulary")  # ranked by the tasks: only these reach the driver
    top = sorted(((bytes(r.w), r.n) for r in first.collect()), key=lambda x: (-x[1], x[0]))
    if not top:
        return None, 0, None
    units = _units(counts, top)
    flat = np.zeros(2 * UNITS * UNITS + STATES * SYMBOLS, np.int64)
    ids = dict.fromkeys(w for w, n in top if n == 1)
    for r in _cells(counts, units, ids).collect():
        flat[r.i] = r.n
    last, least = top[-1]
    beyond = (F.col("n") < least) | ((F.col("n") == least) & (F.col("w") > F.lit(bytearray(last))))
    cells, others = flat[: 2 * UNITS * UNITS].reshape(2, UNITS, UNITS)
    lex = Lexicon(units, top, cells, others, flat[2 * UNITS * UNITS :].reshape(STATES, SYMBOLS))
    gains = _gains(counts.filter(beyond & (F.col("n") > 1)), lex)
    freed(counts, first)
    return lex, int(cells.sum()), gains


def coded(lex: Lexicon | None, texts, tails: bool = False):
    """For some texts at a time: their numbers of words; units (and log shares) of their words in turn; and their words beyond the vocabulary, times of each and how many are named up to each text's end. Without a lexicon, texts count as empty."""
    import numpy as np

    for part in groups(texts, _characters, LOOKED_UP):
        words, at, n = distinct_words(part if lex else [None] * len(part))
        a, b, tail, rare = lex.looked_up(listed(words), tails) if lex else (np.zeros(0, np.int64),) * 4
        if not tails:
            yield n, a[at], b[at], None, None
            continue
        beyond = np.zeros(len(words), bool)
        beyond[rare] = True
        here = np.flatnonzero(beyond[at])
        named, times = np.unique(np.repeat(np.arange(len(n)), n)[here] * max(len(words), 1) + at[here], return_counts=True)
        text, word = np.divmod(named, max(len(words), 1))
        yield n, a[at], b[at], tail[at], (words.take(word), times, np.searchsorted(text, np.arange(len(n)), "right"))


def encoded(docs: DataFrame, lex: Lexicon | None, rounds: int = 1) -> DataFrame:
    """What scoring and training read of every row, written once by round: row, doc_id, n_words, share (sum of log shares), units, h, and its words beyond the vocabulary with their times."""
    sent = docs.sparkSession.sparkContext.broadcast(lex)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        working("lm_score")
        for batch in batches:
            done = 0
            for n, a, b, tail, (words, times, named) in coded(sent.value, batch.column(1).to_pylist(), tails=True):
                ends = n.cumsum()
                share = [float(tail[i:j].sum()) for i, j in zip((ends - n).tolist(), ends.tolist())]
                named = pa.array(np.append(0, named), pa.int32())
                columns = [pa.array(n, pa.int64()), pa.array(share, pa.float64()), _units_bytes(n, a, b), pa.ListArray.from_arrays(named, words), pa.ListArray.from_arrays(named, pa.array(times, pa.int32()))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(n)), batch.column(2).slice(done, len(n)), *columns], ["doc_id", "h", "n_words", "share", "units", "words", "times"])
                done += len(n)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("h"))
    made = rows.mapInArrow(run, "doc_id long, h long, n_words long, share double, units binary, words array<binary>, times array<int>")
    out = made.withColumns({"row": F.monotonically_increasing_id(), "round": F.pmod("h", F.lit(rounds))})
    return staged(out, "encoded", "round")


def _units_bytes(n, a, b):
    """An Arrow array with the units of each text's n words: endings, then beginnings."""
    import numpy as np
    import pyarrow as pa

    ends = n.cumsum()
    at = np.arange(len(a)) + np.repeat(ends - n, n)
    out = np.empty(2 * len(a), np.uint8)
    out[at], out[at + np.repeat(n, n)] = a, b
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.append(0, 2 * ends).astype(np.int32)), pa.py_buffer(out)])


def units_of(x: bytes):
    """Endings and beginnings of a text from its bytes."""
    import numpy as np

    both = np.frombuffer(x, np.uint8).astype(np.int64)
    return both[: len(both) // 2], both[len(both) // 2 :]


def train(m: Model, lex: Lexicon, texts) -> int:
    """Train on every word of the texts; the number of words."""
    return train_on(m, ((a[j - k : j], b[j - k : j]) for n, a, b, *_ in coded(lex, texts) for k, j in zip(n.tolist(), n.cumsum().tolist()) if k))


def train_on(m: Model, texts) -> int:
    """The same of the texts' units."""
    near, want, seen, held = [], [], 0, 0
    for a, b in texts:
        padded = m.padded(a, b)
        for i in range(0, len(a), POOL * BATCH):
            j = min(i + POOL * BATCH, len(a))
            near.append(m.windows(padded, i, j))
            want.append((a[i:j], b[i:j]))
            held += j - i
            if held >= POOL * BATCH:
                seen += _steps(m, near, want)
                near, want, held = [], [], 0
    return seen + (_steps(m, near, want) if held else 0)


def _steps(m: Model, near: list, want: list) -> int:
    import numpy as np

    near, a, b = np.concatenate(near), np.concatenate([x for x, _ in want]), np.concatenate([y for _, y in want])
    order = np.random.default_rng(len(a)).permutation(len(a))  # words of a text apart
    near, a, b = near[order], a[order], b[order]
    for i in range(0, len(a), BATCH):
        j = min(i + BATCH, len(a))
        m.step(near[i:j], a[i:j], b[i:j], RATE * (j - i) / BATCH)
    return len(a)


def _round(texts: DataFrame, model: Model, shards: int) -> None:
    """One round: texts (units, h) by shard, and the mean of the shards' weights as the model's own."""
    import numpy as np

    start = model.flat()

    def run(batches):
        import pyarrow as pa

        model.set_flat(start)
        seen = train_on(model, (units_of(x) for b in batches for x in b.column(0).to_pylist() if x))
        weight = -(-seen // WORDS_PER_WEIGHT)
        if weight:
            x = np.rint(model.flat().astype(np.float64) * UNIT_PARTS).astype(np.int64) * weight
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(x) + 1), pa.int32()), pa.array(np.append(x, weight), pa.int64())], ["i", "x"])

    mine = texts.withColumn("shard", F.expr(f"cast(pmod(shiftrightunsigned(h, 8), {shards}) as int)")).repartitionById(shards, "shard").sortWithinPartitions("h").select("units")
    out = np.zeros(len(start) + 1, np.float64)
    for r in mine.mapInArrow(run, "i int, x long").groupBy("i").agg(F.sum("x").alias("x")).collect():
        out[r.i] = r.x
    if out[-1]:  # else no text has its turn in this round
        start = (out[:-1] / out[-1] / UNIT_PARTS).astype(np.float32)
    model.set_flat(start)


def _fitted(docs: DataFrame, vocabulary: int, rounds: int, shard_words: int):
    """What `fit` gives, and the encoded rows; None where there are no words."""
    lex, words, gains = lexicon(docs, vocabulary)
    rows = encoded(docs, lex, rounds)
    if lex is None:
        return None, rows
    model, shards = Model(lex), -(-words // (rounds * shard_words))
    for k in range(rounds):
        _round(rows.filter((F.col("round") == k) & (F.col("n_words") > 0)).select("units", "h"), model, shards)
    return (lex, model, gains), rows


def fit(docs: DataFrame, vocabulary: int = VOCABULARY, rounds: int = ROUNDS, shard_words: int = SHARD_WORDS) -> tuple[Lexicon, Model, DataFrame] | None:
    """Count, then train: the lexicon, the model and the gains; None where there are no words."""
    fitted, rows = _fitted(docs, vocabulary, rounds, shard_words)
    freed(rows)
    return fitted


def scored(docs: DataFrame, fitted: tuple[Lexicon, Model, DataFrame] | None) -> DataFrame:
    """doc_id, n_words, log_likelihood, mean_log_likelihood of every row's whole text."""
    prepare(docs.sparkSession)
    return _scores(encoded(docs, fitted[0] if fitted else None), fitted)


def _scores(rows: DataFrame, fitted) -> DataFrame:
    """Scores of encoded rows: their units' by the model, their shares, and what counted words gain."""
    sent = rows.sparkSession.sparkContext.broadcast(fitted[1] if fitted else None)

    def run(batches):
        import pyarrow as pa

        m = sent.value
        for b in batches:
            units = b.column(3).to_pylist()
            made = m.scores((*units_of(x), s) for x, s in zip(units, b.column(4).to_pylist()) if x) if m else ()
            total = [round(next(made), 5) if x else 0.0 for x in units]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(total, pa.float64())], ["row", "doc_id", "n_words", "total"])

    made = rows.select("row", "doc_id", "n_words", "units", "share").mapInArrow(run, "row long, doc_id long, n_words long, total double")
    if fitted:
        named = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("w"), F.col("x.times").alias("times"))
        more = named.join(fitted[2], "w").groupBy("row").agg(F.sum(F.col("times") * F.col("gain")).alias("more"))
        made = made.join(more, "row", "left").withColumn("total", F.round(F.col("total") + F.coalesce("more", F.lit(0)) / GAIN_PARTS, 5))
    mean = F.when(F.col("n_words") > 0, F.col("total") / F.col("n_words"))
    return made.select("doc_id", "n_words", F.col("total").alias("log_likelihood"), mean.alias("mean_log_likelihood"))


def lm_scores(docs: DataFrame) -> DataFrame:
    fitted, rows = _fitted(docs, VOCABULARY, ROUNDS, SHARD_WORDS)
    return _scores(rows, fitted)
