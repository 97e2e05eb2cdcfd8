"""Conversation structure repair: the cheapest edits that give every conversation turns of `(s?(ua)+)?`.

A dynamic programme runs backward over the turns of a conversation and the four states of the grammar (nothing yet,
after the system turn, after a user turn, after an assistant turn) and gives the cost to go from each. A forward walk
then takes, among the edits that keep to that cost, the one whose initial comes first in ASCII (Delete, Insert, Keep,
Rerole), and the turns are rebuilt for hashing. In a state the grammar leaves one role to insert or to give, so an
audit string names one repair.

Rows are dealt to ranges of (conversation, turn, role, digest) at sampled quantiles, so that a conversation which holds
a third of all rows is split like any other. Conversations that lie inside a range are finished there. A range's first
and last one may go on in its neighbours: of these, each piece gives the min-plus matrix of its costs between states;
the matrices of a conversation's pieces (one a range at most) give the costs to go at their ends, walks from each of
the four states give what a piece leads to, and these chain into the one walk. SHA-256 of a conversation is sequential
by definition: the repaired lines of a split one stream through a task in order, and nothing is gathered but its audit.

A null role or text counts as one space, so a null text is blank and a null role has to be changed; a role without a
character cannot be kept. Turns that are null come first. Rows of one turn are taken by role, then by digest of role and
text; rows that repeat are duplicates. A null conv_id is a conversation of its own. A conversation whose rows are all
dropped by the damage returns zeros, an empty audit and the hash of an empty string; an empty table returns nothing.
Texts are read whole, whatever their length. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import ASCII_SPACE, prepare, staged

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: By state, the state after the turn that comes next, and that turn's role.
AFTER, ROLE = (USER, USER, ASSISTANT, USER), ("user", "user", "assistant", "user")
NEVER = 1 << 60
LEGAL = {"su", "ua", "au"}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_RESULT = ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
#: Rows, and characters of text, after which a task hands on what it has.
OUT_ROWS, OUT_CHARS = 1024, 8_000_000


def damaged(turns: DataFrame, kinds: int = 20) -> DataFrame:
    """conv_id, turn, role, text of a corrupted copy, and gone: 0 of crc32(conv_id:turn) % kinds drops a row, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes it the user's."""
    key = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in ("conv_id", ":", "turn")))
    kind = F.crc32(key) % kinds
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("__copy"),
    ).drop("__copy")


def _open_to_inserts(v):
    user, assistant = min(v[USER], v[ASSISTANT] + INSERT), min(v[ASSISTANT], v[USER] + INSERT)
    return min(v[START], user + INSERT), min(v[SYSTEM], user + INSERT), user, assistant


#: Cost to go by state after the last turn of a conversation: nothing at all, or a whole pair, may stand there.
END = _open_to_inserts((0, NEVER, NEVER, 0))


def costs_to_go(codes: str, end=END) -> list[tuple[int, int, int, int]]:
    """Cost to go by state before each turn and after the last; codes as `Piece` gives them."""
    out = [end]
    for c in reversed(codes):
        v = out[-1]
        best = [x + DELETE for x in v]
        if c != "x":
            role = c.lower()
            own = TRUNCATED if c != role else 0
            for s in range(4):
                best[s] = min(best[s], own + (0 if role == ROLE[s][0] else REROLE) + v[AFTER[s]])
            if role == "s":
                best[START] = min(best[START], own + v[SYSTEM])
        out.append(_open_to_inserts(best))
    return out[::-1]


def walk(codes: str, costs, state: int = START, last: bool = True) -> tuple[str, int]:
    """The ASCII-least edits among those that keep to the costs, and the state they lead to; last: inserts may follow the turns."""
    edits, i, n = [], 0, len(codes)
    while True:
        here = costs[i][state]
        if i < n and costs[i + 1][state] + DELETE == here:
            edits.append("D")
        elif (i < n or last) and costs[i][AFTER[state]] + INSERT == here:
            edits.append("I")
            state = AFTER[state]
            continue
        elif i == n:
            return "".join(edits), state
        else:
            role = codes[i].lower()
            own = TRUNCATED if codes[i] != role else 0
            if role == ROLE[state][0] and costs[i + 1][AFTER[state]] + own == here:
                edits.append("K")
                state = AFTER[state]
            elif state == START and role == "s" and costs[i + 1][SYSTEM] + own == here:
                edits.append("K")
                state = SYSTEM
            else:
                edits.append("R")
                state = AFTER[state]
        i += 1


def rebuilt(edits: str, rows: Iterable[tuple[str, str]]) -> Iterator[str]:
    """role:text of the turns that the edits make of a whole conversation's (role, text) rows."""
    made = Rebuilding()
    made.plan(edits, START)
    for r in rows:
        yield from made.row(*r)
    yield from made.rest()


class Rebuilding:
    """Turns made by edits, row by row: plan names the edits of a piece and the state they begin in."""

    def __init__(self):
        self.edits, self.at, self.state = "", 0, START

    def plan(self, edits: str, state: int) -> None:
        self.edits, self.at, self.state = edits, 0, state

    def rest(self) -> Iterator[str]:
        """The turns inserted before the next row."""
        while self.edits[self.at : self.at + 1] == "I":
            yield ROLE[self.state] + ":"
            self.state = AFTER[self.state]
            self.at += 1

    def row(self, role: str, text: str) -> Iterator[str]:
        yield from self.rest()
        edit = self.edits[self.at]
        self.at += 1
        if edit != "D":
            yield f"{role if edit == 'K' else ROLE[self.state]}:{text}"
            self.state = SYSTEM if edit == "K" and self.state == START and role[0] == "s" else AFTER[self.state]


class Piece:
    """Turns of one conversation in order: a code for each (its role's initial, o for any other; upper case if truncated; x if it has to go) and counts."""

    def __init__(self, seen: set[bytes] | None = None):
        self.seen = set() if seen is None else seen
        self.codes: list[str] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.first_turn = self.last_turn = None

    def add(self, turn, role: str, text: str, key: bytes) -> None:
        bare = text.strip(ASCII_SPACE)
        code = role[0] if role[:1] in ("s", "u", "a") else "o"
        if not bare:
            self.blank += 1
            code = "x"
        elif key in self.seen:
            self.duplicate += 1
            code = "x"
        elif bare[-1] not in ".!?":
            self.truncated += 1
            code = code.upper()
        self.seen.add(key)
        self.codes.append(code)
        if self.first is None:
            self.first = role[:1]
        elif self.last + role[:1] not in LEGAL:
            self.illegal += 1
        self.last = role[:1]
        if turn is not None:
            if self.turns == 0:
                self.first_turn = turn
            self.turns += self.turns == 0 or turn != self.last_turn
            self.last_turn = turn


def _gaps(first, last, turns: int) -> int:
    return last - first + 1 - turns if turns else 0


def _whole(rows) -> tuple:
    """The result of a conversation, of its (turn, role, text, key) rows in order."""
    p = Piece()
    for r in rows:
        p.add(*r)
    codes = "".join(p.codes)
    costs = costs_to_go(codes)
    audit, _ = walk(codes, costs)
    made = "\n".join(rebuilt(audit, ((r[1], r[2]) for r in rows)))
    return _gaps(p.first_turn, p.last_turn, p.turns), p.blank, p.duplicate, p.truncated, p.illegal, costs[0][START], audit, hashlib.sha256(made.encode()).hexdigest()


def _batch(rows: list[tuple], schema):
    import pyarrow as pa

    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _arrow(schema):
    """The Arrow schema of a Spark one."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


_ROW = ("turn", "role", "text", "key")


def _finish(schema):
    """Finish the conversations that lie inside a range; hand on the rows of its first and last one."""

    def run(batches):
        from pyspark import TaskContext

        part, out, chars = TaskContext.get().partitionId(), [], 0
        none, piece, at = object(), 2 * part, 0
        now, rows, first = none, [], True

        def handed(conv, rows, piece, at):
            return [(False, conv, piece, at + i, *r, *[None] * 8) for i, r in enumerate(rows)]

        for b in batches:
            for conv, turn, role, text, gone, key in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone", "key"))):
                if now is not none and conv != now:
                    if not first:
                        out.append((True, now, None, None, *[None] * 4, *_whole([r for r in rows if r[1] is not None])))
                    rows, first = [], False
                now = conv
                row = (turn, None, None, None) if gone else (turn, role, text, key)
                if first:  # it may have begun in an earlier range: its rows go on as they come
                    out += handed(conv, [row], piece, at)
                    at += 1
                else:
                    rows.append(row)
                chars += len(text)
                if len(out) >= OUT_ROWS or (out and chars >= OUT_CHARS):
                    yield _batch(out, schema)
                    out, chars = [], 0
        if not first:  # it may go on in the next range
            for i in range(0, len(rows), OUT_ROWS):
                out += handed(now, rows[i : i + OUT_ROWS], piece + 1, i)
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    return run


def _summary(schema):
    """Codes, counts and cost matrix of a piece; rows that stand before its own name digests of earlier pieces."""

    def run(table):
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("at", *_ROW))), key=lambda r: r[0])
        p = Piece({r[4] for r in rows if r[0] < 0})
        for at, *r in rows:
            if at >= 0 and r[1] is not None:
                p.add(*r)
        codes = "".join(p.codes)
        matrix = [costs_to_go(codes, tuple(0 if s == to else NEVER for s in range(4)))[0] for to in range(4)]
        import pyarrow as pa

        return pa.Table.from_batches([_batch([(table.column("conv_id")[0].as_py(), table.column("piece")[0].as_py(), codes, [min(matrix[to][s], NEVER) for s in range(4) for to in range(4)], p.blank, p.duplicate, p.truncated, p.illegal, p.first, p.last, p.first_turn, p.last_turn, p.turns)], schema)])

    return run


def _ends(schema):
    """By piece of a conversation, the costs to go at its end."""

    def run(table):
        import pyarrow as pa

        rows = sorted(zip(table.column("piece").to_pylist(), table.column("matrix").to_pylist()), reverse=True)
        out, end = [], END
        for i, (piece, m) in enumerate(rows):
            out.append((piece, list(end), i == 0))
            end = tuple(min(m[4 * s + to] + end[to] for to in range(4)) for s in range(4))
        return pa.Table.from_batches([_batch(out, schema)])

    return run


def _walks(schema):
    """By piece, the edits and the state they lead to from each of the four states."""

    def run(batches):
        for b in batches:
            out = []
            for piece, codes, end, last in zip(*(b.column(c).to_pylist() for c in ("piece", "codes", "end", "final"))):
                costs = costs_to_go(codes, tuple(end))
                ways = [walk(codes, costs, s, last) if costs[0][s] < NEVER else ("", START) for s in range(4)]
                out.append((piece, [w[0] for w in ways], [w[1] for w in ways], costs[0][START]))
            yield _batch(out, schema)

    return run


def _chain(schema):
    """By piece, the state that the walk enters it in; with the last one, the conversation's counts."""

    def run(table):
        import pyarrow as pa

        rows = sorted(table.to_pylist(), key=lambda r: r["piece"])
        total = {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated", "illegal")}
        here = [r for r in rows if r["first"] is not None]
        total["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(here, here[1:]))
        timed = [r for r in rows if r["turns"]]
        turns = sum(r["turns"] for r in timed) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(timed, timed[1:]))
        total |= {"gaps": _gaps(timed[0]["first_turn"], timed[-1]["last_turn"], turns) if timed else 0, "cost": rows[0]["start_cost"]}
        out, state = [], START
        for i, r in enumerate(rows):
            out.append((r["conv_id"], r["piece"], state, *((total[c] if i + 1 == len(rows) else None) for c in COUNTS)))
            state = r["exits"][state]
        return pa.Table.from_batches([_batch(out, schema)])

    return run


def _hashed(schema):
    """Results of split conversations, of their rows in order, each piece after its plan; the lines stream into the hash."""

    def run(batches):
        none = object()
        now, digest, audit, counts, began, made = none, None, [], None, False, Rebuilding()

        def took(lines):
            nonlocal began
            for line in lines:
                digest.update((b"\n" if began else b"") + line.encode())
                began = True

        for b in batches:
            out = []
            for conv, at, role, text, state, edits, *totals in zip(*(b.column(c).to_pylist() for c in ("conv_id", "at", "role", "text", "state", "edits", *COUNTS))):
                if now is none or conv != now:
                    if now is not none:
                        took(made.rest())
                        out.append((now, *counts, "".join(audit), digest.hexdigest()))
                    now, digest, audit, began = conv, hashlib.sha256(), [], False
                    made = Rebuilding()
                if at < 0:
                    took(made.rest())
                    made.plan(edits, state)
                    audit.append(edits)
                    counts = totals
                elif role is not None:
                    took(made.row(role, text))
            if out:
                yield _batch(out, schema)
        if now is not none:
            took(made.rest())
            yield _batch([(now, *counts, "".join(audit), digest.hexdigest())], schema)

    return run


def repaired(turns: DataFrame) -> DataFrame:
    """conv_id, counts of faults, cost, audit and repaired_sha256 of every conversation of (conv_id, turn, role, text, and perhaps gone: whether a row only names its conversation)."""
    spark = prepare(turns.sparkSession)
    conv, turn = (turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    plain = turns.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")), (F.coalesce("gone", F.lit(False)) if "gone" in turns.columns else F.lit(False)).alias("gone"))
    keyed = plain.withColumn("key", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    order = ("conv_id", "turn", "role", "key", "gone")
    dealt = keyed.select("conv_id", "turn", "role", F.when(F.col("gone"), "").otherwise(F.col("text")).alias("text"), "gone", "key").repartitionByRange(*order).sortWithinPartitions(*order)
    rows = f"conv_id {conv}, piece long, at long, turn {turn}, role string, text string, key binary"

    def arrow(ddl: str):
        return _arrow(spark.createDataFrame([], ddl).schema)

    first = f"whole boolean, {rows}, {_RESULT}"
    done = staged(dealt.mapInArrow(_finish(arrow(first)), first), "turns")
    split = done.filter("not whole").select("conv_id", "piece", "at", *_ROW)
    # digests that an earlier piece of the conversation has: a row a piece for each at most
    digests = split.filter("key is not null").select("conv_id", "piece", "key").distinct()
    earlier = digests.groupBy(F.col("conv_id").alias("__conv"), F.col("key").alias("__key")).agg(F.min("piece").alias("__first"), F.count("*").alias("__n")).filter("__n > 1")
    again = digests.join(earlier, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("key") == F.col("__key")) & (F.col("piece") > F.col("__first")))
    named = again.select("conv_id", "piece", F.lit(-1).cast("long").alias("at"), F.lit(None).cast(turn).alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "key")
    kinds = f"conv_id {conv}, piece long, codes string, matrix array<long>, blank long, duplicate long, truncated long, illegal long, first string, last string, first_turn {turn}, last_turn {turn}, turns long"
    pieces = staged(split.unionByName(named).groupBy("piece").applyInArrow(_summary(arrow(kinds)), kinds), "pieces")
    kind = "piece long, end array<long>, final boolean"
    ends = pieces.select("conv_id", "piece", "matrix").groupBy("conv_id").applyInArrow(_ends(arrow(kind)), kind)
    kind = "piece long, ways array<string>, exits array<int>, start_cost long"
    walks = staged(pieces.select("piece", "codes").join(ends, "piece").mapInArrow(_walks(arrow(kind)), kind), "walks")
    kind = f"conv_id {conv}, piece long, state int, " + ", ".join(f"{c} long" for c in COUNTS)
    states = pieces.drop("codes", "matrix").join(walks.drop("ways"), "piece").groupBy("conv_id").applyInArrow(_chain(arrow(kind)), kind)
    plans = states.join(walks.select("piece", "ways"), "piece").select("conv_id", "piece", F.lit(-1).cast("long").alias("at"), "state", F.get("ways", "state").alias("edits"), *COUNTS)
    kind = f"conv_id {conv}, {_RESULT}"
    lines = split.select("conv_id", "piece", "at", "role", "text").unionByName(plans, allowMissingColumns=True)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = lines.repartition(n, "conv_id").sortWithinPartitions("conv_id", "piece", "at")
    columns = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    return done.filter("whole").select(*columns).unionByName(ordered.mapInArrow(_hashed(arrow(kind)), kind).select(*columns))
