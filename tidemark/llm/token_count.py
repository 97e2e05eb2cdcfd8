"""Token counts with a whole-token shortcut.

A piece vocabulary with byte fallback splits a text into independent pre-tokens: no piece holds a space mark
after another character, and none holds a line feed, so no merge crosses the start of a run of spaces or a
line feed. Both facts are proved over the vocabulary when a worker loads it (`Counts.__init__`). Vocabulary
strings that encode alone as one token are found at the same time; pre-tokens among them count one at once, and
only the rest is merged by the library, each distinct one once while it is remembered.

A null text counts as empty, which has no tokens. Every row gives a row; nothing is truncated. Texts with a
literal space mark, or a vocabulary for which the proof fails, are encoded whole. Rows that repeat each return, those
of null id too; an empty table gives an empty result. Columns other than doc_id and text are not read, whatever their
names.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import DataFrame

from .base import prepare, remembered, working

#: Pre-tokens remembered by a worker.
REMEMBERED = 600_000
_RUNS = re.compile(" +[^ ]*")


class Counts(dict):
    """pre-token -> tokens. A key stands for itself after a space mark; one with a leading line feed, for what follows that line feed."""

    def __init__(self, path: str):
        import sentencepiece

        super().__init__()
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        mark = "▁"
        plain = not any(mark in p.lstrip(mark) or "\n" in p for p in pieces)
        self.feed = len(sp.encode("\n"))  # the dummy space mark and the line feed
        self.sound = plain and sp.encode(" ", out_type=str) == [mark * 2] and sp.encode("x\ny") [:1] == sp.encode("x") and self.feed == 2
        words = [p[1:] for p in pieces if p[0] == mark and mark not in p[1:] and len(p) > 1]
        self.whole = {w: 1 for w, ids in zip(words, sp.encode(words)) if len(ids) == 1}
        self.whole[""] = 1  # a space mark alone
        self.update(self.whole)

    def clear(self) -> None:
        super().clear()
        self.update(self.whole)

    def learn(self, keys: set[str]) -> None:
        """Merge what is not known yet, in one call of the library."""
        if len(self) > REMEMBERED:
            self.clear()
        new = [k for k in keys if k not in self]
        for k, ids in zip(new, self.sp.encode(new, num_threads=1)):
            self[k] = len(ids) - (self.feed if k[:1] == "\n" else 0)

    def split(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens to look up, and the tokens already counted."""
        if not text:
            return [], 0
        if not self.sound or "▁" in text:
            return [], len(self.sp.encode(text))
        if "  " in text or text[0] == " " or text[-1] == " ":
            parts = [x[1:] for x in _RUNS.findall(" " + text)]
        else:
            parts = text.split(" ")
        if "\n" not in text:
            return parts, 0
        flat: list[str] = []
        for p in parts:
            if "\n" in p:
                head, *tail = p.split("\n")
                flat.append(head)
                flat += ["\n" + x for x in tail if x]
            else:
                flat.append(p)
        return flat, text.count("\n")

    def of(self, texts: list[str]) -> list[int]:
        split = [self.split(t) for t in texts]
        self.learn(set().union(*(p for p, _ in split)))
        get = self.__getitem__
        return [n + sum(map(get, p)) for p, n in split]


@functools.cache
def counts(path: str) -> Counts:
    return remembered("token_count", Counts(path))


def token_counts(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row's whole text, for the sentencepiece model at path."""
    prepare(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        working("token_count")
        c = counts(path)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            n = c.of(texts)
            size = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
