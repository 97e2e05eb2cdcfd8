"""Language identification by hyperdimensional profiles.

Every symbol (a letter in lower case, or a word's edge) has a random bipolar vector of `DIM` entries, fixed by
its code point. A trigram is bound from its letters: the first letter's vector rotated twice, times the second's
rotated once, times the third's. A document bundles its trigrams: their vectors weighted by how often they occur,
added up. A language's prototype bundles the signs of its documents' bundles. A document gets the language whose
prototype has the largest cosine with its bundle.

Prototypes are integer sums, so they do not depend on the order of rows or partitions; each partition adds up its
own before the sums meet (a row for each language and partition). The sample they are fitted on is bounded: at most
about `FIT_DOCS` labelled documents of a language, picked by a hash of the id, of the `FIT_LANGUAGES` languages with
the most labels (a column of dirty labels reaches neither the driver nor the plan).

A null text, or one without a letter (of any plane of Unicode), is `und` with score 0. Documents of null language or id
are not learned from; neither are `und` texts. With nothing to learn from, every document is `und`. Equal cosines go to
the language that sorts first. Every row returns once, repeated rows as often as they come; an empty table gives an
empty result. Whole texts are read, in blocks. Columns other than doc_id, text and lang are not read by `identify`, and
`keep_known` carries all of them along, whatever their names.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import crc_of_id, prepare, remembered, working

DIM = 1024
#: Labelled documents of a language that its prototype is fitted on, about.
FIT_DOCS = 10_000
#: Languages at most that are learned, those with the most labels.
FIT_LANGUAGES = 1_000
UNKNOWN = "und"
#: Best cosines under this are those of unrelated vectors, whose spread is 1 / sqrt(DIM). Of the documents of sf0.1 2 in 10,000 are
#: below, of random letters in scripts that no document has 99 in 100, of single words 3 in 10.
LEAST_SCORE = 3 / 32
#: Characters of a text that are counted at a time.
BLOCK = 1 << 20


@functools.cache
def symbol(code: int):
    """The bipolar vector of a symbol; 0 is a word's edge."""
    import numpy as np

    return np.random.default_rng([7919, code]).integers(0, 2, DIM, dtype=np.int8) * np.int8(2) - np.int8(1)


class Trigrams(dict):
    """code of a trigram -> its bound vector, kept up to a bound."""

    def __missing__(self, code: int):
        import numpy as np

        if len(self) > 16_000:
            self.clear()
        a, b, c = code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF
        v = self[code] = np.roll(symbol(a), 2) * np.roll(symbol(b), 1) * symbol(c)
        return v


_trigrams = remembered("langid", Trigrams())


@functools.cache
def _folding():
    """By code point, in all planes: the lower-case letter's code point, or 0 where there is no letter."""
    import sys

    import numpy as np

    out = np.zeros(sys.maxunicode + 1, np.int32)
    for i in range(len(out)):
        ch = chr(i)
        if ch.isalpha():
            low = ch.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def trigram_codes(text: str):
    """The codes of a text's trigrams in turn, words apart by one edge."""
    import numpy as np

    fold = _folding()
    parts, last = [], np.zeros(1, np.int64)
    for i in range(0, len(text), BLOCK):
        points = np.frombuffer(text[i : i + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = fold[points].astype(np.int64)
        s = np.concatenate([last, letters])
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] != 0) | (s[:-1] != 0)  # one edge between words
        keep[: len(last)] = True
        s = s[keep]
        parts.append(s[:-2] << 42 | s[1:-1] << 21 | s[2:])
        last = s[-2:]
    if not parts:
        return np.zeros(0, np.int64)
    if last[-1] != 0 and len(last) > 1:
        parts.append(np.array([int(last[-2]) << 42 | int(last[-1]) << 21], np.int64))
    out = np.concatenate(parts)
    return out[out != 0]


def bundles(texts: list[str | None]):
    """The bundle of each text (rows of float32; zeros where there is no letter)."""
    import numpy as np

    out = np.zeros((len(texts), DIM), np.float32)
    for i in range(0, len(texts), 64):
        codes = [trigram_codes(t) if t else np.zeros(0, np.int64) for t in texts[i : i + 64]]
        flat = np.concatenate(codes)
        if not len(flat):
            continue
        known, at = np.unique(flat, return_inverse=True)
        doc = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        for lo in range(0, len(known), 8192):  # blocks of trigrams, for texts in many scripts
            hi = min(lo + 8192, len(known))
            mine = (at >= lo) & (at < hi) if len(known) > 8192 else slice(None)
            n = np.bincount(doc[mine] * (hi - lo) + at[mine] - lo, minlength=len(codes) * (hi - lo)).reshape(len(codes), hi - lo)
            out[i : i + len(codes)] += n.astype(np.float32) @ np.stack([_trigrams[int(k)] for k in known[lo:hi]]).astype(np.float32)
    return out


def fit(labelled: DataFrame) -> list[tuple[str, list[int]]]:
    """Prototypes (language, integer vector) of rows (text, lang); one row for each language comes to the driver."""

    def add(batches):
        import numpy as np
        import pyarrow as pa

        working("langid")
        sums: dict[str, object] = {}
        for b in batches:
            v = np.sign(bundles(b.column(0).to_pylist())).astype(np.int64)
            langs = np.array(b.column(1).to_pylist(), dtype=object)
            for lang in set(langs.tolist()):
                sums[lang] = sums.get(lang, 0) + v[langs == lang].sum(0)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], ["lang", "v"])

    prepare(labelled.sparkSession)
    part = labelled.select("text", "lang").mapInArrow(add, "lang string, v array<long>")
    total = part.selectExpr("lang", "posexplode(v) as (i, x)").groupBy("lang", "i").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v"))
    return sorted((r.lang, [x.x for x in r.v]) for r in total.collect() if any(x.x for x in r.v))


def training_rows(docs: DataFrame, fit_docs: int = FIT_DOCS, languages: int = FIT_LANGUAGES) -> DataFrame:
    """Labelled rows to learn from: remainder not 1, at most about fit_docs of each of the languages with the most labels.

    Labels are counted without reading texts.
    """
    rows = docs.select("doc_id", "text", "lang").filter("lang is not null").filter(crc_of_id("doc_id") % 3 != 1)
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    share = counts.select(F.col("lang").alias("known"), F.greatest(F.lit(1), F.expr(f"{fit_docs} * 1000000L div n")).alias("share"))
    pick = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000))
    return rows.join(F.broadcast(share), (F.col("lang") == F.col("known")) & (pick < F.col("share"))).filter("text is not null").select("text", "lang")


def identify(docs: DataFrame, prototypes: list[tuple[str, list[int]]]) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; only the text decides."""
    prepare(docs.sparkSession)
    names = [k for k, _ in prototypes]
    vectors = [v for _, v in prototypes]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        working("langid")
        p = np.array(vectors, np.float64).reshape(len(names), DIM)
        p = (p / np.maximum(np.linalg.norm(p, axis=1, keepdims=True), 1e-12)).T
        for b in batches:
            v = bundles(b.column(2).to_pylist()).astype(np.float64)
            size = np.linalg.norm(v, axis=1)
            cos = v @ p / np.maximum(size, 1e-12)[:, None] if names else np.zeros((len(v), 1))
            best = cos.argmax(1)
            known = (size > 0) & bool(names)
            score = np.where(known, np.clip(cos.max(1), 0, 1).round(9), 0.0)
            pred = [names[k] if ok else UNKNOWN for k, ok in zip(best, known)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(crc_of_id("doc_id") % 3 == 1, F.lit(False)).alias("held_out")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, prototypes: list[tuple[str, list[int]]], least: float = LEAST_SCORE) -> DataFrame:
    """The rows of docs with a language, with all their columns; a score under `least` is no language."""
    prepare(docs.sparkSession)
    at = docs.columns.index("text")
    names, vectors = [k for k, _ in prototypes], [v for _, v in prototypes]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        working("langid")
        p = np.array(vectors, np.float64).reshape(len(names), DIM)
        p = (p / np.maximum(np.linalg.norm(p, axis=1, keepdims=True), 1e-12)).T
        for b in batches:
            v = bundles(b.column(at).to_pylist()).astype(np.float64)
            size = np.linalg.norm(v, axis=1)
            ok = (size > 0) & ((v @ p).max(1) >= least * size) if names else size < 0
            yield b.filter(pa.array(ok, pa.bool_()))

    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # any name may stand in a table
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def language_id(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    return identify(docs, fit(training_rows(docs)))
