"""Quality rules judged by host.

Each document is held against base rules on its own words; a host (the `source` column) gathers its documents'
failures. A host's failure rate is shrunk toward the corpus by a beta prior that is fitted to the hosts' rates
by the method of moments, and a host whose shrunk rate of some rule is above that rule's limit takes all its
documents with it: a document is kept when it passes the base rules and its host is not rejected. Small hosts
stay near the corpus rate, so a few bad pages do not condemn them.

Words are maximal runs of anything but ASCII white space. A null text has no words, so it fails the base rules.
A null source belongs to no host and gets no host verdict. With fewer than two hosts, or no spread between
them, the prior is the corpus rate with the weight of `LEAST_WEIGHT` documents. An empty table gives an empty
result. Repeated rows each count and each return, those of null id too. Texts are read whole, whatever their length.
Columns other than doc_id, source and text are not read, whatever their names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import WordHashes, prepare, remembered, shingles, staged, working

#: Base rules: fewest words, and the largest share of words in repeated 5-word windows (percent).
LEAST_WORDS, MOST_REPEATED = 10, 20
#: Rules gathered by host, with the shrunk rate above which a host goes.
HOST_RULES = {"base_failed": 0.5, "symbol_heavy": 0.5, "line_repeats": 0.5}
#: A document is heavy in symbols above so many for each word, and repeats lines above this share of its words.
SYMBOLS_PER_WORD, LINES_PER_WORD = 0.5, 0.05
#: Pseudo-documents of the prior where the hosts' spread gives none, and at least and most otherwise.
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 10_000.0
#: Hosts up to which the verdicts are broadcast; beyond it they are joined by a shuffle.
BROADCAST_HOSTS = 100_000
_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_PLAIN = "doc_id long, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def features(text: str | None, hashes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    import numpy as np

    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()
    n = len(words)
    spaces = len(raw) - sum(map(len, words))
    symbols = len(_SYMBOLS.findall(raw))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    dup = len(lines) - len(set(lines))
    repeated = 0
    if n >= 6:  # fewer words have at most one window
        grams = shingles(np.fromiter(map(hashes.__getitem__, words), np.uint64, n))
        order = np.argsort(grams, kind="stable")
        s = grams[order]
        same = s[1:] == s[:-1]
        if same.any():
            again = np.zeros(len(s), bool)
            again[1:] |= same
            again[:-1] |= same
            edge = np.zeros(n + 1, np.int64)
            at = order[again]
            np.add.at(edge, at, 1)
            np.add.at(edge, at + 5, -1)
            repeated = int((np.cumsum(edge)[:n] > 0).sum())
    return n, len(text) - spaces, symbols, dup, repeated


_hashes = remembered("host_rules", WordHashes())


def _measure(batches):
    import pyarrow as pa

    working("host_rules")
    names = [x.split()[0] for x in _PLAIN.split(", ")]
    for b in batches:
        rows = [features(t, _hashes) for t in b.column(2).to_pylist()]
        cols = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, pa.int64()) for c in cols)], names)


def rule_features(docs: DataFrame) -> DataFrame:
    """The counts of every row, and which rules it fails; one pass over the texts, without a shuffle."""
    prepare(docs.sparkSession)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(source as string) source", "text").mapInArrow(_measure, _PLAIN)
    return rows.withColumns(
        {
            "base_failed": (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
            "symbol_heavy": F.col("n_symbols") > SYMBOLS_PER_WORD * F.col("n_words"),
            "line_repeats": F.col("n_dup_lines") > LINES_PER_WORD * F.col("n_words"),
        }
    )


def host_verdicts(rows: DataFrame) -> DataFrame:
    """source, n_docs, rate_<rule> (shrunk) and host_rejected; rows has source and a boolean for each rule.

    The prior needs four sums for each rule over the hosts: one row comes to the driver.
    """
    hosts = staged(rows.filter("source is not null").groupBy("source").agg(F.count("*").alias("n_docs"), *(F.count_if(r).alias(f"k_{r}") for r in HOST_RULES)), "hosts")
    rate = {r: F.col(f"k_{r}") / F.col("n_docs") for r in HOST_RULES}
    sums = hosts.agg(F.count("*").alias("hosts"), F.sum("n_docs").alias("docs"), F.avg(1 / F.col("n_docs")).alias("inverse"), *(f(x).alias(f"{k}_{r}") for r, x in rate.items() for k, f in (("mean", F.avg), ("var", F.var_samp))), *(F.sum(f"k_{r}").alias(f"sum_{r}") for r in HOST_RULES)).first()
    shrunk = {}
    for r in HOST_RULES:
        a, b = beta_prior(sums["hosts"], sums["docs"], sums[f"sum_{r}"], sums[f"mean_{r}"], sums[f"var_{r}"], sums["inverse"])
        shrunk[f"rate_{r}"] = (F.col(f"k_{r}") + F.lit(a)) / (F.col("n_docs") + F.lit(a + b))
    bad = F.lit(False)
    for r, most in HOST_RULES.items():
        bad = bad | (F.col(f"rate_{r}") > most)
    return hosts.withColumns(shrunk).withColumn("host_rejected", bad).drop(*(f"k_{r}" for r in HOST_RULES))


def beta_prior(hosts: int, docs: int | None, failed: int | None, mean: float | None, var: float | None, inverse: float | None) -> tuple[float, float]:
    """alpha and beta by the method of moments, the sampling part of the variance taken off."""
    if not hosts or not docs:
        return LEAST_WEIGHT / 2, LEAST_WEIGHT / 2
    p = failed / docs
    weight = LEAST_WEIGHT
    if hosts > 1 and var is not None and 0 < mean < 1:
        between = var - mean * (1 - mean) * inverse
        weight = MOST_WEIGHT if between <= 0 else min(MOST_WEIGHT, max(LEAST_WEIGHT, mean * (1 - mean) / between - 1))
        p = mean
    return p * weight, (1 - p) * weight


def host_rules(docs: DataFrame) -> DataFrame:
    """Counts, base_failed, kept, and the host's shrunk rates for every row."""
    rows = staged(rule_features(docs), "rules")
    hosts = staged(host_verdicts(rows), "verdicts")
    n = hosts.limit(BROADCAST_HOSTS + 1).count()
    side = F.broadcast(hosts) if n <= BROADCAST_HOSTS else hosts
    kept = ~F.col("base_failed") & ~F.coalesce("host_rejected", F.lit(False))
    return rows.join(side, "source", "left").withColumn("kept", kept).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "source", *(f"rate_{r}" for r in HOST_RULES))
