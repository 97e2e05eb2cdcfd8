"""Masked pseudo-likelihood against a model in plain Python, and what training must do."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from tables import DATA

from tidemark.llm import lm_score as L

PATTERNS = [(f"l{k}", f"m{k}", f"r{k}") for k in range(6)]


def corpus(n=150, seed=1, turns=40):
    rng = random.Random(seed)
    return [(i, " ".join(w for _ in range(turns) for w in rng.choice(PATTERNS))) for i in range(n)]


def odd_corpus():
    rng = random.Random(9)
    words = ["the", "of", "café", "naïve", "a", "日本語", "running", "singing", "b"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(30))) for i in range(40)]
    return rows + [(100 + i, f"The rare{i % 7} once{i} Zweimal{i % 5}\x0bof x{i}x") for i in range(20)] + [(200, None), (201, ""), (202, "x"), (203, "\x1c"), (204, "aa aaa aaaa a")]


def units_of(word, units):
    """Ending, beginning, and their bytes, by trying every length."""
    if word in units.whole:
        end, end_taken = units.whole[word], 0
    else:
        first, side = units.sides[0]
        end, end_taken = first, 0
        for n, (codes, ids) in enumerate(side, 1):
            for c, u in zip(codes.tolist(), ids.tolist()):
                if len(word) >= n and word.endswith(c.to_bytes(n, "little")[::-1]):
                    end, end_taken = u, n
    first, side = units.sides[1]
    begin, begin_taken = first, 0
    for n, (codes, ids) in enumerate(side, 1):
        for c, u in zip(codes.tolist(), ids.tolist()):
            if len(word) >= n and word.startswith(c.to_bytes(n, "little")):
                begin, begin_taken = u, n
    return end, begin, end_taken, begin_taken


def spelling(word, end_taken, begin_taken):
    """(state, symbol) steps of the bytes between beginning and ending."""
    middle = word[begin_taken : len(word) - end_taken] if begin_taken + end_taken <= len(word) else b""
    overlap = max(0, begin_taken + end_taken - len(word))
    states = [256, *middle]
    return list(zip(states, [*middle, 256 + overlap]))


def brute_force(rows, fitted, vocabulary):
    """Scores from the definitions: counts by Counter, one word and one neighbour at a time."""
    lex, m, _ = fitted
    words = {d: (t or "").lower().encode().split() for d, t in rows}
    n = Counter(w for d, _ in rows for w in words[d])
    top = set(sorted(n, key=lambda w: (-n[w], w))[:vocabulary])
    cells, others, letters = Counter(), Counter(), Counter()
    for w, k in n.items():
        end, begin, e, b = units_of(w, lex.units)
        cells[end, begin] += k
        if k == 1 and w not in top:
            others[end, begin] += 1
            letters.update(spelling(w, e, b))
    E, w1, b1, w2, b2 = (x.astype(np.float64) for x in m.weights)
    out = {}
    for d, _ in rows:
        text, total = words[d], 0.0
        coded = [units_of(w, lex.units) for w in text]
        for i, w in enumerate(text):
            end, begin, e, b = coded[i]
            x = []
            for j in (i - 2, i - 1, i + 1, i + 2):
                x += [*E[coded[j][0]], *E[L.UNITS + 1 + coded[j][1]]] if 0 <= j < len(text) else [*E[L.UNITS], *E[2 * L.UNITS + 1]]
            z = np.tanh(np.array(x) @ w1 + b1) @ w2 + b2
            row = [math.log((cells[end, k] + 1) / sum(cells[end, j] + 1 for j in range(L.UNITS))) for k in range(L.UNITS)]
            for logits, k in ((z[: L.UNITS], end), (z[L.UNITS :] + row, begin)):
                total += logits[k] - math.log(sum(math.exp(v) for v in logits))
            cell = cells[end, begin] + 1
            if w in top:
                total += math.log(n[w] / cell)
            elif n[w] > 1:
                total += math.log(n[w] / cell)
            else:
                total += math.log((others[end, begin] + 1) / cell)
                for state, symbol in spelling(w, e, b):
                    total += math.log((letters[state, symbol] + 0.01) / (sum(letters[state, s] for s in range(L.SYMBOLS)) + 0.01 * L.SYMBOLS))
        out[d] = (len(text), total)
    return out


@pytest.mark.parametrize("vocabulary", [4, 12, 1000])
def test_scores_against_a_model(frame, vocabulary):
    rows = odd_corpus()
    docs = frame(rows)
    fitted = L.fit(docs, vocabulary, rounds=3, shard_words=500)
    want = brute_force(rows, fitted, vocabulary)
    got = {r.doc_id: r for r in L.scored(docs, fitted).collect()}
    assert {d: r.n_words for d, r in got.items()} == {d: n for d, (n, _) in want.items()}
    for d, (n, total) in want.items():
        assert got[d].log_likelihood == pytest.approx(total, rel=1e-4, abs=1e-4)
        assert (got[d].mean_log_likelihood is None) == (n == 0)


def test_probabilities_of_a_place_add_up(frame):
    docs = frame(odd_corpus())
    lex, m, gains = L.fit(docs, 12, rounds=2)
    rng = np.random.default_rng(2)
    near = np.stack([rng.integers(0, L.UNITS, 4), rng.integers(L.UNITS + 1, 2 * L.UNITS + 1, 4)], 1).reshape(1, 8)
    grid = [(a, b) for a in range(L.UNITS) for b in range(L.UNITS)]
    a, b = np.array(grid).T
    cell = np.exp(m.log_units(np.repeat(near, len(grid), 0), a, b).astype(np.float64)).reshape(L.UNITS, L.UNITS)
    assert cell.sum() == pytest.approx(1, abs=1e-4)
    known = np.zeros((L.UNITS, L.UNITS))
    for i, w in enumerate(lex.ids):
        known[lex.ending[i], lex.beginning[i]] += math.exp(lex.log_word[i])
    counted = [w for w, k in Counter(w for _, t in odd_corpus() for w in L.words_of(t)).items() if k > 1 and w not in lex.ids]
    ra, rb, tails = lex.encode(counted, True)
    gain = {bytes(r.w): r.gain / L.GAIN_PARTS for r in gains.collect()}
    assert set(gain) == set(counted)
    for w, x, y, t in zip(counted, ra, rb, tails):
        known[x, y] += math.exp(t + gain[w])
    assert (known + np.exp(lex.log_other) <= 1 + 1e-6).all(), "a cell's words and the rest of it are at most the cell"


def test_step_follows_the_gradient(frame):
    lex, *_ = L.lexicon(frame(corpus(5)))
    m = L.Model(lex)
    rng = np.random.default_rng(3)
    m.weights = [(w + rng.normal(0, 0.2, w.shape)).astype(np.float64) for w in m.weights]
    m.log_beginning = m.log_beginning.astype(np.float64)
    m.held = [np.empty((m_, k)) for m_, k in ((16, m.shapes[1][0]), (16, L.HIDDEN), (16, 2 * L.UNITS), (16, L.UNITS), (16, L.HIDDEN), (16, m.shapes[1][0]))]
    near = np.concatenate([rng.integers(0, L.UNITS + 1, (7, 1)) if i % 2 == 0 else rng.integers(L.UNITS + 1, 2 * L.UNITS + 2, (7, 1)) for i in range(8)], 1)
    a, b = rng.integers(0, L.UNITS, 7), rng.integers(0, L.UNITS, 7)
    before = [w.copy() for w in m.weights]

    def loss():
        return -m.log_units(near, a, b).mean()

    m.step(near, a, b, 1e-3)
    moved = [(w - x) / -1e-3 for w, x in zip(m.weights, before)]
    for k, scale in ((0, 8), (1, 1), (2, 1), (3, 1), (4, 1)):
        flat = np.argsort(-np.abs(moved[k].ravel()))[:5]
        for i in flat:
            m.weights = [x.copy() for x in before]
            m.weights[k].ravel()[i] += 1e-4
            up = loss()
            m.weights[k].ravel()[i] -= 2e-4
            assert moved[k].ravel()[i] / scale == pytest.approx((up - loss()) / 2e-4, rel=2e-2, abs=1e-4)


def test_model_learns_from_both_sides(frame):
    rows = corpus(200)
    rng = random.Random(5)
    shuffled = [(1000 + i, " ".join(rng.sample(t.split(), len(t.split())))) for i, (_, t) in enumerate(rows[:20])]
    fitted = L.fit(frame(rows), shard_words=3000)
    good = [r.mean_log_likelihood for r in L.scored(frame(corpus(20, seed=8)), fitted).collect()]
    bad = [r.mean_log_likelihood for r in L.scored(frame(shuffled), fitted).collect()]
    assert np.mean(good) > np.mean(bad) + 0.3
    lex, m, _ = fitted
    a, b, _ = lex.encode(rows[0][1].encode().split())
    near = m.windows(m.padded(a, b), 0, 10)
    assert near.shape == (10, 8) and near[5].tolist() == [x for j in (3, 4, 6, 7) for x in (a[j], L.UNITS + 1 + b[j])], "the word itself is masked"


def test_held_out_gain_over_the_unigram_model(spark):
    docs = spark.read.parquet(str(DATA / "sf0.01/documents.parquet"))
    held = docs.filter("crc32(cast(doc_id as string)) % 5 = 0")
    fitted = L.fit(docs.filter("crc32(cast(doc_id as string)) % 5 <> 0"))
    untrained = L.Model(fitted[0])  # its logits are the corpus's shares whatever the neighbours

    def mean(f):
        return L.scored(held, f).selectExpr("sum(log_likelihood) / sum(n_words)").first()[0]

    assert mean(fitted) > mean((fitted[0], untrained, fitted[2])) + 0.5


def test_every_word_is_predicted_once_in_training(frame, monkeypatch):
    texts = [[f"t{i}w{k}" for k in range(n)] for i, n in enumerate([1, 2, 7, 8, 9, 64, 64, 3000, 20_000])]
    lex, words, _ = L.lexicon(frame([(i, " ".join(t)) for i, t in enumerate(texts)]))
    assert words == sum(map(len, texts))
    seen: Counter = Counter()
    monkeypatch.setattr(L.Model, "step", lambda self, near, a, b, rate: seen.update(zip(a.tolist(), b.tolist())))
    assert L.train(L.Model(lex), lex, [" ".join(t) for t in texts] + [None, ""]) == words
    want: Counter = Counter()
    for t in texts:
        a, b, _ = lex.encode([w.encode() for w in t])
        want.update(zip(a.tolist(), b.tolist()))
    assert seen == want


def test_rounds_and_shards_hold_every_text_once(frame, spark):
    docs = frame(corpus(100) + [(500, corpus(1)[0][1])])
    from pyspark.sql import functions as F

    h = docs.select(F.xxhash64("text").alias("h"))
    assert h.selectExpr(f"pmod(h, {L.ROUNDS}) as k").groupBy("k").count().agg(F.sum("count")).first()[0] == 101


def test_scores_do_not_depend_on_partitions(frame):
    docs = frame(corpus(60) + odd_corpus())
    runs = [Counter(map(tuple, L.scored(d, L.fit(d, 12, rounds=3, shard_words=700)).collect())) for d in (docs.coalesce(1), docs.repartition(7), docs.repartition(3, "text"))]
    assert runs[0] == runs[1] == runs[2]


def test_every_counted_word_scores_its_count(frame):
    """However many there are beyond the vocabulary; the table of gains grows with the corpus."""
    rows = [(i, f"w{i} " * (2 + i % 3) + f"once{i}") for i in range(4000)]
    docs = frame(rows)
    fitted = L.fit(docs, 4, rounds=1)
    assert fitted[2].count() == 3996
    lex, m, _ = fitted
    got = {r.doc_id: r.log_likelihood for r in L.scored(docs, fitted).collect()}
    for i, t in rows[::97]:
        words = t.encode().split()
        a, b, tail = lex.encode(words, True)
        n = np.array([1 if w.startswith(b"once") else 2 + i % 3 for w in words])
        exact = np.where(n > 1, np.log(n) - lex.log_cell[a, b], tail)
        assert got[i] == pytest.approx(m.score(a, b, exact), abs=1e-3)


def test_copies_spread_over_the_shards(frame, monkeypatch):
    """With half of the rows equal but for their ids, no shard has more than twice the mean."""
    sizes = []
    monkeypatch.setattr(L, "_round", lambda texts, model, shards: sizes.extend(r["count"] for r in texts.selectExpr(f"pmod(shiftrightunsigned(h, 8), {shards}) as s").groupBy("s").count().collect()))
    L.fit(frame([(i, "the same words again" if i % 2 else f"other words {i}") for i in range(4000)]), 4, rounds=2, shard_words=1000)
    assert len(sizes) >= 14 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_model_edges(frame):
    rows = [(1, None), (2, ""), (3, "word"), (3, "word"), (4, "new words " * 30_000), (None, "word")]
    docs = frame(rows).selectExpr("*", "1 as h", "2 as shard", "3 as n", "4 as w", "'x' as n_words")
    out = Counter((r.doc_id, r.n_words, r.mean_log_likelihood is None) for r in L.lm_scores(docs).collect())
    assert out == Counter({(1, 0, True): 1, (2, 0, True): 1, (3, 1, False): 2, (4, 60_000, False): 1, (None, 1, False): 1})
    assert [r.log_likelihood for r in L.lm_scores(frame([(1, None)])).collect()] == [0.0]
    assert L.lm_scores(frame([])).count() == 0
    assert [r.n_words for r in L.lm_scores(frame([(1, "one"), (2, "two")])).collect()] == [1, 1]


def test_words_of_many_texts_are_those_of_each():
    texts = [t for _, t in odd_corpus()] + [" a  b\t", "\x0b\x0c \r\n", "a\x1cb\x85c\xa0d e", "İSTANBUL ΣΑΣ ΟΔΟΣ ẞ", "z" * 70_000 + " a", None, ""]
    for part in (texts, texts[:1], [None, ""], ["a", "a b"], []):
        words, at, n = L.distinct_words(part)
        words = L.listed(words)
        assert len(words) == len(set(words))
        assert [words[i] for i in at] == [w for t in part for w in L.words_of(t)]
        assert n.tolist() == [len(L.words_of(t)) for t in part]


def test_a_word_is_looked_up_once_for_many_texts(frame, monkeypatch):
    """Not once for each place that has it: what is named beside a text and its units stay those of every place."""
    texts = [None, "", *(t for _, t in odd_corpus() * 20)]
    lex, *_ = L.lexicon(frame(odd_corpus()), 12)
    asked = []
    once = L.Lexicon.looked_up
    monkeypatch.setattr(L.Lexicon, "looked_up", lambda self, words, tails=False: asked.extend(words) or once(self, words, tails))
    ((n, a, b, tail, (words, times, named)),) = L.coded(lex, texts, True)
    assert Counter(asked) == Counter({w for t in texts for w in L.words_of(t)})
    assert n.tolist() == [len(L.words_of(t)) for t in texts]
    want = lex.encode([w for t in texts for w in L.words_of(t)], True)
    assert all(np.array_equal(x, y) for x, y in zip((a, b, tail), want))
    words = L.listed(words)
    for t, i, j in zip(texts, [0, *named], named):
        assert dict(zip(words[i:j], times[i:j])) == Counter(w for w in L.words_of(t) if w not in lex.ids)


def test_short_texts_are_scored_together_and_alike(frame, monkeypatch):
    """The network runs once for many short texts, and a text's score has the same bits whatever stands beside it."""
    rows = odd_corpus() * 3 + [(900, "word " * 5000)]
    lex, m, _ = L.fit(frame(rows), 12, rounds=1)
    texts = []
    for n, a, b, tail, _ in L.coded(lex, [t for _, t in rows], True):
        texts += [(a[j - k : j], b[j - k : j], tail[j - k : j]) for k, j in zip(n, n.cumsum())]
    runs, log_units = [], L.Model.log_units
    monkeypatch.setattr(L.Model, "log_units", lambda self, *x: runs.append(1) or log_units(self, *x))
    together = list(m.scores(texts))
    words = sum(len(a) for a, _, _ in texts)
    assert len(texts) > 190 and len(runs) <= (words + L.ROW_STEP * len(texts)) / L.BLOCK + 1
    assert together == [m.score(*x) for x in texts]
    order = np.random.default_rng(1).permutation(len(texts))
    assert [together[i] for i in order] == list(m.scores([texts[i] for i in order]))
    assert list(m.scores([])) == [] and m.score(*(x[:0] for x in texts[0])) == 0
