"""Nulls, empty and long texts, ties and repeats, empty tables and clashing columns, for every operator and pipeline stage."""

import math
import random
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tables import DATA

from tidemark.llm import base, exact_dedup, host_rules, langid, license_scan, lm_score, minhash_join, mixing, packing, pseudonyms, token_count

LONG = " ".join(f"w{i % 997}x{i}" for i in range(60_000))
WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
ROWS = [
    (1, "the cat and the dog went over the hill and the river", "en", "a"),
    (1, "the cat and the dog went over the hill and the river", "en", "a"),
    (2, "der Hund und die Katze gingen \x0b\xfcber den Berg", "de", None),
    (3, None, "en", "a"),
    (4, "", None, "b"),
    (None, "the cat and the dog went over the hill and the river", None, None),
    (None, None, None, None),
    (5, LONG, "en", "b"),
    (6, LONG + " end", None, "b"),
    (7, " \n\t", "xx", ""),
    (8, "\U00030000\U00030001 \U0001f600", None, "c"),
    (9, "MIT License", "en", "c"),
]
#: Names that the operators use inside, in a table that has them already.
CLASH = "digest winner rid n heavy shard h i x cls root key bands a b v w slot block tier start found made words kept score lang_pred held_out known share __slot __part __queue __document __meta __tm_digest __tm_chars __tm_raw __tm_winner __TM_RANK __tm_gone text_sha256 class_id source_id n_words dotted.name".split()
OPERATORS = {
    "exact_dedup": (exact_dedup.exact_dedup, 12),
    "host_rules": (host_rules.host_rules, 12),
    "packed": (lambda d: packing.packed(d, WORDS).filter("start = 0"), 12),
    "mix": (lambda d: mixing.mix(d, block=1).filter("epoch = 0"), 12),
    "pseudonymised": (pseudonyms.pseudonymised, 12),
    "language_id": (langid.language_id, 12),
    "license_scan": (license_scan.license_scan, 12),
    "minhash_join": (minhash_join.minhash_join, 12),
    "lm_scores": (lm_score.lm_scores, 12),
    "token_counts": (lambda d: token_count.token_counts(d, PIECES), 12),
}


def clashing(docs):
    return docs.selectExpr("*", *(f"'{c}' as `{c}`" for c in CLASH))


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_of_awkward_tables_returns(frame, name):
    f, n = OPERATORS[name]
    plain = Counter(map(str, f(frame(ROWS).coalesce(1)).collect()))
    assert sum(plain.values()) == n
    assert Counter(map(str, f(clashing(frame(ROWS)).coalesce(1)).collect())) == plain, "other columns change nothing"
    assert f(clashing(frame([]))).count() == 0
    for column in ("doc_id", "text", "lang", "source"):
        assert f(frame(ROWS).drop(column).selectExpr("*", f"cast(null as {'long' if column == 'doc_id' else 'string'}) as {column}")).count() >= (n if name != "mix" else 1), "a column of nulls"


def test_long_texts_are_read_whole(frame):
    docs = frame(ROWS)
    size = {5: 60_000, 6: 60_001}
    rules = {r.doc_id: r.n_words for r in host_rules.host_rules(docs).collect()}
    licences = {r.doc_id: r.n_words for r in license_scan.license_scan(docs).collect()}
    scores = {r.doc_id: r.n_words for r in lm_score.lm_scores(docs).collect()}
    assert all(x[d] == n for x in (rules, licences, scores) for d, n in size.items())
    digests = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(docs).collect()}
    assert digests[5] == (5, 1) and digests[6] == (6, 1), "they differ in their last word"
    joined = {r.doc_id: (r.class_id, r.n_links) for r in minhash_join.minhash_join(docs).collect()}
    assert joined[5] == joined[6] == (5, 1)
    e = packing.encoder(WORDS)
    pieces = packing.packed(docs, WORDS).filter("doc_id in (5, 6)").groupBy("doc_id").sum("length").collect()
    assert all(r[1] == len(e.full.encode(LONG if r.doc_id == 5 else LONG + " end", add_special_tokens=False).ids) + 1 for r in pieces)
    tail = license_scan.license_scan(frame([(1, LONG + " MIT License")])).first()
    assert (tail.n_base, tail.first_word) == (1, 60_000)


FILTERS = {
    "keep_first": (exact_dedup.keep_first, {1: 1, 2: 1, 3: 0, 4: 0, 5: 1, 6: 1, 7: 1, 8: 1, 9: 1, None: 0}),
    "keep_one": (minhash_join.keep_one, {1: 2, 2: 1, 3: 1, 5: 1, 8: 1, 9: 1, None: 2, 4: 0, 7: 0}),
    "mixed": (lambda d: mixing.mixed(d, block=1).distinct(), {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1, 9: 1, None: 2}),
}


@pytest.mark.parametrize("name", FILTERS)
def test_filters_carry_clashing_columns(frame, name):
    f, want = FILTERS[name]
    docs = clashing(frame(ROWS))
    out = f(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert all(r[c] == c for r in rows for c in CLASH)
    got = Counter(r.doc_id for r in rows)
    assert {d: got[d] for d in want} == want


def test_languages_carry_clashing_columns(frame):
    docs = clashing(frame(ROWS))
    out = langid.keep_known(docs, langid.fit(langid.training_rows(docs)), least=0.0)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} <= {1, 2, 5, 6, 8, 9, None}


def test_every_plane_has_letters():
    fold = langid._folding()
    assert len(fold) == sys.maxunicode + 1
    some = random.Random(4).sample(range(sys.maxunicode + 1), 20_000)
    assert all((fold[i] != 0) == chr(i).isalpha() for i in [*some, 0x41, 0x130, 0xDF, 0x2FFFF, 0x30000, 0x3134A, 0x323AF])


def test_a_text_is_und_only_without_letters(frame):
    letters = [chr(i) for i in (0x61, 0xAA, 0x3B1, 0x4E2D, 0x10400, 0x1D41A, 0x20000, 0x2F800, 0x30000, 0x31350)]
    others = [chr(i) for i in (0x30, 0x2460, 0x1F600, 0xE0041, 0xF0000, 0x10FFFD)]
    rows = [(i, "the cat sat on the mat", "en") for i in range(30)] + [(100 + i, c * 3, None) for i, c in enumerate(letters)] + [(200 + i, c * 3, None) for i, c in enumerate(others)]
    out = {r.doc_id: r for r in langid.language_id(frame(rows)).collect()}
    assert all(out[100 + i].lang_pred == "en" for i in range(len(letters)))
    assert all((out[200 + i].lang_pred, out[200 + i].score) == ("und", 0.0) for i in range(len(others)))


def test_languages_against_a_model(frame):
    """Bundles, prototypes and cosines worked out one trigram at a time."""
    rng = random.Random(7)
    words = {"en": "the and of to in".split(), "de": "der und die das ist".split(), "fr": "le la les été ça".split()}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(rng.randrange(1, 12))) + rng.choice(["", ".", " 7!"]), k) for i, k in enumerate(rng.choice(list(words)) for _ in range(60))]

    def bundle(text):
        letters = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        chain = [0]
        for w in letters:
            chain += [*map(ord, w), 0]
        out = np.zeros(langid.DIM)
        for a, b, c in zip(chain, chain[1:], chain[2:]):
            out += np.roll(langid.symbol(a), 2).astype(int) * np.roll(langid.symbol(b), 1) * langid.symbol(c)
        return out

    learned = [(t, k) for d, t, k in rows if zlib.crc32(str(d).encode()) % 3 != 1]
    prototypes = {k: sum(np.sign(bundle(t)) for t, x in learned if x == k) for k in sorted({k for _, k in learned})}
    for r in langid.language_id(frame(rows)).collect():
        v = bundle(rows[r.doc_id][1])
        cos = {k: v @ p / np.linalg.norm(v) / np.linalg.norm(p) for k, p in prototypes.items()}
        best = max(cos, key=cos.get)
        assert r.lang_pred == best and r.score == pytest.approx(max(0, cos[best]), abs=1e-6)


def test_dirty_labels_are_bounded(frame):
    rows = [(i, "the cat sat on the mat", "en") for i in range(60)] + [(100 + i, f"noise {i}", f"label {i}") for i in range(300)]
    docs = frame(rows)
    found = langid.fit(langid.training_rows(docs, languages=3))
    assert len(found) <= 3 and "en" in dict(found)
    assert "label 5" not in langid.training_rows(docs)._jdf.queryExecution().toString()


def test_rejection_threshold(spark):
    """Documents of the tables keep their place; letters of scripts that none of them has go."""
    docs = spark.read.parquet(str(DATA / "sf0.01/documents.parquet"))
    known = langid.fit(langid.training_rows(docs))
    assert langid.keep_known(docs, known).count() >= 0.998 * docs.count()
    rng = random.Random(5)
    noise = [(i, "".join(rng.choice("αβγδεζηθικλμνξοπρστυφχψω  ") for _ in range(200))) for i in range(300)]
    rows = spark.createDataFrame(noise, "doc_id long, text string")
    assert langid.keep_known(rows, known).count() <= 0.05 * len(noise)


def test_memories_of_other_operators_go():
    base.remembered("one", first := {"a": 1})
    base.remembered("two", second := {"b": 1})
    base.working("one")
    assert first and not second
    base._memories.pop("one"), base._memories.pop("two")


@pytest.mark.parametrize("rows", [[], [(None, None, None, None)], [(1, None, None, None), (None, "", None, None)], ROWS, [(1, "the same old text again and again", "en", "s")] * 40], ids=["empty", "nulls", "no text", "awkward", "repeats"])
def test_pipeline_of_awkward_tables(spark, frame, tmp_path, rows):
    import corpus_pipeline

    clashing(frame(rows)).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"out{i}"))
        after = spark.read.parquet(str(tmp_path / f"out{i}"))
        if i < 4:
            assert after.columns == docs.columns
        docs = after
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in docs.collect())
    if len(rows) == 40:
        assert [r.doc_id for r in docs.select("doc_id").distinct().collect()] == [1]
    if rows is ROWS:
        assert {r.doc_id for r in docs.collect()} >= {1, 2}


def test_ids_that_repeat_or_are_missing_do_not_multiply_work(frame):
    """Many texts of one id, or of none, are still found one by one."""
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(50)) for _ in range(30)) for _ in range(60)]
    near = [t + " end" for t in texts]
    rows = [(None, t) for t in texts + near] + [(5, t.upper() + " z") for t in texts]
    out = minhash_join.minhash_join(frame(rows)).collect()
    assert len(out) == len(rows) and all(r.n_links >= 2 for r in out)


def test_schedule_of_queries_matches_a_plain_one(frame):
    """The whole stream against earliest deadline first, worked out slot by slot in fractions."""
    from fractions import Fraction

    rows = [(i, "t", "en", s) for i, s in enumerate(["a"] * 37 + ["b"] * 11 + ["c"] * 5 + [None] * 3)]
    weights = {"a": 5, "b": 3, "c": 2, None: 1}
    out = mixing.mix(frame(rows), weights, block=1).collect()
    order = sorted(weights, key=lambda s: (-Counter(r[3] for r in rows)[s], s is None, s))
    share = {s: Fraction(k, mixing.FRAME) for s, k in zip(order, mixing.quotas([weights[s] for s in order], mixing.FRAME))}
    assert all(abs(share[s] - Fraction(w, sum(weights.values()))) < Fraction(2, mixing.FRAME) for s, w in weights.items())
    had, want = Counter(), []
    n = Counter(r[3] for r in rows)
    while any(had[s] < n[s] for s in n):
        t = len(want)
        ready = [s for s in order if math.floor(had[s] / share[s]) <= t]
        want.append(min(ready, key=lambda s: (math.ceil((had[s] + 1) / share[s]), order.index(s))))
        had[want[-1]] += 1
    assert [r.source for r in sorted(out, key=lambda r: r.slot)] == want
    for s in n:
        ids = [r.doc_id for r in sorted(out, key=lambda r: r.slot) if r.source == s]
        assert len(set(ids[: n[s]])) == n[s] and all(x == ids[i % n[s]] for i, x in enumerate(ids)), "epochs repeat the order"




def test_blocks_grow_so_that_slots_have_a_bound(spark, frame, monkeypatch):
    assert mixing.block_rows([1000, 10], [3.0, 1.0]) == mixing.BLOCK
    for n in ([10**10, 10**6], [10**10, 10**6, 3], [3] * 1000 + [10**9]):
        w = [x**mixing.ALPHA for x in n]
        slots = lambda b: max(-(-x // b) * sum(w) / y for x, y in zip(n, w))
        block = mixing.block_rows(n, w)
        assert slots(block) <= max(mixing.MOST_SLOTS, 4 * sum(w) / min(w)) and block * slots(block) <= mixing.LONGER * mixing.BLOCK * slots(mixing.BLOCK)
    monkeypatch.setattr(mixing, "MOST_SLOTS", 16)
    monkeypatch.setattr(mixing.block_rows, "__defaults__", (16,))
    rows = [(i, f"t{i}", "en", "a" if i < 700 else "b") for i in range(1000)]
    out = mixing.mix(frame(rows)).collect()
    block = mixing.block_rows([700, 300], [700**mixing.ALPHA, 300**mixing.ALPHA], 16)
    assert block > mixing.BLOCK and max(r.slot for r in out) < 1000 / mixing.BLOCK
    assert {r.doc_id for r in out} == set(range(1000)) and sorted(r.position for r in out) == list(range(len(out)))
    share = 700**mixing.ALPHA / (700**mixing.ALPHA + 300**mixing.ALPHA)
    had = 0
    for t, r in enumerate(sorted(out, key=lambda r: r.position), 1):
        had += r.source == "a"
        assert abs(had - share * t) < block


def test_a_source_without_a_weight_stops_the_query(frame):
    with pytest.raises(ValueError, match="has no weight"):
        mixing.mix(frame([(1, "t", "en", "a"), (2, "t", "en", "b")]), {"a": 1})
