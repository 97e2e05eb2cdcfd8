import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tables import DATA
from tidemark.llm import packing as P
from tidemark.llm import token_count as C

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [" ", "  ", "\n", "\n\n", "a", "The", "É", "\t", "'s", "'T", "don't", "<|endoftext|>", "<|ENDOFTEXT|>", "<s>", "</s>", "▁", "日本", "\r", "\r\n", "　", " ", "...", "12", "\x00", "\x1c", "\x85", "İ", "J̌", "ΑΣ", "ß", "²", "¼", "ª", "ſ", "́", "​", "😀", "_", "{", " "]
TEXTS = st.lists(st.sampled_from(ODD), max_size=14).map("".join)


@settings(max_examples=500, deadline=None)
@given(TEXTS)
def test_ids_are_the_librarys(text):
    e = P.encoder(WORDS)
    assert np.frombuffer(e.encode(text), "<u4").tolist() == e.full.encode(text, add_special_tokens=False).ids


@settings(max_examples=500, deadline=None)
@given(TEXTS)
def test_counts_are_the_librarys(text):
    c = C.counts(PIECES)
    assert c.sound and c.of([text]) == [len(c.sp.encode(text))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([1, 2, 255, 256, 257, 512, 1023, 2047, 2048, 2049, 5000, 700, 90]), max_size=30))
def test_packing_holds_every_token_once(lengths):
    made = P.pack(lengths)
    pieces = defaultdict(list)
    for size, inside in made:
        assert size in P.TIERS and 0 < sum(n for *_, n in inside) <= size
        for d, s, n in inside:
            pieces[d].append((s, n))
    for d, total in enumerate(lengths):
        at = 0
        for s, n in sorted(pieces[d]):
            assert s == at and n > 0
            at += n
        assert at == total
    assert sum(sum(n for *_, n in x) < size for size, x in made) <= 1, "at most one padded sequence"


def test_step_groups_are_balanced():
    made = P.pack([100 + 37 * i % 3000 for i in range(800)])
    groups = P.step_groups(made, 16 * 2048)
    tokens, cost = Counter(), Counter()
    for (size, pieces), g in zip(made, groups):
        tokens[g] += size
        cost[g] += sum(n * n for *_, n in pieces)
    assert max(tokens.values()) - min(tokens.values()) <= 2 * 2048
    assert max(cost.values()) <= 1.25 * min(cost.values())


def test_packed_rows_round_trip(spark, frame):
    rows = [(1, "Hello world " * 900), (2, None), (3, ""), (None, "x"), (4, "b"), (4, "b"), (5, "été " * 3000)]
    out = P.packed(frame(rows).selectExpr("*", "1 as tier", "2 as start").coalesce(1), WORDS).collect()
    e = P.encoder(WORDS)
    want = {d: np.array([*e.full.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for d, t in rows}
    assert Counter(r.doc_id for r in out if r.start == 0) == Counter(d for d, _ in rows)
    for r in out:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    by = defaultdict(list)
    for r in out:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= 2048
    total = Counter()
    for r in out:
        total[r.doc_id] += r.length
    assert total[1] == len(want[1]) and total[5] == len(want[5]) and total[4] == 2 * len(want[4])


def test_little_padding(spark):
    docs = spark.read.parquet(str(DATA / "sf0.01/documents.parquet"))
    rows = P.packed(docs, WORDS).groupBy("sequence_id").sum("length").collect()
    full = [n if n & (n - 1) == 0 else 2048 for n in (r[1] for r in rows)]
    used = sum(r[1] for r in rows)
    assert used / sum(full) > 0.995


def test_token_rows(frame):
    out = {r.doc_id: r for r in C.token_counts(frame([(1, "Hello world"), (2, None), (3, ""), (4, "word " * 5000)]), PIECES, 4096).collect()}
    sp = C.counts(PIECES).sp
    assert out[1].n_tokens == len(sp.encode("Hello world")) and out[1].n_bytes == 11
    assert (out[2].n_bytes, out[2].n_tokens, out[2].over_limit) == (0, 0, False) == (out[3].n_bytes, out[3].n_tokens, out[3].over_limit)
    assert out[4].over_limit and out[4].n_tokens == len(sp.encode("word " * 5000))


@pytest.mark.parametrize("path", ["sf0.001", "sf0.01"])
def test_tokens_of_documents(spark, path):
    docs = spark.read.parquet(str(DATA / path / "documents.parquet")).limit(150)
    sp = C.counts(PIECES).sp
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.n_tokens == len(sp.encode(texts[r.doc_id])) for r in C.token_counts(docs, PIECES).collect())
