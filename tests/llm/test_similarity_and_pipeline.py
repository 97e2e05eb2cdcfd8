import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tables import DATA

from tidemark.llm import exact_dedup, langid, minhash_join, mixing


def grams(text):
    w = (text or "").lower().encode().split()
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def join_model(rows, similarity=0.8):
    """doc_id -> (class_id, n_links, text_id, n_copies), by comparing every pair of texts."""
    classes = defaultdict(list)
    for d, t in rows:
        classes[b" ".join((t or "").lower().encode().split())].append(d)
    keys = list(classes)
    sets = [grams(k.decode()) for k in keys]
    root = list(range(len(keys)))
    links = [0] * len(keys)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-12:
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    heads = defaultdict(list)
    for i, k in enumerate(keys):
        heads[top(i)].append(min(classes[k]))
    return {d: (min(heads[top(i)]), links[i], min(classes[k]), len(classes[k])) for i, k in enumerate(keys) for d in classes[k]}


def near_copies(n=40, groups=4, words=60, seed=3):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(10_000)}" for _ in range(words)]
        for _ in range(n):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 9])):
                copy[rng.randrange(words)] = f"x{rng.randrange(10_000)}"
            rows.append((len(rows), " ".join(copy)))
    shared = " ".join(f"s{i}" for i in range(50))
    rows += [(len(rows) + i, shared + " " + " ".join(f"o{i}_{k}" for k in range(120))) for i in range(20)]
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", "one two", "ONE  two", "one two three", "\n"])]
    return rows


def test_join_against_all_pairs(frame):
    rows = near_copies()
    got = {r.doc_id: (r.class_id, r.n_links, r.text_id, r.n_copies) for r in minhash_join.minhash_join(frame(rows)).collect()}
    want = join_model(rows)
    missed = sum(abs(got[d][1] - want[d][1]) for d in want)
    assert missed <= 0.01 * sum(w[1] for w in want.values())
    assert {d: (g[0], *g[2:]) for d, g in got.items()} == {d: (w[0], *w[2:]) for d, w in want.items()}


def test_large_groups_meet_in_blocks(frame, monkeypatch):
    rows = near_copies(n=60, groups=2, seed=5)
    whole = {tuple(r) for r in minhash_join.minhash_join(frame(rows)).collect()}
    monkeypatch.setattr(minhash_join, "BLOCK_ROWS", 7)
    monkeypatch.setattr(minhash_join, "BROADCAST_ROWS", 3)  # and joins by shuffle
    assert {tuple(r) for r in minhash_join.minhash_join(frame(rows)).collect()} == whole


def test_core_of_a_large_group(frame, monkeypatch):
    """Members near the pivot are linked without meeting; the others still meet them all."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(10_000)}" for _ in range(300)]
    rows = []
    for i in range(120):
        copy = list(base)
        for _ in range(rng.choice([1, 1, 2, 3, 6, 9, 14])):
            copy[rng.randrange(300)] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(copy)))
    monkeypatch.setattr(minhash_join, "BLOCK_ROWS", 16)
    sent = []
    real = minhash_join._pairs_of_blocks
    monkeypatch.setattr(minhash_join, "_pairs_of_blocks", lambda split, cut: sent.append((split.count(), split.filter("core").count(), real(split, cut).count())) or real(split, cut))
    got = {r.doc_id: (r.class_id, r.n_links, r.text_id, r.n_copies) for r in minhash_join.minhash_join(frame(rows)).collect()}
    assert got == join_model(rows)
    members, core, rows_sent = sent[0]
    assert 0 < core < members and rows_sent < members * -(-members // 16)
    few = [(i, " ".join([*base[: 2 * i], f"y{i}", *base[2 * i + 1 :]])) for i in range(100)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in minhash_join.minhash_join(frame(few)).collect()}
    assert got == {i: (0, 99) for i in range(100)} and sent[1] == (100, 100, 0), "near copies of one text do not meet at all"


def test_one_of_each_class_stays(frame):
    rows = near_copies(n=10)
    kept = [r.doc_id for r in minhash_join.keep_one(frame(rows).selectExpr("*", "1 as cls", "2 as root")).collect()]
    assert sorted(kept) == sorted({c for c, *_ in join_model(rows).values()})


def test_repeated_and_null_ids(frame):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (2, "A b c d e f"), (3, "q w e r t y")]
    got = Counter(tuple(r) for r in minhash_join.minhash_join(frame(rows)).collect())
    assert got == Counter([(1, 1, 0, 1, 4)] * 2 + [(None, 1, 0, 1, 4), (2, 1, 0, 1, 4), (None, None, 0, None, 1), (3, 3, 0, 3, 1)])


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 102), (7, 7)]
    key = lambda i: i.to_bytes(4, "big")
    df = spark.createDataFrame([(key(a), key(b)) for a, b in edges], "a binary, b binary")
    got = {int.from_bytes(r.v, "big"): int.from_bytes(r.root, "big") for r in minhash_join.components(df).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100}


def test_banding_meets_its_recall():
    bands, rows = minhash_join.banding()
    assert 1 - (1 - 0.8**rows) ** bands >= minhash_join.RECALL and 1 - (1 - minhash_join.LOW**rows) ** bands <= minhash_join.LOW_RATE


@pytest.mark.parametrize("slots", [64, 256])
def test_every_prefix_is_within_a_block(slots):
    rng = random.Random(slots)
    for _ in range(50):
        k = mixing.quotas([rng.random() ** 3 + 0.001 for _ in range(rng.randint(1, 30))], slots)
        seen = [0] * len(k)
        assert sum(k) == slots and min(k) >= 1
        for t, (s, j) in enumerate(mixing.frame(k), 1):
            assert j == seen[s]
            seen[s] += 1
            assert all(abs(n - q * t / slots) < 1 for n, q in zip(seen, k))


def test_mixed_stream(frame):
    rows = [(i, "t", "en", "big" if i % 3 else (f"s{i % 4}" if i % 2 else None)) for i in range(1500)] + [(5, "t", "en", "big"), (None, None, None, "s1")]
    out = mixing.mix(frame(rows), block=4).collect()
    assert sorted(r.position for r in out) == list(range(len(out))), "positions have no gaps"
    assert Counter(r.source for r in rows_of(frame(rows))) == Counter(r.source for r in out if r.epoch == 0), "every document comes once before any comes again"
    assert all(r.release <= r.slot < r.deadline and r.slot == r.position // 4 for r in out)
    sizes = Counter(s for *_, s in rows)
    total = sum(n**mixing.ALPHA for n in sizes.values())
    slots = max(r.slot for r in out) + 1
    blocks = Counter(s for s, _ in {(r.source, r.slot) for r in out})
    assert all(abs(blocks[s] / slots - n**mixing.ALPHA / total) < 0.01 for s, n in sizes.items())
    again = mixing.mix(frame(rows).repartition(7), block=4).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))


def test_weights_hold_over_the_whole_stream_with_many_small_sources(frame):
    rows = [(i, "t", "en", "hot" if i < 6000 else f"s{i % 300}") for i in range(7500)]
    out = mixing.mix(frame(rows), block=1).collect()
    sizes = Counter(s for *_, s in rows)
    total = sum(n**mixing.ALPHA for n in sizes.values())
    assert len(out) > 4 * 4096 and sorted(r.position for r in out) == list(range(len(out)))
    by = defaultdict(list)
    for r in out:
        by[r.source].append(r.slot)
        assert r.release <= r.slot < r.deadline
    for s, n in sizes.items():
        seen = np.bincount(by[s], minlength=len(out)).cumsum()
        assert np.abs(seen - n**mixing.ALPHA / total * np.arange(1, len(out) + 1)).max() < 1 + 1e-9


def rows_of(df):
    return df.select("source").collect()


def test_sources_beyond_the_bound_share_a_queue(frame, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 2)
    rows = [(i, "t", "en", f"s{i % 5}" if i % 2 else "a") for i in range(200)]
    out = mixing.mix(frame(rows), block=4).collect()
    assert {r.doc_id for r in out} == set(range(200)) and sorted(r.position for r in out) == list(range(len(out)))


def test_sources_beyond_the_bound_keep_their_weights(frame, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 2)
    monkeypatch.setattr(mixing, "QUEUE_SOURCES", 3)
    rows = [(i, "t", "en", "a" if i < 60 else "b" if i < 110 else None if i % 9 == 0 else f"s{i % 9}") for i in range(290)]
    weights = {"a": 20, "b": 15, None: 9} | {f"s{i}": i for i in range(1, 9)}
    out = mixing.mix(frame(rows), weights, block=1).collect()
    assert sorted(r.position for r in out) == list(range(len(out))) and {r.doc_id for r in out} == set(range(290))
    assert all(r.release <= r.slot < r.deadline for r in out)
    for s, w in weights.items():
        seen = np.bincount([r.slot for r in out if r.source == s], minlength=len(out)).cumsum()
        assert np.abs(seen - w / sum(weights.values()) * np.arange(1, len(out) + 1)).max() < (1 if s in ("a", "b") else 2) + 1e-9


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(str(DATA / "sf0.01/documents.parquet"))
    out = langid.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert sum(r.lang_pred == r.lang for r in out) / len(out) > 0.98 and all(0 <= r.score <= 1 for r in out)


def test_language_edges(frame):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("the house", None), (None, "en"), ("123 ###", "en"), ("", "de"), ("日本語", None), ("ß" * 5000, None)] * 4)]
    out = {r.doc_id: r for r in langid.language_id(frame(rows)).collect()}
    assert len(out) == len(rows)
    assert {out[d].lang_pred for d in out if d % 8 in (3, 4, 5)} == {"und"} and {out[d].score for d in out if d % 8 in (3, 4, 5)} == {0.0}
    assert out[2].lang_pred == "en" and {out[6].lang_pred, out[7].lang_pred} <= {"de", "en"}
    assert {r.lang_pred for r in langid.language_id(frame([(1, "text", None)])).collect()} == {"und"}


def test_blocks_of_a_long_text_give_the_same_trigrams(monkeypatch):
    text = "Ab c, déf 12 " * 200
    whole = langid.trigram_codes(text)
    monkeypatch.setattr(langid, "BLOCK", 7)
    assert (langid.trigram_codes(text) == whole).all()
    words = " " + re.sub(r"[^a-zé]+", " ", text.lower()).strip() + " "
    spaced = [0 if c == " " else ord(c) for c in words]
    assert Counter(whole.tolist()) == Counter(a << 42 | b << 21 | c for a, b, c in zip(spaced, spaced[1:], spaced[2:]))


def test_pipeline_stage_by_stage(spark, frame, tmp_path):
    import corpus_pipeline

    rows = [(d, t, "en", f"s{d % 3}", 1) for d, t in near_copies(n=6)] + [(900, "g0 only one", "en", "s0", 1), (901, "g0  only one", "en", "s0", 1), (902, "12 34", "en", "s1", 1)]
    frame(rows).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.STAGES[-1][0]] == [5, "sequences"]
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"out{i}"))
        after = spark.read.parquet(str(tmp_path / f"out{i}"))
        if i < 4:
            assert after.columns == docs.columns
            kept.append({r.doc_id for r in after.select("doc_id").collect()})
        docs = after
    texts = {d: t for d, t, *_ in rows}
    spoken = {d for d, t in texts.items() if any(c.isalpha() for c in t or "")}
    assert kept[0] == spoken
    groups = defaultdict(list)
    for d in spoken:
        groups[re.sub(r"[\x20\x09-\x0d]", "", texts[d])].append((-len(texts[d]), d))
    assert kept[1] == {min(g)[1] for g in groups.values()}
    model = join_model([(d, texts[d]) for d in sorted(kept[1])])
    assert kept[2] == {c for c, *_ in model.values()} and kept[3] == kept[2]
    assert {r.doc_id for r in docs.collect()} == kept[3]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_digest_is_of_the_normalised_text(frame):
    import hashlib

    out = exact_dedup.exact_dedup(frame([(1, " a\tb\x1c")])).first()
    assert out.text_sha256 == hashlib.sha256(b"ab\x1c").hexdigest()
