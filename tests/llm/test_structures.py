"""Turn repair, vector codes and the archive against brute force, odd inputs and damage."""

import gzip
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.llm import turn_repair, vector_codes, warc_store

GRAMMAR = re.compile(r"(?:s?(?:ua)+)?")


def cheapest(rows):
    """Every sequence of edits of up to two inserts before each turn and at the end; rows of (role, text)."""
    seen, faults = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("x" if not bare or (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    inserts = [()] + [(("I", 3, r, ""),) for r in ("user", "assistant")] + [(("I", 3, a, ""), ("I", 3, b, "")) for a in ("user", "assistant") for b in ("user", "assistant")]
    choices = []
    for (role, text), fault in zip(rows, faults):
        own = [("D", 4, None, None)]
        if fault != "x":
            more = 3 * (fault == "t")
            own += [("K", more, role, text)] + [("R", 3 + more, r, text) for r in ("user", "assistant")]
        choices += [inserts, [(e,) for e in own]]
    best = None
    for way in itertools.product(*choices, inserts):
        edits = [e for step in way for e in step]
        made = [(e[2], e[3]) for e in edits if e[2] is not None]
        if GRAMMAR.fullmatch("".join(r[0] for r, _ in made)):
            key = sum(e[1] for e in edits), "".join(e[0] for e in edits), "\n".join(f"{r}:{t}" for r, t in made)
            best = min(best or key, key)
    return best


def test_edits_against_all_edits():
    rng = random.Random(5)
    for _ in range(60):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["", "a.", "b", "c!"])) for _ in range(rng.randint(0, 3))]
        piece = turn_repair.Piece()
        for role, text in rows:
            piece.add(None, role, text, f"{role}|{text}".encode())
        codes = "".join(piece.codes)
        costs = turn_repair.costs_to_go(codes)
        audit, _ = turn_repair.walk(codes, costs)
        assert (costs[0][0], audit, "\n".join(turn_repair.rebuilt(audit, rows))) == cheapest(rows), rows


def undamaged(spark, rows, schema="conv_id long, turn long, role string, text string"):
    return spark.createDataFrame(rows, schema).withColumn("gone", F.lit(False))


def test_a_conversation_over_many_ranges_is_repaired_like_one(spark):
    rng = random.Random(7)
    rows = [(1, i // 2, rng.choice(["user", "assistant", "system", "x"]), rng.choice([f"said {i}.", f"cut {i}", "again.", " "])) for i in range(3000)]
    rows += [(c, i, "user", f"hi {c}.") for c in (0, 2) for i in range(2)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        found = {r.conv_id: r for r in turn_repair.repaired(undamaged(spark, rows)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    key = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    assert len(found) == 3
    for conv, r in found.items():
        own = sorted((t, role, key(role, text), text) for c, t, role, text in rows if c == conv)
        whole = turn_repair._whole([(t, role, text, k) for t, role, k, text in own])
        assert tuple(r)[1:] == whole


def test_turns_of_odd_inputs(spark):
    rows = [(None, None, None, None, 1), (1, None, "user", "b.", 2), (1, 5, "assistant", "x" * 300_000 + ".", 3), (1, 5, "assistant", "x" * 300_000 + ".", 3), (2, 1, "", "empty role.", 4), (3, 1, "user", "", 5)]
    t = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key int")
    found = {r.conv_id: r for r in turn_repair.repaired(t.withColumn("gone", F.col("conv_id") == 3).fillna(False, ["gone"])).collect()}
    assert (found[None].blank, found[None].audit, found[None].gaps) == (1, "D", 0)
    assert (found[1].duplicate, found[1].audit, found[1].cost) == (1, "KKD", 4)
    assert found[2].audit in ("D",) and found[2].cost == 4
    empty = hashlib.sha256(b"").hexdigest()
    assert tuple(found[3])[1:] == (0, 0, 0, 0, 0, 0, "", empty) and found[None].repaired_sha256 == empty


def test_nearest_is_exact_for_ties_equal_entries_and_large_numbers():
    rng = np.random.default_rng(3)
    for scale in (3, 1000, vector_codes.LIMIT - 1):
        book = rng.integers(-scale, scale + 1, (64, 8))
        book[40] = book[7]
        x = np.concatenate([rng.integers(-scale, scale + 1, (500, 8)), book])
        number, error = vector_codes.Nearest(book)(x)
        exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in book] for v in x]
        assert number.tolist() == [d.index(min(d)) for d in exact] and error.tolist() == [min(d) for d in exact]


def test_intervals_hold_the_true_value():
    rng = np.random.default_rng(4)
    book, x = rng.integers(-(1 << 26), 1 << 26, (32, 16)), rng.integers(-(1 << 26), 1 << 26, (64, 16))
    low, high = vector_codes.Nearest(book).intervals(x)
    true = np.array([[sum(int(b) * int(b) - 2 * int(a) * int(b) for a, b in zip(v, c)) for c in book] for v in x], dtype=object)
    assert (low <= true).all() and (true <= high).all()


def test_vectors_of_odd_inputs(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(3, [0.5, -0.25, 0.0, 1.0], None, "c"), (1, [0.5, -0.25, 0.0, 1.0], 1, "a"), (1, [0.5, -0.25, 0.0, 1.0], 1, "a"), (None, [0.1, 0.1, 0.1, 0.1], None, None), (4, None, 1, ""), (5, [0.1, None, 0.2, 0.3], 1, ""), (6, [nan, 0.0, 0.0, 0.0], 1, ""), (7, [inf, 0.0, 0.0, 0.0], 1, "")]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, x string")
    found = vector_codes.coded(t).collect()
    assert sorted((r.vec_id or 0, r.error, r.label_error) for r in found) == [(0, 0, 0), (1, 0, 0), (1, 0, 0), (3, 0, 0)]
    assert {r.code for r in found if r.vec_id} == {"00000000"} and len({r.codebooks_sha256 for r in found}) == 1
    for bad in ([0.1] * 8, [2.0**17, 0.0, 0.0, 0.0]):
        with pytest.raises((PySparkException, ValueError)):
            vector_codes.coded(spark.createDataFrame([*rows, (9, bad, 1, "")], t.schema)).collect()


def test_vector_codes_against_plain_rounds(spark):
    rng = np.random.default_rng(6)
    data = rng.normal(size=(700, 8)).astype(np.float32)
    t = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(data)], "vec_id long, embedding array<float>, label int").repartition(5)
    found = {r.vec_id: r for r in vector_codes.coded(t).collect()}
    x = np.floor(data.astype(np.float64) * 1024).astype(np.int64)
    books = [x[:256, 2 * p : 2 * p + 2].tolist() for p in range(4)]

    def assign(p):
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(books[p])) for v in x[:, 2 * p : 2 * p + 2].tolist()]

    for _ in range(4):
        for p in range(4):
            groups = {}
            for (_, j), v in zip(assign(p), x[:, 2 * p : 2 * p + 2].tolist()):
                groups.setdefault(j, []).append(v)
            for j, g in groups.items():
                books[p][j] = [sum(c) // len(g) for c in zip(*g)]
    final = [assign(p) for p in range(4)]
    for i in range(len(x)):
        assert found[i].code == "".join(f"{final[p][i][1]:02x}" for p in range(4)) and found[i].error == sum(final[p][i][0] for p in range(4))


PAGES = [(1, "http://a/1", "é" * 600), (7, "http://a/7", "é" * 600), (3, "http://a/3\r\nX: y", "é" * 600), (7, "http://a/7b", "é" * 600), (2, None, "small"), (4, "u", "small"), (5, "u", None), (None, "n", "z" * 1000), (None, "n", "z" * 1000), (8, "long", "w" * 3_000_000)]


def archive(spark, folder, rows=PAGES):
    t = spark.createDataFrame([(*r, b"x", "y") for r in rows], "page_id long, url string, html string, payload binary, sha256 string")
    return warc_store.write_archive(t, f"file://{folder}")


def test_archive_holds_a_payload_once_and_gives_records_back(spark, tmp_path):
    path = archive(spark, tmp_path / "a")
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h in PAGES})
    found = sorted(((r.page_id_text, r.record_type, r.refers_to_text, r.payload_bytes, r.payload_digest) for r in warc_store.read_back(spark, path).collect()), key=str)
    big = hashlib.sha1(("é" * 600).encode()).hexdigest()
    assert [x for x in found if x[4] == big] == sorted([("1", "revisit", "7", 1200, big), ("3", "revisit", "7", 1200, big), ("7", "response", None, 1200, big), ("7", "revisit", "7", 1200, big)], key=str)
    assert {(x[1], x[2]) for x in found if x[0] in ("2", "4", "5", "8")} == {("response", None)}
    assert sorted(x[1] for x in found if x[0] is None) == ["response", "revisit"]


def test_a_changed_payload_or_one_that_is_gone_stops_the_reader(spark, tmp_path):
    path = archive(spark, tmp_path / "a")
    rows = spark.read.parquet(f"{path}/payloads")
    heads = spark.read.parquet(f"{path}/headers")
    for name, changed in (("b", rows.withColumn("payload", F.when(F.length("payload") == 5, F.encode(F.lit("smell"), "UTF-8")).otherwise(F.col("payload")))), ("c", rows.filter(F.length("payload") != 5))):
        heads.write.parquet(f"file://{tmp_path}/{name}/headers")
        changed.write.parquet(f"file://{tmp_path}/{name}/payloads")
        with pytest.raises(PySparkException):
            warc_store.read_back(spark, f"file://{tmp_path}/{name}").collect()


def test_warc_files_parse_by_their_lengths(spark, tmp_path):
    path = archive(spark, tmp_path / "a")
    warc_store.write_warc(spark, path, f"file://{tmp_path}/w")
    found = []
    for f in sorted((tmp_path / "w").glob("part-*")):
        data = f.read_bytes()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
            n = int(fields[b"Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[n : n + 4] == b"\r\n\r\n"
            if fields[b"WARC-Type"] == b"response":
                assert b"sha1:" + hashlib.sha1(rest[:n]).hexdigest().encode() == fields[b"WARC-Payload-Digest"]
            found.append(fields[b"WARC-Record-ID"])
            data = rest[n + 4 :]
    assert len(found) == len(set(found)) == len(PAGES)
    want = sorted((r.header, b"" if "WARC-Type: revisit" in r.header else bytes(r.payload)) for r in warc_store.records(spark, path).collect())
    assert sorted((r.header, bytes(r.content)) for r in warc_store.read_warc(spark, f"file://{tmp_path}/w/part-*").collect()) == want
    whole = gzip.compress(b"".join(f.read_bytes() for f in sorted((tmp_path / "w").glob("part-*"))))
    (tmp_path / "all.warc.gz").write_bytes(whole)
    assert sorted((r.header, bytes(r.content)) for r in warc_store.read_warc(spark, f"file://{tmp_path}/all.warc.gz").collect()) == want
    (tmp_path / "cut.warc").write_bytes(gzip.decompress(whole)[:-3000])
    with pytest.raises(PySparkException):
        warc_store.read_warc(spark, f"file://{tmp_path}/cut.warc").collect()


def test_altered_licences_are_refused():
    from tidemark.llm import license_scan

    def labels(text):
        return {x[2] for x in license_scan.scan(text)[1]}

    assert "unlicense-text" in labels(license_scan.TEMPLATES["unlicense-text"].split(" [[")[0])
    assert not labels("This is free and unencumbered software released into the public domain. All rights are kept by the owner.")
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"
    assert not labels(f"{mpl}, with every right withdrawn.")
    assert labels(f"{mpl}. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.") == {"mpl-notice"}


def test_codes_are_decoded_to_their_entries(spark):
    rng = np.random.default_rng(9)
    t = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(300, 8)).astype(np.float32))], "vec_id long, embedding array<float>, label int")
    rows = vector_codes.kept(t)
    books = vector_codes.trained(rows)
    made = vector_codes.decoded(vector_codes.coded(t), books).join(rows.select("vec_id", "x"), "vec_id").collect()
    assert len(made) == 300
    for r in made:
        whole = [int(np.floor(v * vector_codes.SCALE)) for v in r.vector]
        assert sum((a - b) ** 2 for a, b in zip(r.x, whole)) == r.error
