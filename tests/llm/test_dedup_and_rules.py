import hashlib
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import exact_dedup as E
from tidemark.llm import host_rules as H
from tidemark.llm import license_scan as L
from tidemark.llm.base import WordHashes

AWKWARD = [(1, "a b"), (2, "a  b\n"), (3, "ab"), (4, None), (5, ""), (6, " \t"), (7, "x"), (7, "x"), (None, "y y"), (8, "y\ty"), (9, "é"), (10, "a b"), (11, "a b"), (None, None), (2, "a  b\n")]


def dedup_model(rows):
    groups = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), d is None, d or 0, i))
    out = []
    for norm, g in groups.items():
        win = min(g, key=lambda x: x[:3])
        ids = [rows[x[3]][0] for x in g]
        out += [(d, rows[win[3]][0], len(g), hashlib.sha256(norm.encode()).hexdigest()) for d in ids]
    return Counter(out), Counter(rows[min(g, key=lambda x: x[:3])[3]][0] for g in groups.values())


@pytest.mark.parametrize("k", [1, 2, 1024])
def test_exact_dedup_against_a_model(frame, k):
    rows, kept = dedup_model(AWKWARD)
    got = E.exact_dedup(frame(AWKWARD), k).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == rows
    assert Counter(r.doc_id for r in got if r.kept) == kept
    assert Counter(r.doc_id for r in E.keep_first(frame(AWKWARD), k).collect()) == kept


def test_hot_groups_leave_on_the_map_side(spark, frame):
    rows = [(i, "same" if i % 3 else f"own {i}") for i in range(3000)]
    got = E.exact_dedup(frame(rows), 4).filter("heavy").groupBy("keep_id", "group_size").count().collect()
    assert [tuple(r) for r in got] == [(1, 2000, 2000)]


def test_other_columns_stay_and_do_not_clash(spark, frame):
    docs = frame([(1, "a"), (2, "a")]).selectExpr("*", "1 as digest", "2 as winner", "3 as heavy", "4 as n_words")
    assert E.exact_dedup(docs).count() == 2
    assert [tuple(r) for r in E.keep_first(docs).select("doc_id", "digest", "heavy").collect()] == [(1, 1, 3)]
    assert H.host_rules(docs).count() == 2


def rules_model(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {p for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "ab", "#", " ", " ", "\n", "\t", "\x1c", "é", " ", "a b c d e "]), max_size=60).map("".join))
def test_rule_features_against_a_model(text):
    assert H.features(text, WordHashes()) == rules_model(text)


def test_host_verdicts(frame):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "bad", None, "spam") for i in range(60)] + [(100, good, None, "spam"), (101, good, None, None), (102, None, None, None)]
    rows += [(200 + i, good, None, f"h{i % 5}") for i in range(50)] + [(300, "few", None, "tiny"), (301, good, None, "tiny")]
    out = {r.doc_id: r for r in H.host_rules(frame(rows)).collect()}
    assert len(out) == len(rows)
    assert not out[100].base_failed and not out[100].kept, "a host of failures takes its documents along"
    assert out[101].kept and not out[102].kept and out[200].kept and out[301].kept and not out[300].kept


def test_prior_shrinks_small_hosts():
    a, b = H.beta_prior(10, 1000, 100, 0.1, 0.01, 0.01)
    assert a / (a + b) == pytest.approx(0.1) and 0.1 < (1 + a) / (2 + a + b) < 0.5
    assert sum(H.beta_prior(0, 0, None, None, None, None)) == H.LEAST_WEIGHT
    assert sum(H.beta_prior(10, 1000, 100, 0.1, 0.0, 0.01)) == H.MOST_WEIGHT


def places_model(t):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return len(w), sorted(i for p in L.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["MIT", "license", "Apache", "general", "public", "x", "\n", ",", "é", "1", "_", " ", "mit license"]), max_size=30).map(" ".join))
def test_phrases_against_a_model(text):
    n, found = L.scan(text)
    assert (n, [x[0] for x in found if x[3]]) == places_model(text)


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Licensed under the Apache License, Version 2.0.", {"apache", "apache-short-notice"}),
        ("Licensed under the Apache License, Version 2.1.", {"apache"}),
        ("Released under the terms of the MIT License.", {"mit", "mit-notice"}),
        ("Released mostly under the MIT License.", {"mit"}),
        ("licensed under the GNU Affero General Public License version 3 or later", {"gpl", "gpl-notice"}),
        ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-notice"}),
        ("Copyright (c) 2020 Ann Other Ltd. All rights reserved.", {"rights-reserved"}),
        ("Copyright (c) 2020 a b c d e f g h i j k All rights reserved.", set()),
        (None, set()),
    ],
)
def test_templates(text, labels):
    assert {x[2] for x in L.scan(text)[1]} == labels


# Fixed value: the text of a public licence.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def test_a_licence_counts_only_when_its_whole_wording_stands():
    labels = lambda t: {x[2] for x in L.scan(t)[1]}
    assert labels("Some code. " + MIT + " More.") == {"mit-text"}
    for before, after in (("NONINFRINGEMENT", "INFRINGEMENT"), ("IN NO EVENT", "IN ANY EVENT"), ("WITHOUT WARRANTY", "WITH WARRANTY"), ("OTHER DEALINGS IN THE SOFTWARE.", "OTHER DEALINGS."), ("free of charge", "for a charge")):
        assert before in MIT and labels(MIT.replace(before, after)) == set()


@pytest.mark.parametrize("label", L.TEMPLATES)
def test_every_template_reads_its_own_wording(label):
    """The longest and the shortest reading of a template match; without their last word they do not."""
    for long in (True, False):
        words, depth = [], 0
        for x in L._MARKUP.findall(L.TEMPLATES[label]):
            depth += (x == "[[") - (x == "]]")
            if x in ("[[", "]]") or (depth and not long):
                continue
            if x[0] == "{" and ":" in x:
                low, high = map(int, x[1:-1].split(":")[1].split("-"))
                words += ["filler"] * (high if long else low)
            elif x[0] == "{":
                words += (max if long else min)(x[1:-1].split("|"), key=lambda c: len(c.split())).split()
            else:
                words.append(x)
        assert label in {x[2] for x in L.scan(" ".join(words))[1] if x[1] == len(words)}
        assert label not in {x[2] for x in L.scan(" ".join(words[: len(words) // 2]))[1]}


def test_automaton_against_its_readings():
    a = L.Automaton("one [[two {x|y z}]] {any:1-2} end")
    good = ["one k end", "one k k end", "one two x k end", "one two y z k k end", "one two x end", "one end end"]
    bad = ["one end", "one two y k", "one k k k end", "two x k end"]
    assert all(a.match(x.encode().split(), 0) == len(x.split()) for x in good) and not any(a.match(x.encode().split(), 0) for x in bad)
    with pytest.raises(ValueError):
        L.Automaton("{any:1-2} x")


def test_license_rows(frame):
    out = {r.doc_id: r for r in L.license_scan(frame([(1, "MIT License. mit license"), (2, None), (None, "x" * 10), (1, "MIT License. mit license")])).collect() if r.doc_id}
    assert (out[1].n_words, out[1].n_base, out[1].first_word, out[1].last_word, out[1].labels, out[1].score) == (4, 2, 0, 2, "mit", 1.0)
    assert (out[2].n_words, out[2].n_base, out[2].first_word, out[2].labels, out[2].score) == (0, 0, None, "", 0.0)
