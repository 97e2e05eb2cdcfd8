"""Queries on labelled clusters, their coverage and the policy gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cluster as O
from ..sources.lists import domain_table
from . import fixtures as T
from .fixtures import PARTS_SQL

QUERIES, ORACLES = {}, {}

#: A taxonomy over part names; one pattern matches nothing.
DOMAINS = [("cold", "^(?:blue|cold)"), ("small", "SMALL"), ("rings", r"\bring\b"), ("doubles", "(?:oo|ll|ss|ee|rr)"), ("none", "zzzz")]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _rows(spark, d):
    p = T.parts(spark, d)
    return O.with_titles(p.select("id", "words"), p)


def _hits(spark, d):
    return O.labelled(_rows(spark, d), DOMAINS)


_VALUES = ", ".join(f"({i}, '{k}', '{p}')" for i, (k, p) in enumerate(DOMAINS))
_TAXONOMY = f"(SELECT * FROM (VALUES {_VALUES}) v(ord, domain, pattern))"
_HITS = f"(SELECT p.*, domain FROM {PARTS_SQL} p JOIN {_TAXONOMY} t ON regexp_matches(title, pattern, 'i'))"


@query(f"SELECT domain, row_number() OVER (PARTITION BY domain ORDER BY views DESC, id) AS place, id, title, views, words FROM {_HITS}")
def cluster_members(spark, d):
    return O.members(_hits(spark, d))


@query(f"SELECT domain, id FROM {_HITS}")
def cluster_by_table(spark, d):
    return O.labelled_by_table(_rows(spark, d), domain_table(spark, DOMAINS)).select("domain", "id")


#: A taxonomy of a pattern for each pair of words that a name may begin with, as people write them, and some of more kinds.
_WORDS = ("blue", "cold", "small", "ring", "green", "large", "bolt", "gear", "steel", "valve", "pump", "red")
MANY = [(f"{a}-{b}", rf"\b(?P<first>{a})\b.*{b}") for a in _WORDS for b in _WORDS] + [(f"either-{i}", f"(?:{a}|{b}s?) ?[a-z]") for i, (a, b) in enumerate(zip(_WORDS, _WORDS[1:]))] + [("two letters", "^.[oe]"), ("not even one", "q[0-9]{3}zz")]
_MANY_VALUES = ", ".join(f"({i}, '{k}', '{p}')" for i, (k, p) in enumerate(MANY))


@query(f"SELECT domain, count(*) AS videos, sum(words)::BIGINT AS words, min(id) AS first_id, max(id) AS last_id FROM {PARTS_SQL} p JOIN (VALUES {_MANY_VALUES}) t(ord, domain, pattern) ON regexp_matches(title, pattern, 'i') GROUP BY domain")
def cluster_many_patterns(spark, d):
    """Labels by an index of the texts that patterns need (J4); patterns in Python's dialect."""
    hits = O.labelled_by_index(_rows(spark, d), MANY)
    return hits.groupBy("domain").agg(F.count("*").alias("videos"), F.sum("words").alias("words"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


_SUMMARY = f"(SELECT ord, t.domain, count(id) AS videos, coalesce(sum(words), 0)::BIGINT AS words FROM {_TAXONOMY} t LEFT JOIN {_HITS} h ON h.domain = t.domain GROUP BY ord, t.domain)"


@query(f"SELECT * FROM {_SUMMARY}")
def cluster_summary(spark, d):
    return O.summary(_hits(spark, d), domain_table(spark, DOMAINS))


@query(f"SELECT id, title FROM {PARTS_SQL} WHERE id NOT IN (SELECT id FROM {_HITS})")
def unlabelled(spark, d):
    return O.unlabelled(_rows(spark, d), _hits(spark, d)).select("id", "title")


@query(f"SELECT id, substr(title, 1, 78) AS title FROM {PARTS_SQL} WHERE id NOT IN (SELECT id FROM {_HITS} WHERE domain <> 'doubles') ORDER BY id LIMIT 15")
def unlabelled_sample(spark, d):
    return O.unlabelled_sample(_rows(spark, d), _hits(spark, d).filter("domain <> 'doubles'"))


@query(f"SELECT * FROM (SELECT domain, row_number() OVER (PARTITION BY domain ORDER BY views DESC, id) AS place, id, views FROM {_HITS}) WHERE place <= 10")
def cluster_topk(spark, d):
    return O.top_members(_hits(spark, d), 10).select("domain", "place", "id", "views")


@query(f"SELECT transcripts, labelled, transcripts - labelled AS unlabelled, (transcripts - labelled) / transcripts AS share, (transcripts - labelled) / transcripts < 0.15 AS wide_enough FROM (SELECT count(*) AS transcripts, (SELECT count(DISTINCT id) FROM {_HITS}) AS labelled FROM {PARTS_SQL})")
def cluster_coverage(spark, d):
    return O.coverage(_rows(spark, d), _hits(spark, d))


@query(f"SELECT *, videos < 15 OR words < 40000 AS fold FROM {_SUMMARY}")
def domain_gate(spark, d):
    return O.domain_gate(O.summary(_hits(spark, d), domain_table(spark, DOMAINS)))


@query(f"SELECT count(*) AS transcripts, sum(words)::BIGINT AS words, CASE WHEN count(*) < 15 THEN 'decline' WHEN count(*) < 40 OR sum(words) < 100000 THEN 'one' ELSE 'several' END AS verdict FROM {PARTS_SQL}")
def corpus_gate(spark, d):
    return O.corpus_gate(_rows(spark, d))


@query(f"SELECT t.ord, t.domain, coalesce(string_agg(id || ':' || views::VARCHAR, ',' ORDER BY views DESC, id), '') AS members FROM {_TAXONOMY} t LEFT JOIN {_HITS} h ON h.domain = t.domain GROUP BY t.ord, t.domain")
def cluster_nested(spark, d):
    out = O.nested(_hits(spark, d), domain_table(spark, DOMAINS))
    return out.select("ord", "domain", F.array_join(F.transform("members", lambda m: F.concat(m["id"], F.lit(":"), m["views"].cast("string"))), ",").alias("members"))
