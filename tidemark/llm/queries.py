"""The training-data queries by name, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import folder
from . import exact_dedup, host_rules, langid, license_scan, lm_score, minhash_join, mixing, packing, pseudonyms, token_count, turn_repair, vector_codes, warc_store
from .base import table

#: Vocabularies of the production queries.
PACK_VOCABULARY, COUNT_VOCABULARY = "word_bpe_49k.json", "piece_bpe_32k.model"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("heavy")


def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = host_rules.host_rules(table(spark, sf_dir, "documents"))
    return out.drop("source", *(c for c in out.columns if c.startswith("rate_")))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path(PACK_VOCABULARY))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymised(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents")).drop("matches")


def op8_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.minhash_join(table(spark, sf_dir, "documents"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(COUNT_VOCABULARY))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repaired(turn_repair.damaged(table(spark, sf_dir, "conversations")))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.coded(table(spark, sf_dir, "embeddings")).drop("label")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc_store.write_archive(table(spark, sf_dir, "pages"), folder(spark, "archive"))
    out = warc_store.read_back(spark, path)
    return out.withColumns({"page_id": F.col("page_id_text").cast("long"), "refers_to": F.col("refers_to_text").cast("long")}).drop("page_id_text", "refers_to_text")


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_host_rules, op3_packing, op4_mixing, op5_pseudonyms, op6_language_id, op7_license_scan, op8_minhash_join, op9_lm_scores, op10_token_counts, op11_turn_repair, op12_vector_codes, op13_warc)}



def _regex(template: str) -> str:
    """A licence template as a regular expression over words with a space before each."""
    out = ""
    for x in license_scan._MARKUP.findall(template):
        if x == "[[":
            out += "(?:"
        elif x == "]]":
            out += ")?"
        elif x[0] == "{" and ":" in x:
            out += "(?: [^ ]+){" + x[1:-1].split(":")[1].replace("-", ",") + "}"
        elif x[0] == "{":
            out += "(?:" + "|".join("".join(" " + w for w in c.split()) for c in x[1:-1].split("|")) + ")"
        else:
            out += " " + x
    return out


def _most_words(template: str) -> int:
    """Words of a template's longest reading, at most."""
    return sum(int(x.split("-")[1][:-1]) if ":" in x else max(len(c.split()) for c in x[1:-1].split("|")) if x[0] == "{" else x not in ("[[", "]]") for x in license_scan._MARKUP.findall(template))


def _license_sql() -> str:
    most = max(map(_most_words, license_scan.TEMPLATES.values())) + 1
    templates = ", ".join(f"('{k}', '^({_regex(t)})(?: |$)')" for k, t in license_scan.TEMPLATES.items())
    starts = ", ".join(sorted({f"'{w.decode()}'" for _, a in license_scan.compiled() for w in a.starts}))
    phrases = ", ".join(f"('{label}', ' {p} ')" for p, label in license_scan.PHRASES.items())
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
likely AS (SELECT doc_id, i - 1 AS i, ' ' || array_to_string(w[i:i + {most}], ' ') || ' ' AS rest FROM places WHERE w[i] IN ({starts}) OR w[i] IN ('mit', 'apache', 'general')),
base AS (SELECT doc_id, i, len(string_split(trim(p), ' ')) AS n, label FROM likely, (VALUES {phrases}) v(label, p) WHERE starts_with(rest, p)),
more AS (SELECT doc_id, i, len(string_split(trim(regexp_extract(rest, re, 1)), ' ')) AS n, label FROM likely, (VALUES {templates}) t(label, re) WHERE regexp_matches(rest, re)),
found AS (SELECT * FROM base UNION ALL SELECT * FROM more),
b AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
f AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM found GROUP BY doc_id),
c AS (SELECT doc_id, count(DISTINCT k) AS covered FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN len(w) = 0 THEN 0.0::DOUBLE ELSE coalesce(covered, 0) / len(w) END AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN f USING (doc_id) LEFT JOIN c USING (doc_id)
"""


#: Earliest deadline first, slot by slot; h is how many blocks each source has had.
_MIXING_SQL = f"""
WITH RECURSIVE n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
w AS (SELECT source, n, row_number() OVER (ORDER BY n DESC, source NULLS LAST) - 1 AS s, (n + {mixing.BLOCK - 1}) // {mixing.BLOCK} AS blocks, pow(n, {mixing.ALPHA}) / (SELECT sum(pow(n, {mixing.ALPHA})) FROM n) * {mixing.FRAME} AS exact FROM n),
f AS (SELECT *, floor(exact)::HUGEINT + CASE WHEN row_number() OVER (ORDER BY floor(exact) - exact, s) <= {mixing.FRAME} - sum(floor(exact)::HUGEINT) OVER () THEN 1 ELSE 0 END AS k FROM w),
c AS (SELECT list(k ORDER BY s) AS k, list(blocks ORDER BY s) AS b, count(*) AS m FROM f),
e AS (
  SELECT 0::HUGEINT AS t, list_transform(range(0, m), lambda i: 0::HUGEINT) AS h, -1::HUGEINT AS s, 0::HUGEINT AS block FROM c
  UNION ALL
  SELECT t + 1, list_transform(range(0, m), lambda i: h[i + 1] + CASE WHEN i = p THEN 1 ELSE 0 END), p, h[p::BIGINT + 1]
  FROM (SELECT t, h, m, list_min(list_transform(list_filter(range(0, m), lambda i: h[i + 1] * {mixing.FRAME} // k[i + 1] <= t), lambda i: ((h[i + 1] + 1) * {mixing.FRAME} + k[i + 1] - 1) // k[i + 1] * 1000000 + i)) % 1000000 AS p
    FROM e, c WHERE len(list_filter(range(0, m), lambda i: h[i + 1] < b[i + 1])) > 0)
),
d AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY substr(sha256(coalesce(doc_id::VARCHAR, '')), 1, 15), doc_id) - 1 AS r FROM documents)
SELECT doc_id, d.source, ((block * {mixing.BLOCK} + x.inside) // n)::BIGINT AS epoch, block::BIGINT AS block, (t - 1)::BIGINT AS slot,
  (block * {mixing.FRAME} // k)::BIGINT AS release, (((block + 1) * {mixing.FRAME} + k - 1) // k)::BIGINT AS deadline, ((t - 1) * {mixing.BLOCK} + x.inside)::BIGINT AS position
FROM e JOIN f ON f.s = e.s, range({mixing.BLOCK}) AS x(inside), d
WHERE d.source IS NOT DISTINCT FROM f.source AND d.r = (block * {mixing.BLOCK} + x.inside) % n
"""


#: Damage by crc32 worked out bit by bit, then costs to go from the last turn to the first, then the walk, a turn or an insert at a time.
_TURNS_SQL = r"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT)),
      lambda a, x: list_reduce(list_prepend(xor(a, x), range(8)), lambda b, y: xor(b >> 1, 3988292384 * (b & 1)))), 4294967295) % 20 AS kind
  FROM conversations
), d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM k, range(2) AS r(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
), o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role)::VARCHAR || ':' || role || text)) AS i FROM d),
f AS (
  SELECT *, substr(role, 1, 1) AS c, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1) AS pair FROM o
), g AS (SELECT *, blank OR seen AS gone, CASE WHEN cut THEN 3 ELSE 0 END AS own FROM f),
n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE seen AND NOT blank) AS duplicate,
  count(*) FILTER (WHERE cut AND NOT blank AND NOT seen) AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id),
b AS (  -- costs before turn i + 1: of no turn, s, u, a so far
  SELECT conv_id, n AS i, 0::BIGINT AS p, 6::BIGINT AS s, 3::BIGINT AS u, 0::BIGINT AS a FROM n
  UNION ALL
  SELECT conv_id, i, least(p, least(u, a + 3) + 3), least(s, least(u, a + 3) + 3), least(u, a + 3), least(a, u + 3) FROM (
    SELECT b.conv_id, b.i - 1 AS i,
      least(b.p + 4, CASE WHEN gone THEN 1000000000 WHEN c = 'u' THEN own + b.u WHEN c = 's' THEN least(own + b.s, own + 3 + b.u) ELSE own + 3 + b.u END) AS p,
      least(b.s + 4, CASE WHEN gone THEN 1000000000 WHEN c = 'u' THEN own + b.u ELSE own + 3 + b.u END) AS s,
      least(b.u + 4, CASE WHEN gone THEN 1000000000 WHEN c = 'a' THEN own + b.a ELSE own + 3 + b.a END) AS u,
      least(b.a + 4, CASE WHEN gone THEN 1000000000 WHEN c = 'u' THEN own + b.u ELSE own + 3 + b.u END) AS a
    FROM b JOIN g ON g.conv_id IS NOT DISTINCT FROM b.conv_id AND g.i = b.i)
), v AS (SELECT conv_id, i, 0 AS q, p AS v, u + 3 AS ins FROM b UNION ALL SELECT conv_id, i, 1, s, u + 3 FROM b UNION ALL SELECT conv_id, i, 2, u, a + 3 FROM b UNION ALL SELECT conv_id, i, 3, a, u + 3 FROM b),
w AS (  -- by turn and state: the edit, and the state after it; z: a turn is used up
  SELECT v.conv_id, v.i, v.q, CASE WHEN x.v + 4 = v.v THEN 'D' WHEN v.ins = v.v THEN 'I' WHEN g.i IS NULL THEN NULL
      WHEN NOT gone AND ((c = CASE WHEN v.q = 2 THEN 'a' ELSE 'u' END AND y.v + own = v.v) OR (c = 's' AND v.q = 0 AND t.v + own = v.v)) THEN 'K' ELSE 'R' END AS e,
    CASE WHEN x.v + 4 = v.v THEN v.q WHEN v.ins <> v.v AND NOT gone AND c = 's' AND v.q = 0 AND t.v + own = v.v THEN 1 WHEN v.q = 2 THEN 3 ELSE 2 END AS q2,
    g.role, g.text
  FROM v LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM v.conv_id AND g.i = v.i + 1
    LEFT JOIN v x ON x.conv_id IS NOT DISTINCT FROM v.conv_id AND x.i = v.i + 1 AND x.q = v.q
    LEFT JOIN v y ON y.conv_id IS NOT DISTINCT FROM v.conv_id AND y.i = v.i + 1 AND y.q = CASE WHEN v.q = 2 THEN 3 ELSE 2 END
    LEFT JOIN v t ON t.conv_id IS NOT DISTINCT FROM v.conv_id AND t.i = v.i + 1 AND t.q = 1
), path AS (
  SELECT conv_id, 0 AS step, 0::BIGINT AS i, 0 AS q, '' AS e, NULL::VARCHAR AS line FROM n
  UNION ALL
  SELECT p.conv_id, p.step + 1, p.i + CASE WHEN w.e = 'I' THEN 0 ELSE 1 END, w.q2, w.e,
    CASE w.e WHEN 'D' THEN NULL WHEN 'K' THEN w.role || ':' || w.text WHEN 'I' THEN CASE w.q2 WHEN 3 THEN 'assistant:' ELSE 'user:' END ELSE CASE w.q2 WHEN 3 THEN 'assistant:' ELSE 'user:' END || w.text END
  FROM path p JOIN w ON w.conv_id IS NOT DISTINCT FROM p.conv_id AND w.i = p.i AND w.q = p.q WHERE w.e IS NOT NULL
), r AS (SELECT conv_id, string_agg(e, '' ORDER BY step) AS audit, sha256(coalesce(string_agg(line, chr(10) ORDER BY step), '')) AS repaired_sha256 FROM path GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(b.p, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = 0 LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def _codes_sql(parts: int = vector_codes.PARTS, rounds: int = vector_codes.ROUNDS) -> str:
    """Rounds of assignment to, and averages of, entries, written out one after another."""
    out = rf"""WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label, list_transform(embedding, lambda v: floor(v::DOUBLE * {vector_codes.SCALE})::BIGINT) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR isnan(v) OR isinf(v))) = 0),
p AS (SELECT rid, part, list_transform(range(1, len(x) // {parts} + 1), lambda i: x[part * (len(x) // {parts}) + i]) AS y FROM kept, range({parts}) AS r(part)),
b0 AS (SELECT part, rid - 1 AS entry, y AS c FROM p WHERE rid <= {vector_codes.ENTRIES})"""
    for k in range(rounds + 1):
        out += f""",
d{k} AS (SELECT rid, p.part, entry, y, list_sum(list_transform(range(1, len(y) + 1), lambda i: (y[i] - c[i]) * (y[i] - c[i])))::BIGINT AS dist FROM p JOIN b{k} b ON b.part = p.part),
a{k} AS (SELECT rid, part, y, entry, dist FROM (SELECT *, row_number() OVER (PARTITION BY rid, part ORDER BY dist, entry) AS r FROM d{k}) WHERE r = 1)"""
        if k < rounds:
            out += f""",
m{k} AS (SELECT part, entry, list(m ORDER BY i) AS c FROM (SELECT part, entry, i, CASE WHEN sum(v) >= 0 THEN sum(v)::BIGINT // count(*) ELSE -((-sum(v)::BIGINT + count(*) - 1) // count(*)) END AS m
  FROM (SELECT part, entry, unnest(y) AS v, generate_subscripts(y, 1) AS i FROM a{k}) GROUP BY part, entry, i) GROUP BY part, entry),
b{k + 1} AS (SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN m{k} m ON m.part = b.part AND m.entry = b.entry)"""
    return out + f""",
s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds}),
e AS (SELECT rid, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error FROM a{rounds} GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN e USING (rid), s"""


ORACLES = {
    "op11_turn_repair": _TURNS_SQL,
    "op12_vector_codes": _codes_sql(),
    "op13_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, octet_length(encode(t))::BIGINT AS n, sha1(t) AS payload_digest, count(*) OVER w AS c, row_number() OVER w2 AS r, first_value(page_id) OVER w2 AS top FROM p
  WINDOW w AS (PARTITION BY t), w2 AS (PARTITION BY t ORDER BY page_id DESC NULLS LAST))
SELECT page_id, n AS payload_bytes, payload_digest, CASE WHEN n >= {warc_store.LEAST} AND r > 1 THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN n >= {warc_store.LEAST} AND r > 1 THEN top END AS refers_to FROM h
""",
    "op4_mixing": _MIXING_SQL,
    "op7_license_scan": _license_sql(),
    "op1_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT doc_id, text_sha256, row_number() OVER w AS r, first_value(doc_id) OVER w AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, r = 1 AS kept, text_sha256 FROM g
""",
    "op2_host_rules": r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS l FROM d)),
g AS (SELECT doc_id, pos, word || ' ' || lead(word, 1) OVER v || ' ' || lead(word, 2) OVER v || ' ' || lead(word, 3) OVER v || ' ' || lead(word, 4) OVER v AS gram
  FROM w WINDOW v AS (PARTITION BY doc_id ORDER BY pos)),
twice AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g WHERE gram IS NOT NULL) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT pos + k) AS n FROM twice, range(5) AS r(k) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
c AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY doc_id),
f AS (
  SELECT d.doc_id, source, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM d LEFT JOIN c USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    n_symbols > 0.5 * n_words AS symbol_heavy, n_dup_lines > 0.05 * n_words AS line_repeats FROM f
), k AS (
  SELECT source, r.rule, count(*) AS n, count(*) FILTER (WHERE CASE r.rule WHEN 1 THEN base_failed WHEN 2 THEN symbol_heavy ELSE line_repeats END) AS bad
  FROM b, range(1, 4) AS r(rule) WHERE source IS NOT NULL GROUP BY source, r.rule
), m AS (
  SELECT rule, count(*) AS hosts, sum(bad) / sum(n) AS p, avg(bad / n) AS mean, var_samp(bad / n) AS var, avg(1 / n) AS inverse FROM k GROUP BY rule
), prior AS (
  SELECT rule, CASE WHEN hosts > 1 AND mean > 0 AND mean < 1 THEN mean ELSE p END AS p,
    CASE WHEN hosts > 1 AND mean > 0 AND mean < 1 THEN CASE WHEN var - mean * (1 - mean) * inverse <= 0 THEN 10000
      ELSE least(10000, greatest(2, mean * (1 - mean) / (var - mean * (1 - mean) * inverse) - 1)) END ELSE 2 END AS weight FROM m
), gone AS (SELECT DISTINCT source FROM k JOIN prior USING (rule) WHERE (bad + p * weight) / (n + weight) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND gone.source IS NULL AS kept
FROM b LEFT JOIN gone ON b.source = gone.source
""",
    "op8_minhash_join": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS l FROM documents),
t AS (SELECT array_to_string(l, ' ') AS cls, min(doc_id) AS text_id, count(*) AS n_copies, any_value(l) AS l FROM d GROUP BY cls),
g AS (SELECT DISTINCT text_id, array_to_string(l[i:i + 4], ' ') AS gram
  FROM (SELECT text_id, l, unnest(range(1, greatest(len(l) - 3, 2))) AS i FROM t WHERE len(l) > 0)),
n AS (SELECT text_id, count(*) AS n FROM g GROUP BY text_id),
p AS (SELECT a.text_id AS a, b.text_id AS b, count(*) AS both_have FROM g a JOIN g b ON a.gram = b.gram AND a.text_id < b.text_id GROUP BY 1, 2),
k AS (SELECT a, b FROM p JOIN n x ON x.text_id = a JOIN n y ON y.text_id = b WHERE both_have >= 0.8 * (x.n + y.n - both_have)),
e AS (SELECT a, b FROM k UNION ALL SELECT b, a FROM k),
reach AS (SELECT a AS v, a AS u FROM e UNION SELECT reach.v, e.b FROM reach JOIN e ON e.a = reach.u),
c AS (SELECT v, min(u) AS class_id FROM reach GROUP BY v),
links AS (SELECT a AS v, count(*) AS n_links FROM e GROUP BY a)
SELECT doc_id, coalesce(c.class_id, t.text_id) AS class_id, coalesce(n_links, 0) AS n_links, t.text_id, n_copies
FROM d JOIN t ON array_to_string(d.l, ' ') = t.cls LEFT JOIN c ON c.v = t.text_id LEFT JOIN links ON links.v = t.text_id
""",
}
