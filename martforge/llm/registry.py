"""The queries of this package and their DuckDB SQL, where SQL can say it."""

from __future__ import annotations

from . import (centroids, collocations, exact_dedup, languages, mixing, pii, quality, secrets, sentencepiece, simhash,
               suffix_dedup, toxicity, warc)
from .common import table


def op1_warc(spark, sf_dir):
    return warc.archive_pages(table(spark, sf_dir, "pages")) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_suffix_dedup(spark, sf_dir):
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")) \
        .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_mix_sources(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_pseudonyms(spark, sf_dir):
    return pii.pseudonymise(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark, sf_dir):
    return sentencepiece.tokenised(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("n_chunks")


def op7_quality_rules(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents"))


def op8_simhash(spark, sf_dir):
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, radius=2) \
        .select("doc_id", "fingerprint", "component_id")


def op9_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_secrets(spark, sf_dir):
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op11_languages(spark, sf_dir):
    return languages.identify(table(spark, sf_dir, "documents"))


def op12_centroids(spark, sf_dir):
    return centroids.clustered(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dimension=64, scale=256, seed=2)


def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"), threshold=30, top=2000, fragment_percent=80)


# Base 32 of the 40 hex digits, 20 bits (5 digits, 4 letters) at a time.
OP1_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS p FROM pages),
digests AS (
  SELECT page_id, strlen(p) AS payload_bytes, sha1(p) AS sha FROM payloads),
coded AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
              1 + ((('0x' || substr(sha, 5 * (i // 4) + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31)::INTEGER, 1)), '') AS payload_digest,
         min(page_id) OVER (PARTITION BY sha) AS first_id
  FROM digests)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM coded
"""

OP3_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM sizes GROUP BY source),
weighed AS (SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::BIGINT AS weight,
                   source_size * 3 AS cap FROM per),
filling AS (
  SELECT *, cap::DOUBLE / weight AS full_at,
         ((SELECT sum(source_size) FROM weighed)
            - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed),
water AS (SELECT level FROM filling WHERE level <= full_at ORDER BY full_at, rk LIMIT 1),
targets AS (SELECT source, source_size, rk, least(cap::DOUBLE, (SELECT level FROM water) * weight) AS target FROM filling),
queued AS (
  SELECT s.doc_id, s.size, t.source, t.source_size, t.rk, t.target,
         sum(s.size) OVER (PARTITION BY t.rk ORDER BY md5('mix-1:' || s.doc_id::VARCHAR), s.doc_id, s.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS cum
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
offered AS (SELECT *, (e * source_size + cum)::DOUBLE / target AS finish
            FROM queued, (VALUES (0), (1), (2)) v(e) WHERE size > 0 AND target > 0),
sent AS (SELECT *, sum(size) OVER (ORDER BY finish, rk, e, cum ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM offered),
taken AS (SELECT rk, doc_id, cum, count(*) AS copies FROM sent
          WHERE running <= (SELECT sum(source_size) FROM targets) GROUP BY ALL)
SELECT q.doc_id, q.size, q.source, q.source_size, q.target,
       coalesce(q.size * t.copies, 0)::BIGINT AS taken,
       (CASE WHEN q.size = 0 THEN 0 ELSE coalesce(t.copies, 0) END)::INTEGER AS copies
FROM queued q LEFT JOIN taken t ON t.rk = q.rk AND t.doc_id IS NOT DISTINCT FROM q.doc_id AND t.cum = q.cum
"""

OP6_SQL = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)
"""

OP7_SQL = r"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
words AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                 list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM texts),
grams AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM words WHERE len(w) >= 3),
twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS n FROM grams),
covered AS (SELECT rid, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) v(o) WHERE n > 1 GROUP BY rid),
measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN covered c USING (rid)),
bits AS (
  SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
          + CASE WHEN 4 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END
          + CASE WHEN word_chars > 20 * n_words THEN 16 ELSE 0 END
          + CASE WHEN 2 * n_dup_lines > n_lines THEN 32 ELSE 0 END AS fail_bits
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, n_lines, fail_bits::BIGINT AS fail_bits
FROM bits
"""


def _centroid_rounds(rounds: int) -> str:
    """One assignment and one update per round. A distance and the number of
    its centroid share one number, whose minimum settles ties."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT rid, min((vv - 2 * list_inner_product(v, cv) + cc)::HUGEINT * 64 + c) AS code FROM kept, c{r} GROUP BY rid)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (SELECT code % 64 AS c, i, sum(x::HUGEINT) AS s, count(*) AS n
         FROM (SELECT code, unnest(v) AS x, unnest(range(64)) AS i FROM a{r} JOIN kept USING (rid)) GROUP BY ALL),
m{r} AS (SELECT c, list(((s - (s % n + n) % n) // n)::DOUBLE ORDER BY i) AS cv FROM s{r} GROUP BY c),
c{r + 1} AS MATERIALIZED (
  SELECT c, coalesce(m.cv, o.cv) AS cv, list_inner_product(coalesce(m.cv, o.cv), coalesce(m.cv, o.cv)) AS cc
  FROM c{r} o LEFT JOIN m{r} m USING (c))""")
    return ",".join(steps)


OP12_SQL = f"""
WITH finite AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
kept AS MATERIALIZED (SELECT *, list_inner_product(v, v) AS vv FROM finite),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR) NULLS LAST, v) - 1)::BIGINT AS c, v AS cv, vv AS cc
  FROM kept ORDER BY sha256('2:' || vec_id::VARCHAR) NULLS LAST, v LIMIT 40),{_centroid_rounds(5)},
assigned AS (SELECT rid, code % 64 AS c, (code // 64)::BIGINT AS distance FROM a5),
digests AS (SELECT c, sha256(array_to_string(list_transform(cv, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256 FROM c5)
SELECT vec_id, c::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM assigned JOIN kept USING (rid) JOIN digests USING (c)
"""

OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
          FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3), (4)) v(k))),
f AS MATERIALIZED (SELECT lang, k AS len, phrase, count(*)::HUGEINT AS n FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT lang, phrase, len, n AS a, string_split(phrase, ' ') AS w, unnest(range(1, len)) AS k FROM f WHERE len >= 2),
scored AS (
  SELECT c.lang, c.phrase, c.len, c.a, c.k, l.n AS l, r.n AS r, (2000000 * c.a) // (l.n + r.n) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
              JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (
  SELECT DISTINCT c.lang, array_to_string(w[s:s + z - 1], ' ') AS phrase, c.a
  FROM (SELECT lang, w, a, z, unnest(range(1, len - z + 2)) AS s
        FROM (SELECT DISTINCT lang, phrase, w, len, a, unnest(range(2, len)) AS z FROM cuts)) c),
most AS (SELECT lang, phrase, max(a) AS longer FROM inner_parts GROUP BY ALL),
kept AS (SELECT x.* FROM lowest x LEFT JOIN most m USING (lang, phrase) WHERE m.longer IS NULL OR 100 * m.longer < 80 * x.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a,
       l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""

QUERIES = {
    "op1_warc": op1_warc,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_mix_sources": op3_mix_sources,
    "op4_pseudonyms": op4_pseudonyms,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_simhash": op8_simhash,
    "op9_toxicity": op9_toxicity,
    "op10_secrets": op10_secrets,
    "op11_languages": op11_languages,
    "op12_centroids": op12_centroids,
    "op13_collocations": op13_collocations,
}
ORACLE = {
    "op1_warc": OP1_SQL,
    "op3_mix_sources": OP3_SQL,
    "op6_exact_dedup": OP6_SQL,
    "op7_quality_rules": OP7_SQL,
    "op12_centroids": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
