"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(LOWER)

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, coalesce({WORDS.format("text")}, []) AS w FROM documents),
i AS (SELECT item_id, {WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k FROM i WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, lengths WHERE len(w) >= n)
),
hit AS (SELECT doc_id, k, grams.n, item_id FROM grams JOIN win USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT k + j) AS n_hit FROM (SELECT doc_id, k, unnest(range(0, n)) AS j FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s COLLATE "C") AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


TERMS = r"regexp_extract_all({}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')".format(LOWER.format("coalesce(text, '')"))

DIVERGENCE = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {TERMS} AS w FROM documents
),
t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
p AS (
  SELECT lang, source, term, n,
    1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // CAST(sum(n) OVER (PARTITION BY lang, source) + 5 * v AS HUGEINT) AS p
  FROM (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n
        FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)) JOIN v USING (lang)
),
q AS (
  SELECT lang, term,
    1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // CAST(sum(n) OVER (PARTITION BY lang) + 5 * v AS HUGEINT) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL) JOIN v USING (lang)
),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f)
WHERE part = 'pair' OR rank <= 50
"""


HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = len([x FOR x IN embedding IF isfinite(x)])
),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
),
pos AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
neg AS (
  SELECT pos.a, pos.b AS p, pos.score AS ps, s.b AS n, s.score AS ns,
    row_number() OVER (PARTITION BY pos.a, pos.b ORDER BY s.score DESC, s.b) AS rank
  FROM pos JOIN s ON s.a = pos.a AND NOT s.same AND 50 * pos.score <= 100 * s.score AND 100 * s.score <= 95 * pos.score
)
SELECT a AS anchor_id, p AS positive_id, CAST(rank AS INTEGER) AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score
FROM neg WHERE rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_decontamination": DECONTAMINATION, "op11_hard_negatives": HARD_NEGATIVES, "op12_source_divergence": DIVERGENCE}
