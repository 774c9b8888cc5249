"""SQL of the queries that SQL can express, for DuckDB on the same tables."""

from __future__ import annotations

_REACH = """reach(r, c) AS (
  SELECT r, r FROM {rows} UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.c),
least AS (SELECT reach.r, min(o.{key}) AS component_id FROM reach JOIN {rows} o ON o.r = reach.c GROUP BY reach.r)"""

ORACLES = {
    "op8_ngram_jaccard": r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM words),
grams AS (SELECT r, len(g) AS n, unnest(g) AS g FROM sets),
pairs AS (
  SELECT a.r AS a, b.r AS b FROM grams a JOIN grams b ON a.g = b.g AND a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs),
""" + _REACH.format(rows="sets", key="doc_id") + """
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id FROM sets JOIN least USING (r)""",
    "op10_near_vectors": """
WITH RECURSIVE rows_ AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
usable AS (
  SELECT r, label, v FROM rows_ WHERE label IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.r AS a, b.r AS b FROM usable a JOIN usable b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
""" + _REACH.format(rows="rows_", key="vec_id") + """,
counts AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM rows_ JOIN least USING (r) LEFT JOIN counts USING (r)""",
    "op11_exact_stream": """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST, r DESC) = 1 AS kept, sha256(t) AS text_sha256
FROM texts""",
    "op12_vector_codes": """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, p, list_slice(v, p * (len(v) // 16) + 1, (p + 1) * (len(v) // 16)) AS x FROM kept, range(16) AS t(p)),
books0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 64),
""" + "".join(f"""coded{n} AS MATERIALIZED (
  SELECT r, p, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + e) AS m
  FROM parts JOIN books{n} USING (p) GROUP BY r, p),
""" + (f"""components{n} AS (SELECT p, m % 64 AS e, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS y FROM coded{n} JOIN parts USING (r, p)),
means{n} AS (SELECT p, e, i, CAST(floor(sum(y)::DOUBLE / count(*)) AS BIGINT) AS y FROM components{n} GROUP BY p, e, i),
books{n + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM books{n} b LEFT JOIN (SELECT p, e, list(y ORDER BY i) AS c FROM means{n} GROUP BY p, e) m USING (p, e)),
""" if n < 2 else "") for n in range(3)) + """codes AS MATERIALIZED (
  SELECT r, string_agg(printf('%02x', CAST(m % 64 AS BIGINT)), '' ORDER BY p) AS code, CAST(sum(CAST(m AS BIGINT) // 64) AS BIGINT) AS error
  FROM coded2 GROUP BY r),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM books2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (r), digest""",
}
