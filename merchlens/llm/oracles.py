"""SQL forms of the corpus queries that SQL can express, for DuckDB."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"[^\x20\x09-\x0D]+"


def _shingles(words: str, width: int) -> str:
    """Distinct runs of ``width`` words of a list; a shorter list is one run."""
    return f"""list_distinct(CASE WHEN len({words}) >= {width}
        THEN list_transform(range(1, len({words}) - {width} + 2), lambda i: {words}[i:i + {width} - 1])
        WHEN len({words}) > 0 THEN [{words}] ELSE [] END)"""


OP4 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{SPACED}') AS w FROM documents),
sets AS (SELECT doc_id, {_shingles("w", 4)} AS s FROM words),
posts AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM posts a JOIN posts b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c AS component_id
FROM sets JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) ON a = doc_id
"""

OP7 = rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")},
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")},
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, w[i:i + 12] AS x FROM starts),
sizes AS (SELECT DISTINCT len(x) AS k FROM windows),
places AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM docs, sizes WHERE len(w) >= k),
found AS (SELECT doc_id, p, k, item_id FROM places JOIN windows ON w[p:p + k - 1] = x),
hits AS (SELECT doc_id, count(DISTINCT p + j) AS n_hit FROM found, unnest(range(k)) AS t(j) GROUP BY doc_id),
hit_items AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

OP9 = f"""
WITH parts AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS no FROM parts),
words AS (SELECT doc_id, no, regexp_extract_all({LOWER.format("line")}, '{SPACED}') AS w FROM lines),
sets AS (SELECT row_number() OVER (ORDER BY doc_id, no) AS id, doc_id, no, {_shingles("w", 5)} AS s
  FROM words WHERE len(w) >= 5),
posts AS (SELECT id, len(s) AS n, unnest(s) AS g FROM sets),
gone AS (SELECT DISTINCT later FROM (
  SELECT a.id AS later FROM posts a JOIN posts b ON a.g = b.g AND a.id > b.id
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*)))),
removed AS (SELECT DISTINCT doc_id, no FROM sets JOIN gone ON later = id),
kept AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY no) AS text
  FROM lines l LEFT JOIN removed r USING (doc_id, no) WHERE r.doc_id IS NULL GROUP BY l.doc_id),
touched AS (SELECT DISTINCT doc_id FROM removed)
SELECT d.doc_id, CASE WHEN t.doc_id IS NULL THEN d.text ELSE k.text END AS text
FROM documents d LEFT JOIN touched t USING (doc_id) LEFT JOIN kept k USING (doc_id)
WHERE t.doc_id IS NULL OR regexp_matches(coalesce(k.text, ''), '{SPACED}')
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP11 = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{TERM}') AS w FROM documents),
stats AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM docs WHERE len(w) > 0),
damping AS (SELECT doc_id, 50 + (50 * len(w) * n_docs) // n_terms AS m FROM docs, stats WHERE len(w) > 0),
items AS (SELECT DISTINCT item_id,
  unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{TERM}')) AS t FROM benchmark),
each AS (SELECT doc_id, unnest(w) AS t FROM docs),
tfs AS (SELECT doc_id, t, count(*) AS tf FROM each SEMI JOIN items USING (t) GROUP BY doc_id, t),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, stats GROUP BY t),
scores AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM items JOIN tfs USING (t) JOIN weights USING (t) JOIN damping USING (doc_id) GROUP BY item_id, doc_id),
ranks AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranks WHERE rank <= 50
"""


def _lloyd(rounds: int) -> str:
    """Assignments ``a1..`` and codebooks ``c1..`` of some rounds, and the last assignment."""
    distance = "list_sum(list_transform(list_zip(a.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    out = []
    for k in range(1, rounds + 2):
        out.append(f"""a{k} AS MATERIALIZED (SELECT a.vec_id, a.label, a.p, any_value(a.x) AS x,
          min({{'d': coalesce({distance}, 0), 'e': c.e}}) AS best
          FROM parts a JOIN c{k - 1} c ON a.p = c.p GROUP BY a.vec_id, a.label, a.p)""")
        if k <= rounds:
            out.append(f"""s{k} AS (SELECT p, best.e AS e, i, sum(x[i]) AS s, count(*) AS n
          FROM a{k}, unnest(range(1, len(x) + 1)) AS t(i) GROUP BY p, best.e, i),
        m{k} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x
          FROM s{k} GROUP BY p, e),
        c{k} AS MATERIALIZED (SELECT c.p, c.e, coalesce(m.x, c.x) AS x
          FROM c{k - 1} c LEFT JOIN m{k} m ON c.p = m.p AND c.e = m.e)""")
    return ",\n".join(out)


OP12 = f"""
WITH kept AS (SELECT vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, label, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS x
  FROM kept, unnest(range(4)) AS t(p)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 256),
c0 AS MATERIALIZED (SELECT p, e, x FROM parts JOIN first USING (vec_id)),
{_lloyd(4)},
codes AS (SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code,
    CAST(sum(best.d) AS BIGINT) AS error FROM a5 GROUP BY vec_id, label),
labels AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM codes GROUP BY label),
books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c4)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM codes JOIN labels ON codes.label IS NOT DISTINCT FROM labels.label, books
"""

ORACLES = {
    "op4_ngram_join": OP4,
    "op7_decontamination": OP7,
    "op9_line_dedup": OP9,
    "op11_lexical_search": OP11,
    "op12_vector_codes": OP12,
}
