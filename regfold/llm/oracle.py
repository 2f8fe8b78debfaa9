"""DuckDB SQL for the operators that SQL can express, written from their contracts."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  AND list_cosine_similarity(a.e, b.e) >= 0.93),
walk(vec_id, node) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT w.vec_id, l.b FROM walk w JOIN links l ON w.node = l.a),
comp AS (SELECT vec_id, min(node) AS component_id FROM walk GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM comp LEFT JOIN n USING (vec_id)
"""

OP3 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS pos
  FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS k FROM win) WHERE k > 1),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS t
  FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP8 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 10 * c >= 8 * (x.n + y.n - c)),
walk(doc_id, node) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT w.doc_id, l.b FROM walk w JOIN links l ON w.node = l.a),
comp AS (SELECT doc_id, min(node) AS class_id FROM walk GROUP BY doc_id),
k AS (SELECT a AS doc_id, count(*) AS k FROM links GROUP BY a)
SELECT doc_id, coalesce(k, 0)::BIGINT AS n_links, class_id, doc_id = class_id AS kept
FROM comp LEFT JOIN k USING (doc_id)
"""

OP10 = f"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS h,
         CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS key FROM documents),
src AS (
  SELECT key, any_value(source) AS source, sum(size)::BIGINT AS total FROM d GROUP BY key),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM src),
fill AS (
  SELECT *, sum(total) OVER () AS budget,
    coalesce(sum(3 * total) OVER (ORDER BY 3.0::DOUBLE * total / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(weight) OVER (ORDER BY 3.0::DOUBLE * total / weight, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM w),
t AS (
  SELECT *, least((3 * total)::DOUBLE, level * weight) AS target
  FROM (SELECT *, max((budget - before)::DOUBLE / rest::DOUBLE) OVER () AS level FROM fill)),
q AS (
  SELECT d.doc_id, d.size, d.h, d.key, total, weight, target, budget,
    sum(size) OVER (PARTITION BY d.key ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.key = t.key),
e AS (SELECT *, (turn * total + upto)::DOUBLE / weight AS finish FROM q, (SELECT unnest([0, 1, 2]) AS turn)),
run AS (SELECT *, sum(size) OVER (ORDER BY finish, key, h, doc_id, size ROWS UNBOUNDED PRECEDING) AS used FROM e)
SELECT doc_id, size, any_value(total) AS source_size, any_value(target) AS target,
       sum(CASE WHEN used <= budget THEN size ELSE 0 END)::BIGINT AS taken
FROM run GROUP BY doc_id, key, size
"""

# A-Z alone are lower-cased, and the ids of null and repeated documents order the rows of a score
OP12 = r"""
WITH terms AS (
  SELECT doc_id, row_number() OVER () AS row_no,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
total AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS words FROM terms WHERE len(w) > 0),
tf AS (
  SELECT row_no, any_value(doc_id) AS doc_id, term, any_value(n) AS n, count(*)::BIGINT AS tf
  FROM (SELECT row_no, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM terms) GROUP BY row_no, term),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weights AS (
  SELECT item_id, term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM asked JOIN df USING (term), total),
scores AS (
  SELECT item_id, row_no, any_value(doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words))))::BIGINT AS score
  FROM weights JOIN tf USING (term), total GROUP BY item_id, row_no),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

OP13 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id IS DISTINCT FROM c.vec_id AND len(q.e) = len(c.e)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

ORACLE = {"op1_embedding_dedup": OP1, "op3_substring_dedup": OP3, "op8_ngram_jaccard": OP8, "op10_mixing": OP10,
          "op12_lexical_search": OP12, "op13_top_products": OP13}
