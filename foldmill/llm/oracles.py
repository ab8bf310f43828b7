"""What some of the queries return, in SQL that DuckDB runs on the same tables."""

CHAT_FORMAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL
  SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
-- An escape is put before each backslash and into each start of a control string.
sized AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
      + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0)
      + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS text_size,
    length(role) + length(role) - length(replace(replace(replace(role, '\', ''), ':', ''), chr(10), ''))
      + coalesce(list_sum(list_transform(regexp_extract_all(role, '#{3,}'), lambda x: length(x) - 2)), 0)
      + (length(role) - length(replace(role, '</turn>', ''))) // 7 AS role_size
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(4 + role_size + 2 + text_size + 8) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""

SUBSTRING_DEDUP = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS key FROM starts),
placed AS (SELECT doc_id, i, row_number() OVER (PARTITION BY key ORDER BY doc_id, i) AS nth FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM placed WHERE nth > 1),
single AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept
         FROM single ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

# Texts as hexadecimal digits, two per byte.
SUFFIX_DEDUP = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM d),
windows AS MATERIALIZED (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS key FROM starts),
firsts AS (SELECT key, min({'doc_id': doc_id, 'i': i}) AS f FROM windows GROUP BY key HAVING count(*) > 1),
again AS (SELECT doc_id, i FROM windows JOIN firsts USING (key) WHERE doc_id <> f.doc_id OR i <> f.i),
-- Repeated windows that overlap or touch are one run.
marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM again),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY doc_id, run),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM runs),
kept AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS last,
           string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS before
         FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(before, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score FROM scores QUALIFY rank <= 10"""


HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id,
    CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5"""

# Equal vectors are one row here; all pairs of the others are compared.
EMBEDDING_LINKS = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS one, b.vec_id AS other FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
reached(vec_id, component_id) AS (
  SELECT DISTINCT one, one FROM links
  UNION
  SELECT other, component_id FROM reached JOIN links ON vec_id = one WHERE component_id < other),
least AS (SELECT vec_id, min(component_id) AS component_id FROM reached GROUP BY vec_id),
degree AS (SELECT one AS vec_id, count(*) AS n FROM links GROUP BY one)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
  coalesce(component_id, vec_id) = vec_id AS kept
FROM (SELECT vec_id FROM embeddings WHERE vec_id IS NOT NULL) AS e
LEFT JOIN least USING (vec_id) LEFT JOIN degree USING (vec_id)"""
