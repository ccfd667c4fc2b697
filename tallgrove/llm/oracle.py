"""Check SQL (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(4 + 2 + 8 + length(regexp_replace(role, '[\\#<:]', '__', 'g')) + length(regexp_replace(text, '[\\#<]', '__', 'g')))::BIGINT
    AS formatted_chars
FROM turns GROUP BY conv_id
"""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('11:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, 2.0::DOUBLE * source_size AS bound,
    row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source ASC NULLS LAST) AS place
  FROM sources),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(bound) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ordered),
opened AS (
  SELECT min(place) AS first, min_by(level, place) AS common FROM levels WHERE level * weight < bound),
targets AS (
  SELECT source, source_size,
    CASE WHEN first IS NULL OR place < first THEN bound ELSE common * weight END AS target
  FROM levels CROSS JOIN opened),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS whole,
    CASE WHEN source_size > 0 THEN floor(target)::BIGINT % source_size ELSE 0 END AS rest
  FROM targets)
SELECT doc_id, size, source_size, target,
  (whole * size + greatest(0, least(size, rest - coalesce(sum(size) OVER (
    PARTITION BY s.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))))::BIGINT AS taken
FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
"""

DECONTAMINATION = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
item AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS s
  FROM item, unnest(range(1, len(w) - least(len(w), 13) + 2)) t(i) WHERE len(w) > 0),
places AS (
  SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
  FROM doc, (SELECT DISTINCT n FROM windows) k, unnest(range(1, len(w) - n + 2)) t(i)),
met AS (SELECT r, i, p.n, item FROM places p JOIN windows q ON p.n = q.n AND p.s = q.s),
hit AS (SELECT r, count(DISTINCT j) AS n FROM met, unnest(range(i, i + n)) t(j) GROUP BY r),
named AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM met) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit h USING (r) LEFT JOIN named m USING (r)
"""

VECTORS = """
WITH RECURSIVE vec AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vec a JOIN vec b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a AS vec_id, min(least(a, b)) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
  vec_id = coalesce(component_id, vec_id) AS kept
FROM embeddings LEFT JOIN counted USING (vec_id) LEFT JOIN least USING (vec_id)
"""

LINES = r"""
WITH line AS (
  SELECT doc_id, i, parts[i] AS line,
    translate(trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents), unnest(range(1, len(parts) + 1)) t(i)),
repeated AS (
  SELECT k, max(doc_id) AS last FROM line WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT line.*, coalesce(doc_id < last, false) AS gone FROM line LEFT JOIN repeated USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

NEAR = rf"""
WITH RECURSIVE doc AS (
  SELECT doc_id, coalesce(regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(len(w), 5) - 1), ' ') AS s
  FROM doc, unnest(range(1, len(w) - least(len(w), 5) + 2)) t(i) WHERE len(w) > 0),
sized AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL),
link AS (
  SELECT a, b FROM common c JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
  WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(least(a, b)) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
  doc_id = coalesce(component_id, doc_id) AS kept
FROM doc LEFT JOIN sized USING (doc_id) LEFT JOIN least USING (doc_id)
"""

AUDIT = r"""
WITH doc AS (
  SELECT d.doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS copy
  FROM documents d),
flag AS (SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good, max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic
  FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
     100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t), regexp_matches(t, '[#$%&*|]'), copy] AS f
  FROM doc LEFT JOIN flag USING (doc_id)),
kind AS (SELECT part, good, toxic, f, count(*) AS n FROM judged GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest(range(1, 6)) AS i),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS o
  FROM letter a, letter b, letter c, letter d, letter e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (
  SELECT part, filter_order, k::INT AS step, o[k] AS i, n, good, toxic, f[o[k]] AS fails,
    len(list_filter(o[:k - 1], lambda x: f[x])) > 0 AS gone, len(list_filter(f, lambda x: x)) = 1 AS alone
  FROM kind, orders, unnest(range(1, 6)) t(k)),
counted AS (
  SELECT part, filter_order, step, i,
    coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails AND alone), 0)::BIGINT AS unique_fails,
    coalesce(sum(n * good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost,
    coalesce(sum(n * toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM steps GROUP BY ALL)
SELECT * EXCLUDE (i), sum(removed) OVER (PARTITION BY part, i)::BIGINT AS shapley FROM counted
"""

SEARCH = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL),
total AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS length FROM doc WHERE len(w) > 0),
item AS (
  SELECT row_number() OVER () AS q, item_id,
    regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
asked AS (SELECT q, item_id, term, count(*) AS repeats FROM item, unnest(w) t(term) GROUP BY ALL),
posting AS (
  SELECT r, doc_id, len(w) AS n, term, count(*)::BIGINT AS tf FROM doc, unnest(w) t(term)
  WHERE term IN (SELECT term FROM asked) GROUP BY r, doc_id, len(w), term),
weight AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
  FROM posting, total GROUP BY term, docs),
part AS (
  SELECT r, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length))) AS worth
  FROM posting JOIN weight USING (term), total),
scored AS (
  SELECT q, item_id, r, doc_id, sum(repeats * worth)::BIGINT AS score FROM asked JOIN part USING (term) GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST)::INT AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""

ORACLE = {
    "op1_embedding_dedup": VECTORS,
    "op3_line_dedup": LINES,
    "op4_chat_format": CHAT,
    "op5_mixing": MIXING,
    "op8_decontamination": DECONTAMINATION,
    "op9_near_dedup": NEAR,
    "op11_filter_audit": AUDIT,
    "op13_lexical_search": SEARCH,
}
