"""DuckDB statements of the registered corpus queries that SQL can express; written apart from the operators."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3 = f"""
WITH t AS (SELECT doc_id, {LOWER} AS low FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(low) AS text_sha256
FROM t WINDOW w AS (PARTITION BY low)
"""

OP6 = rf"""
WITH item AS (SELECT item_id, {WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
         array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS words
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS s FROM item WHERE len(w) > 0)
),
doc AS (SELECT doc_id, {WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM win),
place AS (
  SELECT doc_id, size, s, array_to_string(list_slice(w, s, s + size - 1), ' ') AS words
  FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS s FROM doc, sizes WHERE len(w) >= size)
),
hit AS (SELECT doc_id, p.s, p.size, item_id FROM place p JOIN win USING (size, words)),
covered AS (SELECT doc_id, count(DISTINCT x) AS n_hit
            FROM (SELECT doc_id, unnest(generate_series(s, s + size - 1)) AS x FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS listed
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP7 = r"""
WITH line AS (
  SELECT doc_id, unnest(w) AS line, unnest(range(len(w))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents)
),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line
),
often AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
judged AS (
  SELECT doc_id, pos, line, last_doc IS NOT NULL AND doc_id < last_doc AS gone FROM keyed LEFT JOIN often USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

# The templates of the scan: label, words, share of distinct words, whether the words must stand in this order.
TEMPLATES = """
  ('mit', 'mit license', 1.0, true), ('apache', 'apache license', 1.0, true),
  ('gpl', 'general public license', 1.0, true),
  ('apache-notice', 'licensed under the apache license version 2 0', 0.8, false),
  ('bsd-notice', 'redistribution and use in source and binary forms with or without modification are permitted', 0.8, false),
  ('cc-by', 'licensed under cc by 4 0', 1.0, false), ('cc-by-nc', 'licensed under cc by nc 4 0', 1.0, false),
  ('cc-by-sa', 'licensed under cc by sa 4 0', 1.0, false),
  ('gpl-notice', 'licensed under the gnu general public license version', 0.8, false),
  ('mit-notice', 'permission is hereby granted free of charge to any person obtaining a copy of this software', 0.8, false),
  ('mpl-notice', 'subject to the terms of the mozilla public license', 0.8, false)
"""

OP1 = rf"""
WITH tpl AS (
  SELECT label, words, len(string_split(words, ' ')) AS n_seq, list_distinct(string_split(words, ' ')) AS tokens, share, ordered
  FROM (VALUES {TEMPLATES}) v(label, words, share, ordered)
),
tok AS (SELECT label, n_seq, unnest(tokens) AS t FROM tpl),
doc AS (SELECT doc_id, {WORDS} AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS t, unnest(generate_series(1, len(w))) AS p FROM doc),
start AS (SELECT doc_id, label, t, unnest(generate_series(greatest(1, p - n_seq + 1), p)) AS s FROM word JOIN tok USING (t)),
met AS (SELECT doc_id, label, s, count(DISTINCT t) AS k FROM start GROUP BY doc_id, label, s),
found AS (
  SELECT doc_id, count(*) FILTER (WHERE ordered) AS n_base, min(s - 1) FILTER (WHERE ordered) AS first_word,
         max(s - 1) FILTER (WHERE ordered) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE ordered) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(k / len(tokens)) AS score
  FROM met JOIN tpl USING (label) JOIN doc USING (doc_id)
  WHERE k >= ceil(share * len(tokens) - 1e-9)
    AND (NOT ordered OR array_to_string(list_slice(w, s, s + n_seq - 1), ' ') = words)
  GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(CAST(score AS DOUBLE), 0.0) AS score
FROM doc LEFT JOIN found USING (doc_id)
"""

OP10 = rf"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM doc WHERE len(w) > 0))
),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
link AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
),
reach AS (SELECT doc_id, doc_id AS r FROM doc UNION SELECT doc_id, b FROM reach JOIN link ON r = a)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN size USING (doc_id) GROUP BY doc_id
"""

OP12 = """
WITH ok AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS y
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
pair AS (
  SELECT a.vec_id AS a, o.vec_id AS o, a.label = o.label AS same,
         CAST(list_sum([z[1] * z[2] FOR z IN list_zip(a.y, o.y)]) AS BIGINT) AS score
  FROM ok a JOIN ok o ON a.vec_id <> o.vec_id WHERE a.vec_id % 100 = 0
),
positive AS (
  SELECT a, o, score FROM pair WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, o) <= 5
)
SELECT p.a AS anchor_id, p.o AS positive_id, CAST(row_number() OVER w AS INT) AS rank, n.o AS negative_id,
       p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN pair n ON p.a = n.a AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
WINDOW w AS (PARTITION BY p.a, p.o ORDER BY n.score DESC, n.o)
QUALIFY row_number() OVER w <= 10
"""

SQL = {
    "op1_license_scan": OP1,
    "op10_jaccard_join": OP10,
    "op12_hard_negatives": OP12,
    "op3_exact_dedup": OP3,
    "op6_decontamination": OP6,
    "op7_line_dedup": OP7,
}
