"""DuckDB SQL for the queries that SQL can express, over whole tables."""

from __future__ import annotations

from .hard_negatives import OP12_SQL
from .line_dedup import OP6_SQL
from .spelling import OP13_SQL

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4_SQL = f"""
WITH docs AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs),
wins AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM docs)),
twice AS (SELECT win FROM wins GROUP BY win HAVING count(*) > 1),
starts AS (SELECT doc_id, i FROM wins WHERE win IN (SELECT win FROM twice)),
marked AS (
  SELECT w.doc_id, w.i, w.word, coalesce(max(s.i) OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) > 0 AS gone
  FROM words w LEFT JOIN starts s ON s.doc_id = w.doc_id AND s.i = w.i),
summed AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept,
         count(*) FILTER (WHERE gone AND NOT before) AS n_factors
  FROM (SELECT *, coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS before FROM marked) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256, CAST(coalesce(n_factors, 0) AS BIGINT) AS n_factors
FROM documents d LEFT JOIN summed USING (doc_id)
"""

OP8_SQL = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
units AS (SELECT doc_id, i, substring(h, 2 * i + 1, 2) AS b FROM (SELECT doc_id, h, unnest(range(length(h) // 2)) AS i FROM docs)),
wins AS (SELECT doc_id, i, md5(substring(h, 2 * i + 1, 200)) AS win FROM (SELECT doc_id, h, unnest(range(greatest(length(h) // 2 - 99, 0))) AS i FROM docs)),
starts AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS rn FROM wins) WHERE rn > 1),
marked AS (
  SELECT u.doc_id, u.i, u.b, coalesce(max(s.i + 1) OVER (PARTITION BY u.doc_id ORDER BY u.i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 0) > 0 AS gone
  FROM units u LEFT JOIN starts s ON s.doc_id = u.doc_id AND s.i = u.i),
summed AS (
  SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE gone AND NOT before) AS n_spans,
         coalesce(string_agg(b, '' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept
  FROM (SELECT *, coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS before FROM marked) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_bytes, 0) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(from_hex(coalesce(kept, ''))) AS kept_sha256
FROM documents d LEFT JOIN summed USING (doc_id)
"""

OP9_SQL = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
both_ AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, both_.y FROM reach JOIN both_ ON both_.x = reach.r),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

ORACLES = {"op4_substring_dedup": OP4_SQL, "op6_line_dedup": OP6_SQL, "op8_suffix_array_dedup": OP8_SQL, "op9_near_dedup": OP9_SQL, "op12_hard_negatives": OP12_SQL, "op13_spelling_variants": OP13_SQL}
