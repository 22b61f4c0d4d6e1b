"""DuckDB SQL for the queries that SQL can express: brute force over whole tables."""

from __future__ import annotations

from flowatlas.llm.urls import ORACLE as URL_SQL

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

#: Smallest id that can be reached over the table ``links(a, b)``, which holds both directions.
_REACH = "reach AS (SELECT DISTINCT a AS id, a AS other FROM links UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a)"
_LOWEST = "lowest AS (SELECT id, min(other) AS low FROM reach GROUP BY id)"

EMBEDDINGS = f"""
WITH RECURSIVE cast_ AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
good AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM cast_
         WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
                       WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.95),
{_REACH}, {_LOWEST}, counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(low, vec_id) AS component_id, coalesce(low, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN counts ON vec_id = a LEFT JOIN lowest ON vec_id = id
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE split AS MATERIALIZED (SELECT doc_id, {_SPACED} AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, w[i + 1:i + 5] AS s FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS i FROM split WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM common JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id WHERE 100 * c >= 75 * (p.n + q.n - c)),
{_REACH}, {_LOWEST}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(low, d.doc_id) AS component_id, coalesce(low, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id LEFT JOIN lowest ON d.doc_id = id
"""

DECONTAMINATION = f"""
WITH docs AS MATERIALIZED (SELECT doc_id, {_ALNUM} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(13, len(w)) AS n FROM (SELECT item_id, {_ALNUM} AS w FROM benchmark) WHERE len(w) > 0),
win AS MATERIALIZED (SELECT DISTINCT item, n, w[i + 1:i + n] AS s FROM (SELECT item, w, n, unnest(range(len(w) - n + 1)) AS i FROM items)),
seen AS MATERIALIZED (
  SELECT doc_id, p, d.n, item FROM (
    SELECT doc_id, p, n, w[p + 1:p + n] AS s FROM (
      SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS p FROM docs, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)) d JOIN win ON d.s = win.s),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM seen) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item FROM seen) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN found ON d.doc_id = found.doc_id
"""

ORACLES = {"op3_embedding_forest": EMBEDDINGS, "op5_url_filter": URL_SQL, "op7_minhash": NEAR_DUPLICATES, "op9_decontaminate": DECONTAMINATION}
