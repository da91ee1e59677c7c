"""SQL that gives the results of the similarity queries by comparing all pairs: for the small tables on which the two are held against each other."""

from __future__ import annotations

# Smallest id reachable over links (a, b), both ways; ids without links are their own.
_COMPONENTS = """
near AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, least) AS (
  SELECT a, a FROM (SELECT DISTINCT a FROM near)
  UNION
  SELECT near.b, reach.least FROM reach JOIN near ON near.a = reach.id WHERE reach.least < near.b),
component AS (SELECT id, min(least) AS component_id FROM reach GROUP BY id)"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Documents whose two-word shingles overlap by 80 % of their union. Sizes bound the pairs: one set must hold 80 % of the other's number.
NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
held AS MATERIALIZED (SELECT doc_id, len(s) AS size, unnest(s) AS shingle FROM sets),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.size) AS one, any_value(y.size) AS two, count(*) AS n
  FROM held x JOIN held y ON x.shingle = y.shingle AND x.doc_id < y.doc_id AND 100 * least(x.size, y.size) >= 80 * greatest(x.size, y.size) GROUP BY 1, 2),
links AS (SELECT a, b FROM shared WHERE 100 * n >= 80 * (one + two - n)),
{_COMPONENTS.strip()}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM sets LEFT JOIN component ON id = doc_id"""

# Vectors of one label with a cosine of 0.98 or more.
NEAR_VECTORS = f"""
WITH RECURSIVE usable AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
{_COMPONENTS.strip()},
counts AS (SELECT a, count(*) AS n FROM near GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN component ON id = vec_id LEFT JOIN counts ON counts.a = vec_id"""
