"""op1: n-gram Jaccard join of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.llm.common import documents
from tramline.llm.ngram_join import jaccard_classes

NAME = "op1_ngram_jaccard_join"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links", "n_copies")


#: The exact join: all pairs that share a 5-gram, and the links' transitive closure.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), word AS (
  SELECT rid, unnest(ws) AS word, unnest(range(0, len(ws))) AS i, len(ws) AS n FROM d
), gram AS (
  SELECT DISTINCT rid, g FROM (
    SELECT rid, i, n, string_agg(word, ' ') OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS g
    FROM word) WHERE i = 0 OR i + 5 <= n
), size AS (
  SELECT rid, count(*) AS n FROM gram GROUP BY rid
), link AS (
  SELECT x, y, c = a.n AND c = b.n AS same FROM (
    SELECT p.rid AS x, q.rid AS y, count(*) AS c FROM gram p JOIN gram q USING (g) WHERE p.rid <> q.rid GROUP BY 1, 2)
  JOIN size a ON a.rid = x JOIN size b ON b.rid = y WHERE 10 * c >= 8 * (a.n + b.n - c)
), reach AS (
  SELECT x, y FROM link UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y
), class AS (
  SELECT x AS rid, min(doc_id) AS least FROM reach JOIN d ON d.rid = reach.y GROUP BY x
), links AS (
  SELECT x AS rid, count(*) AS n_links, count(*) FILTER (same) AS copies FROM link GROUP BY x
)
SELECT doc_id, least(doc_id, coalesce(least, doc_id)) AS class_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links,
  CAST(1 + coalesce(copies, 0) AS BIGINT) AS n_copies
FROM d LEFT JOIN class USING (rid) LEFT JOIN links USING (rid)
"""
