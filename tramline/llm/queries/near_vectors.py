"""op13: near duplicates among all embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.llm.common import embeddings
from tramline.llm.near_vectors import near_vectors

NAME = "op13_embedding_near_dedup"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(embeddings(spark, sf_dir))


#: The exact join: all pairs within the table, and the links' transitive closure.
SQL = """
WITH RECURSIVE ok AS (
  SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), unit AS (
  SELECT rid, vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM ok
), link AS (
  SELECT p.rid AS x, q.rid AS y FROM unit p JOIN unit q ON p.rid <> q.rid AND len(p.v) = len(q.v)
  WHERE list_dot_product(p.v, q.v) / (p.size * q.size) >= 0.9
), reach AS (
  SELECT x, y FROM link UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y
), class AS (
  SELECT x AS rid, min(vec_id) AS least FROM reach JOIN ok ON ok.rid = reach.y GROUP BY x
), links AS (
  SELECT x AS rid, count(*) AS n_links FROM link GROUP BY x
), good AS (
  SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id
  FROM ok LEFT JOIN class USING (rid) LEFT JOIN links USING (rid)
), bad AS (
  SELECT vec_id, CAST(0 AS BIGINT) AS n_links, vec_id AS component_id FROM embeddings
  WHERE embedding IS NULL OR len(embedding) = 0 OR len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) > 0
    OR len(list_filter(embedding, lambda c: c <> 0)) = 0
)
SELECT vec_id, n_links, component_id, (component_id IS NULL OR vec_id IS NOT DISTINCT FROM component_id) AS kept FROM (SELECT * FROM good UNION ALL SELECT * FROM bad)
"""
