"""op3: benchmark windows in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import benchmark, documents
from tramline.llm.decontaminate import matches

NAME = "op3_decontamination"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matches(documents(spark, sf_dir), benchmark(spark, sf_dir))
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT row_number() OVER () AS bid, item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS k, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
), word AS (
  SELECT rid, unnest(ws) AS word, unnest(range(0, len(ws))) AS i, len(ws) AS n FROM d
), ten AS (
  SELECT rid, i, 10 AS k,
    string_agg(word, ' ') OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS win, n FROM word
), sizes AS (
  SELECT DISTINCT k FROM bw WHERE k < 10
), short AS (
  SELECT rid, i, k, array_to_string(ws[i + 1:i + k], ' ') AS win
  FROM (SELECT rid, ws, k, unnest(range(0, greatest(len(ws) - k + 1, 0))) AS i FROM d, sizes)
), hit AS (
  SELECT rid, i, k, item_id FROM ten JOIN bw USING (k, win) WHERE i + 10 <= n
  UNION ALL SELECT rid, i, k, item_id FROM short JOIN bw USING (k, win)
), cover AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM hit) GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM hit WHERE item_id IS NOT NULL) GROUP BY rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (rid) LEFT JOIN items USING (rid)
"""
