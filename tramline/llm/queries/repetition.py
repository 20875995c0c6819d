"""op8: suffix-array repetition over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.llm.common import documents
from tramline.llm.repetition import repetition_scores

NAME = "op8_repetition"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_scores(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_long_repeat_words",
        "base_failed", "kept")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d
), word AS (
  SELECT rid, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w
), win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid) AS n,
    string_agg(word, ' ') OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS w5,
    string_agg(word, ' ') OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS w10
  FROM word
), ten AS (
  SELECT rid, i, w10, count(*) OVER (PARTITION BY rid, w10) AS c FROM win WHERE i + 9 <= n
), short_win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, w5) AS c FROM win WHERE i + 4 <= n
), long_win AS (
  SELECT rid, i, c FROM ten
), hundred AS (
  -- ten windows of ten words, one after the other; each must be repeated itself
  SELECT rid, i, c, [w10, lead(w10, 10) OVER p, lead(w10, 20) OVER p, lead(w10, 30) OVER p, lead(w10, 40) OVER p,
    lead(w10, 50) OVER p, lead(w10, 60) OVER p, lead(w10, 70) OVER p, lead(w10, 80) OVER p, lead(w10, 90) OVER p] AS w100,
    lead(i, 90) OVER p AS last
  FROM ten WINDOW p AS (PARTITION BY rid ORDER BY i)
), too_long AS (
  SELECT DISTINCT rid FROM (
    SELECT rid FROM hundred WHERE last IS NOT NULL AND c > 1 GROUP BY rid, w100 HAVING count(*) > 1)
), short_cover AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM short_win WHERE c > 1)
  GROUP BY rid
), long_cover AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 10)) AS p FROM long_win WHERE c > 1)
  GROUP BY rid
), line AS (
  SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d
), dup AS (
  SELECT rid, count(*) - count(DISTINCT l) AS n FROM line WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid
), m AS (
  SELECT w.rid, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(s.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(l.n, 0) AS BIGINT) AS n_long_repeat_words,
    x.rid IS NOT NULL AS has_too_long
  FROM w LEFT JOIN dup USING (rid) LEFT JOIN short_cover s ON s.rid = w.rid
  LEFT JOIN long_cover l ON l.rid = w.rid LEFT JOIN too_long x ON x.rid = w.rid
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_long_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 100 * n_long_repeat_words > 20 * n_words
       OR has_too_long) AS kept
FROM m
"""
