"""The query of the exact search, and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrun.llm.pivot_search import pivot_search
from quillrun.llm.registry import query, table


@query("op3_pivot_top_k", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.ints, c.ints) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""")
def op3_pivot_top_k(spark, sf_dir):
    return pivot_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
