"""The query of the ranked lexical search, and its SQL."""

from __future__ import annotations

from quillrun.llm.norm_buckets import ranked_search
from quillrun.llm.registry import query, table

_TERMS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")


@query("op13_norm_bucket_search", f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
sizes AS (SELECT r, doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0),
totals AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM sizes),
asked AS (SELECT q, item_id, unnest(list_distinct(terms)) AS term
          FROM (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS terms FROM benchmark)),
postings AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM postings, totals GROUP BY term, nn),
impacts AS (
  SELECT p.r, s.doc_id, p.term,
         w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nn) // ll))) AS impact
  FROM postings p JOIN weights USING (term) JOIN sizes s USING (r), totals),
scores AS (
  SELECT q, item_id, r, doc_id, CAST(sum(impact) AS BIGINT) AS score
  FROM asked JOIN impacts USING (term) GROUP BY q, item_id, r, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
         doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""")
def op13_norm_bucket_search(spark, sf_dir):
    return ranked_search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))
