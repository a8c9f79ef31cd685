"""Queries: chunks, batches and id rules."""

from __future__ import annotations

import warnings

from pyspark.sql import functions as F

from quillrun.functions import requests as rq
from quillrun.operators import batching, ids, reports
from quillrun.operators.prepare import prepare_batches
from quillrun.operators.results import parse_files
from quillrun.plans.answers import chat_lines
from quillrun.plans.registry import query, table
from quillrun.session import fresh_dir
from quillrun.sources import jsonl


@query("c1_chunks", """
SELECT o_orderkey, CAST(ceil(row_number() OVER (ORDER BY o_orderdate, o_orderkey) / 1000.0)
                        AS INTEGER) AS chunk FROM orders""")
def chunks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return batching.with_chunk(orders, 1000, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("c2_chunk_index", """
SELECT event_id, row_number() OVER (ORDER BY event_id DESC) AS index,
       CAST(ceil(row_number() OVER (ORDER BY event_id DESC) / 8.0) AS INTEGER) AS chunk
FROM events""")
def chunk_index(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id").withColumn("back", -F.col("event_id"))
    return batching.with_chunk(events, 8, "back", index="index").drop("back")


@query("c3_multi_text_requests", """
WITH placed AS (
  SELECT text, row_number() OVER (ORDER BY doc_id) AS position FROM documents)
SELECT CAST(ceil(position / 8.0) AS INTEGER) AS batch, CAST(count(*) AS INTEGER) AS n_texts,
  CAST(sum(length(text)) AS BIGINT) AS total_chars,
  '{"inputs":[' || string_agg(to_json(text), ',' ORDER BY position)
  || '],"parameters":{"truncate":true}}' AS request
FROM placed GROUP BY 1""")
def multi_text_requests(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = batching.with_chunk(documents, 8, chunk="batch", index="index")
    return batching.multi_text_requests(
        placed, "text", lambda texts: rq.inference_request_multi(texts, rq.EMBED_PARAMETERS),
        carry=["doc_id"]).drop("items")


@query("c4_row_batches", """
SELECT l_orderkey, l_linenumber,
       CAST(ceil(row_number() OVER (ORDER BY l_orderkey, l_linenumber) / 50000.0) AS BIGINT) AS batch
FROM lineitem""")
def row_batches(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return batching.with_row_batches(items, ["l_orderkey", "l_linenumber"])


def batch_number_sql(size: str, cap: int, max_rows: int = 1 << 62, source: str = "documents") -> str:
    """Rows of ``source`` with ``batch``: filled row by row, in the order of doc_id."""
    return f"""
WITH RECURSIVE sized AS (
  SELECT *, {size} AS size, row_number() OVER (ORDER BY doc_id) AS position FROM {source}),
fill AS (
  SELECT position, size AS bytes, 1 AS n, 1 AS batch FROM sized WHERE position = 1
  UNION ALL
  SELECT s.position, CASE WHEN f.bytes + s.size > {cap} OR f.n >= {max_rows} THEN s.size ELSE f.bytes + s.size END,
         CASE WHEN f.bytes + s.size > {cap} OR f.n >= {max_rows} THEN 1 ELSE f.n + 1 END,
         CASE WHEN f.bytes + s.size > {cap} OR f.n >= {max_rows} THEN f.batch + 1 ELSE f.batch END
  FROM fill f JOIN sized s ON s.position = f.position + 1)
SELECT s.*, CAST(f.batch AS BIGINT) AS batch FROM sized s JOIN fill f ON s.position = f.position"""


@query("c6_large_run_notice", """
SELECT 'orders' AS source, count(*) AS n_requests, count(*) > 10000 AS noticed FROM orders
UNION ALL SELECT 'pages', count(*), count(*) > 10000 FROM pages""")
def large_run_notice(spark, sf_dir):
    """Whether building a table's requests warns that they are many."""
    found = []
    for name, id_, text in (("orders", "o_orderkey", "o_orderpriority"), ("pages", "page_id", "html")):
        with warnings.catch_warnings(record=True) as said:
            warnings.simplefilter("always")
            lines = prepare_batches(table(spark, sf_dir, name), text, id_, "embeddings")
        noticed = any(issubclass(w.category, ids.LargeRun) for w in said)
        found.append(lines.agg(F.count(F.lit(1)).alias("n_requests")).select(
            F.lit(name).alias("source"), "n_requests", F.lit(noticed).alias("noticed")))
    return found[0].unionByName(found[1])


# four times the longest line, so that batches are many whatever the table
SMALL_CAP = "(SELECT 4 * (max(strlen(text)) + 1) FROM documents)"


def small_cap(documents) -> int:
    return 4 * (documents.agg(F.max(F.octet_length("text"))).first()[0] + 1)


@query("c5_byte_batches",
       f"SELECT doc_id, batch FROM ({batch_number_sql('strlen(text) + 1', batching.BATCH_FILE_BYTES)})")
def byte_batches(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return batching.with_batches(documents, "text").drop("text")


@query("c5_small_batches",
       f"SELECT doc_id, batch FROM ({batch_number_sql('strlen(text) + 1', SMALL_CAP, 30)})")
def small_batches(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return batching.with_batches(documents, "text", None, 30, small_cap(documents)).drop("text")


@query("c5_keyed_byte_batches",
       f"SELECT doc_id, batch FROM ({batch_number_sql('strlen(text) + 1', SMALL_CAP)})")
def keyed_byte_batches(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return batching.with_batches(documents, "text", "doc_id", max_bytes=small_cap(documents)).drop("text")


@query("c2_sorted_chunks", """
SELECT l_orderkey, l_linenumber, CAST(row_number() OVER ranked AS BIGINT) AS index,
       CAST(ceil(row_number() OVER ranked / 700.0) AS INTEGER) AS chunk
FROM lineitem WINDOW ranked AS (ORDER BY l_shipdate DESC, l_orderkey, l_linenumber)""")
def sorted_chunks(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").orderBy(F.desc("l_shipdate"), "l_orderkey", "l_linenumber")
    return batching.with_chunk(items.select("l_orderkey", "l_linenumber"), 700, index="index")


@query("c6_id_violations", """
SELECT 'duplicate' AS rule, CAST(user_id AS VARCHAR) AS custom_id, count(*) AS n FROM events
GROUP BY user_id HAVING count(*) > 1""")
def id_violations(spark, sf_dir):
    return ids.id_violations(table(spark, sf_dir, "events"), "user_id", messages_rules=True)


@query("c6_id_format", r"""
SELECT 'format' AS rule, url AS custom_id, count(*) AS n FROM pages
WHERE NOT regexp_full_match(url, '[a-zA-Z0-9_-]{1,64}') GROUP BY url
UNION ALL
SELECT 'duplicate', url, count(*) FROM pages GROUP BY url HAVING count(*) > 1""")
def id_format(spark, sf_dir):
    return ids.id_violations(table(spark, sf_dir, "pages"), "url", messages_rules=True)


@query("c7_split_and_merge", f"""
SELECT CAST(batch AS INTEGER) AS batch, count(*) AS total,
  count(*) FILTER (doc_id % 10 NOT IN (3, 5, 6)) AS succeeded,
  count(*) FILTER (doc_id % 10 IN (3, 5, 6)) AS failed,
  round(100.0 * count(*) FILTER (doc_id % 10 NOT IN (3, 5, 6)) / count(*), 1) AS succeeded_pct,
  round(100.0 * count(*) FILTER (doc_id % 10 IN (3, 5, 6)) / count(*), 1) AS failed_pct
FROM ({batch_number_sql('strlen(text) + 1', SMALL_CAP, 30)}) GROUP BY 1""")
def split_and_merge(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    answered = chat_lines(documents, F.col("text"))
    # answers come back under the batch that their requests were sent in, which keeps both caps
    sent = batching.with_batches(documents.select("doc_id", "text"), "text", None, 30, small_cap(documents)).drop("text")
    placed = answered.join(sent, "doc_id")
    path = fresh_dir(spark, "answers")
    jsonl.write_batches(placed, "line", path, order_by="doc_id")
    results = parse_files(spark, path, "completions", keep=["file"])
    batch = F.regexp_extract("file", r"batch=(\d+)", 1).cast("int")
    return reports.job_summary(results.withColumn("batch", batch), ["batch"])


@query("k5_position_to_chunk", """
SELECT ps.c_custkey, CAST(floor((position - 1) / 500) + 1 AS INTEGER) AS chunk, position
FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS position
      FROM customer) ps""")
def position_to_chunk(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return batching.with_chunk(customers, 500, ["c_acctbal", "c_custkey"], index="position") \
        .drop("c_acctbal")
