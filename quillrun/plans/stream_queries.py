"""Queries: the streaming forms, run to the end of what has arrived."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrun.functions.responses import widen
from quillrun.operators import inference as inf
from quillrun.plans import answers as an
from quillrun.plans.model_calls import embedded_sql
from quillrun.plans.registry import query, table
from quillrun.session import fresh_dir
from quillrun.streaming import ingest


DELIVERIES = 3


@query("w1_ingest_results", f"""
SELECT CASE WHEN doc_id % 10 <> 6 THEN CAST(doc_id AS VARCHAR) END AS custom_id,
  CASE WHEN doc_id % 10 NOT IN (3, 5, 6, 7) THEN text END AS content,
  doc_id % 10 IN (3, 5, 6) AS error,
  CASE WHEN doc_id % 10 <> 6 THEN {an.CHAT_LINE_ERROR_SQL} END AS error_msg, delivery
FROM (SELECT * REPLACE (CASE WHEN doc_id % {DELIVERIES} = 2 THEN doc_id // {DELIVERIES} * 10
                             ELSE doc_id // {DELIVERIES} END AS doc_id),
        CAST(doc_id % {DELIVERIES} AS INTEGER) AS delivery FROM documents)""")
def ingest_results(spark, sf_dir):
    """Several deliveries that use the same ids; ids that fail in one come back in the last."""
    folder = fresh_dir(spark, "stream")
    share = F.floor(F.col("doc_id") / DELIVERIES)
    documents = table(spark, sf_dir, "documents").withColumn(
        "delivery", (F.col("doc_id") % DELIVERIES).cast("int")).withColumn(
        "doc_id", F.when(F.col("delivery") == 2, share * 10).otherwise(share))
    for delivery in range(DELIVERIES):
        lines = an.chat_lines(documents.where(F.col("delivery") == delivery), F.col("text"))
        lines.select("line").repartition(2).write.text(f"{folder}/landing/delivery-{delivery}")
    arrived = ingest.ingest_results(spark, f"{folder}/landing/*", "completions", f"{folder}/results",
                                    f"{folder}/checkpoint", files_per_batch=2)
    # which file, and so which line, an unreadable line lands in is not fixed
    readable = ~F.col("custom_id").startswith("__PARSE_ERROR_LINE_")
    return arrived.select(
        F.when(readable, F.col("custom_id")).alias("custom_id"), "content", "error",
        F.when(readable, F.col("error_msg")).alias("error_msg"),
        F.regexp_extract("file", "delivery-([0-9]+)", 1).cast("int").alias("delivery"))


ARRIVING = "CASE WHEN page_id % 7 <> 3 THEN page_id {} 2 END AS page_id, html"


@query("w2_infer_arrivals", embedded_sql(
    f"(SELECT {ARRIVING.format('//')} FROM pages)", "html", "page_id"))
def infer_arrivals(spark, sf_dir):
    """Rows without an id and rows that share one: each gets its result."""
    folder = fresh_dir(spark, "arrivals")
    pages = table(spark, sf_dir, "pages").selectExpr(*ARRIVING.format("div").split(", "))
    pages.repartition(4).write.parquet(f"{folder}/landing")
    results = ingest.infer_arrivals(
        spark, f"{folder}/landing", pages.schema, "html", "page_id", inf.embed_task(),
        an.EmbedBackend, f"{folder}/responses", f"{folder}/checkpoint", retry=an.FAST_RETRY,
        files_per_batch=2)
    rest = [c for c in results.columns if c != "embedding"]
    return results.select(*rest, *widen(F.col("embedding"), 3))


REPEATED = "CASE WHEN page_id % 5 = 4 THEN page_id - 4 ELSE page_id END"


@query("w2_arrivals_once_per_id", embedded_sql(f"""
  (SELECT page_id, html FROM (
     SELECT {REPEATED} AS page_id, html, row_number() OVER (PARTITION BY {REPEATED} ORDER BY page_id) AS nth
     FROM pages) WHERE nth = 1)""", "html", "page_id"))
def arrivals_once_per_id(spark, sf_dir):
    """Ids come again in later files, first of all the newest; each is answered once."""
    folder = fresh_dir(spark, "arrivals")
    pages = table(spark, sf_dir, "pages")
    firsts, repeats = pages.where("page_id % 5 <> 4"), pages.where("page_id % 5 = 4")
    settings = dict(retry=an.FAST_RETRY, files_per_batch=2, once_per_id=True, remember="1 hour", state_partitions=4)
    results = None
    for part in (firsts, repeats):
        part.select(F.expr(REPEATED).alias("page_id"), "html").repartition(3).write.mode("append") \
            .parquet(f"{folder}/landing")
        results = ingest.infer_arrivals(
            spark, f"{folder}/landing", pages.select("page_id", "html").schema, "html", "page_id", inf.embed_task(),
            an.EmbedBackend, f"{folder}/responses", f"{folder}/checkpoint", **settings)
    rest = [c for c in results.columns if c != "embedding"]
    return results.select(*rest, *widen(F.col("embedding"), 3))
