"""Queries: text scalars, filters, joins, reports, order and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrun.functions import requests as rq
from quillrun.functions import text as tx
from quillrun.functions.responses import widen
from quillrun.operators import batching, ids, joining, pieces, reports, tables
from quillrun.operators import inference as inf
from quillrun.operators.results import parse_lines
from quillrun.plans import answers as an
from quillrun.plans.parsing import SIZE, wide_sql
from quillrun.plans.registry import query, table
from quillrun.session import materialise

# --- filters -----------------------------------------------------------------------------------


def answered(spark, sf_dir):
    return parse_lines(an.chat_lines(table(spark, sf_dir, "documents"), F.col("text")),
                       "completions")


@query("g1_successes_and_failures", """
SELECT CASE WHEN doc_id % 10 = 6 THEN '__PARSE_ERROR_LINE_' || (doc_id + 1)
  ELSE CAST(doc_id AS VARCHAR) END AS custom_id,
  CASE WHEN doc_id % 10 IN (3, 5, 6) THEN 'failed' ELSE 'succeeded' END AS outcome FROM documents""")
def successes_and_failures(spark, sf_dir):
    results = materialise(answered(spark, sf_dir), "answered")  # read and parsed once for both
    kept = results.where(~F.col("error")).select("custom_id", F.lit("succeeded").alias("outcome"))
    lost = results.where("error").select("custom_id", F.lit("failed").alias("outcome"))
    return joining.bind_rows(kept, lost)


@query("g2_non_empty_text", """
SELECT doc_id, text FROM documents WHERE doc_id % 9 NOT IN (2, 5)""")
def non_empty_text(spark, sf_dir):
    blanked = F.when(F.col("doc_id") % 9 == 2, "").when(F.col("doc_id") % 9 != 5, F.col("text"))
    documents = table(spark, sf_dir, "documents").select("doc_id", blanked.alias("text"))
    return tables.apply_invalid_policy(documents, "text", "drop")


@query("g3_filter_rows", """
SELECT d.doc_id, d.lang, l.quality FROM documents d JOIN labels l USING (doc_id)
WHERE d.lang = 'en' AND length(d.text) > 500 AND l.quality = 1""")
def filter_rows(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").where(
        (F.col("lang") == "en") & (F.length("text") > 500)).select("doc_id", "lang")
    return documents.join(table(spark, sf_dir, "labels").where("quality = 1")
                          .select("doc_id", "quality"), "doc_id")


@query("g4_too_long", """
SELECT doc_id, length(text) / 4 > 8192 AS will_fail FROM documents""")
def too_long(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", tx.too_long(F.col("text")).alias("will_fail"))


# --- text --------------------------------------------------------------------------------------

@query("t1_lengths", """
SELECT doc_id, CAST(length(text) AS BIGINT) AS char_count, length(text) / 4 AS approx_tokens
FROM documents""")
def lengths(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", tx.char_count(text).alias("char_count"),
        tx.approx_tokens(text).alias("approx_tokens"))


@query("t2_truncate", """
SELECT doc_id, substring(text, 1, 250) AS text, CAST(length(substring(text, 1, 32000)) AS BIGINT) AS n
FROM documents""")
def truncate(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", tx.truncate(text, 250).alias("text"),
        tx.char_count(tx.truncate(text)).alias("n"))


PIECES_SQL = """
  SELECT doc_id, CAST(i + 1 AS INTEGER) AS piece_no, substring(text, i * 2000 + 1, 2000) AS piece
  FROM (SELECT doc_id, text, unnest(generate_series(0, (length(text) - 1) // 2000)) AS i
        FROM documents)"""


@query("t3_split_text", PIECES_SQL)
def split_text(spark, sf_dir):
    return pieces.split_text(table(spark, sf_dir, "documents"), "text", ["doc_id"])


@query("t4_score_pieces", f"""
SELECT doc_id, label, round(avg(score), 9) AS mean_score, max(score) AS max_score,
  count(*) AS n_pieces FROM (
  SELECT doc_id, 'LABEL_1' AS label, (length(piece) % 64) / 64 AS score FROM ({PIECES_SQL})
  WHERE length(piece) % 17 NOT IN (5, 6, 7, 9)
  UNION ALL
  SELECT doc_id, 'LABEL_0', 1 - (length(piece) % 64) / 64 FROM ({PIECES_SQL})
  WHERE length(piece) % 17 NOT IN (5, 6, 7, 9)) GROUP BY doc_id, label""")
def score_pieces(spark, sf_dir):
    cut = pieces.split_text(table(spark, sf_dir, "documents"), "text", ["doc_id"]).withColumn(
        "piece_id", F.concat_ws("-", "doc_id", "piece_no"))
    scored = inf.infer(cut, "piece", "piece_id", inf.classify_task(), an.ClassifyBackend,
                       chunk_size=None, retry=an.FAST_RETRY, keep=["doc_id"])
    return pieces.combine_scores(scored, "doc_id").withColumn(
        "mean_score", F.round("mean_score", 9))


@query("t5_max_length", """
SELECT page_id, '{"inputs":' || to_json(html)
  || ',"parameters":{"return_all_scores":true,"truncation":true,"max_length":460}}' AS request
FROM pages""")
def max_length(spark, sf_dir):
    task = inf.classify_task(rq.safe_max_length(512))
    return inf.request_table(table(spark, sf_dir, "pages"), "html", "page_id", task)


@query("t6_request_chars", """
SELECT CAST(ceil(position / 10.0) AS INTEGER) AS batch, CAST(sum(length(html)) AS BIGINT) AS total_chars
FROM (SELECT html, row_number() OVER (ORDER BY page_id) AS position FROM pages) GROUP BY 1""")
def request_chars(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.length("html").alias("chars"))
    return batching.with_chunk(pages, 10, chunk="batch").groupBy("batch").agg(
        F.sum("chars").cast("bigint").alias("total_chars"))


# --- joins and sets ----------------------------------------------------------------------------

@query("j1_attach_results", """
SELECT doc_id, lang, CASE WHEN doc_id % 10 IN (0, 1, 2, 4, 8, 9) THEN text END AS content,
  CASE WHEN doc_id % 10 <> 6 THEN doc_id % 10 IN (3, 5) END AS error FROM documents""")
def attach_results(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return joining.attach_results(documents, answered(spark, sf_dir), "doc_id").drop("error_msg")


@query("j2_completeness", """
WITH came AS (
  SELECT CASE WHEN doc_id % 10 = 6 THEN '__PARSE_ERROR_LINE_' || (doc_id + 1)
    ELSE CAST(doc_id AS VARCHAR) END AS id FROM documents
  UNION ALL SELECT CAST(user_id AS VARCHAR) FROM events),
asked AS (SELECT CAST(doc_id AS VARCHAR) AS id, count(*) AS n FROM documents GROUP BY doc_id),
back AS (SELECT id, count(*) AS n FROM came GROUP BY id),
matched AS (
  SELECT coalesce(asked.id, back.id) AS custom_id, coalesce(asked.n, 0) AS n_requests,
    coalesce(back.n, 0) AS n_results FROM asked FULL JOIN back ON asked.id = back.id)
SELECT *, CASE WHEN n_results = 0 THEN 'missing' WHEN n_requests = 0 THEN 'unknown'
  ELSE 'repeated' END AS state FROM matched WHERE n_requests <> 1 OR n_results <> 1""")
def completeness(spark, sf_dir):
    results = answered(spark, sf_dir).select("custom_id").unionAll(
        table(spark, sf_dir, "events").select(F.col("user_id").cast("string")))
    return joining.completeness(table(spark, sf_dir, "documents"), results, "doc_id")


@query("j2_response_counts", """
SELECT (SELECT count(*) FROM documents) AS n_requests, (SELECT count(*) FROM labels) AS n_results""")
def response_counts(spark, sf_dir):
    return joining.response_counts(table(spark, sf_dir, "documents"),
                                   table(spark, sf_dir, "labels"))


@query("j4_parameter_grid", """
WITH chunks AS (
  SELECT (row_number() OVER (ORDER BY doc_id) - 1) % 20 + 1 AS chunk_index, length(text) AS n
  FROM documents),
sized AS (SELECT chunk_index, count(*) AS n_texts, sum(n) AS chars FROM chunks GROUP BY chunk_index),
grid AS (
  SELECT b.batch_size, c.concurrent_requests,
    row_number() OVER (ORDER BY b.batch_size, c.concurrent_requests) % 20 + 1 AS chunk_index
  FROM (SELECT unnest([1, 4, 8, 16, 32]) AS batch_size) b,
       (SELECT unnest([1, 5, 10, 20]) AS concurrent_requests) c)
SELECT batch_size, concurrent_requests, chunk_index, n_texts, CAST(chars AS BIGINT) AS total_chars,
  CAST(ceil(n_texts / batch_size) AS BIGINT) AS n_requests FROM grid JOIN sized USING (chunk_index)""")
def parameter_grid(spark, sf_dir):
    grid = tables.parameter_grid(spark, batch_size=[1, 4, 8, 16, 32],
                                 concurrent_requests=[1, 5, 10, 20])
    # 20 rows of constants: numbered by their place in the two lists
    place = F.array_position(F.array(*map(F.lit, [1, 4, 8, 16, 32])), F.col("batch_size")) * 4 - 4 \
        + F.array_position(F.array(*map(F.lit, [1, 5, 10, 20])), F.col("concurrent_requests"))
    grid = grid.withColumn("chunk_index", place % 20 + 1)
    documents = table(spark, sf_dir, "documents").select(F.length("text").alias("chars"))
    placed = batching.with_chunk(documents, 1, index="position")
    sized = placed.groupBy(((F.col("position") - 1) % 20 + 1).alias("chunk_index")).agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.sum("chars").cast("bigint").alias("total_chars"))
    return sized.join(F.broadcast(grid), "chunk_index").withColumn(
        "n_requests", F.ceil(F.col("n_texts") / F.col("batch_size")).cast("bigint"))


@query("s1_bind_rows", """
SELECT doc_id, lang, CAST(NULL AS VARCHAR) AS url, 'document' AS kind FROM documents
UNION ALL SELECT page_id, NULL, url, 'page' FROM pages
UNION ALL SELECT item_id, NULL, NULL, 'item' FROM benchmark""")
def bind_rows(spark, sf_dir):
    return joining.bind_rows(
        table(spark, sf_dir, "documents").select("doc_id", "lang", F.lit("document").alias("kind")),
        table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "url",
                                             F.lit("page").alias("kind")),
        table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"),
                                                 F.lit("item").alias("kind")))


@query("s2_bind_columns", f"""
SELECT vec_id, false AS error, CAST(NULL AS VARCHAR) AS error_msg, {wide_sql("true")}
FROM embeddings""")
def bind_columns(spark, sf_dir):
    vector = F.col("embedding").cast("array<double>")
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.lit(False).alias("error"), F.lit(None).cast("string").alias("error_msg"),
        *widen(vector, SIZE))


# --- reports -----------------------------------------------------------------------------------

@query("m2_chunk_summary", """
SELECT CAST(ceil(position / 250.0) AS INTEGER) AS chunk,
  count(*) FILTER (doc_id % 10 NOT IN (3, 5, 6, 7, 8)) AS succeeded,
  count(*) FILTER (doc_id % 10 IN (3, 5, 6, 7, 8)) AS failed
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS position FROM documents) GROUP BY 1""")
def chunk_summary(spark, sf_dir):
    placed = batching.with_chunk(table(spark, sf_dir, "documents"), 250)
    responses = an.chat_answers(placed).select(
        "doc_id", "chunk", F.struct("status", "body", "failure").alias("response"))
    return reports.chunk_summary(inf.tidy_responses(responses, inf.messages_task()))


@query("m3_error_counts", f"""
SELECT doc_id % 10 IN (3, 5, 6, 7, 8) AS error, {an.CHAT_ERROR_SQL} AS error_msg,
  CAST(CASE WHEN doc_id % 10 IN (3, 5, 6, 7) THEN {an.CHAT_STATUS_SQL} END AS INTEGER) AS status,
  count(*) AS n FROM documents GROUP BY ALL""")
def error_counts(spark, sf_dir):
    responses = an.chat_answers(table(spark, sf_dir, "documents")).select(
        "doc_id", F.struct("status", "body", "failure").alias("response"))
    return reports.error_counts(inf.tidy_responses(responses, inf.messages_task()))


@query("m4_length_summary", """
SELECT lang, round(avg(length(text)), 6) AS mean_chars, count(*) AS n FROM documents GROUP BY lang""")
def length_summary(spark, sf_dir):
    return reports.length_summary(table(spark, sf_dir, "documents"), "text", ["lang"]).withColumn(
        "mean_chars", F.round("mean_chars", 6))


@query("m5_duplicate_report", """
WITH found AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 1)
SELECT user_id, n, (SELECT count(*) FROM found) AS n_duplicates FROM found ORDER BY user_id LIMIT 3""")
def duplicate_report(spark, sf_dir):
    return ids.duplicate_report(table(spark, sf_dir, "events"), "user_id")


@query("m6_chunk_count", """
SELECT CAST(ceil(count(*) / 5000.0) AS BIGINT) AS n_chunks FROM lineitem""")
def chunk_count(spark, sf_dir):
    return reports.chunk_count(table(spark, sf_dir, "lineitem"), 5000)


RUNS_SQL = """
  SELECT event_type, user_id, count(*) AS rows_processed, round(sum(value), 2) AS elapsed_time
  FROM events GROUP BY event_type, user_id"""


@query("m7_throughput", f"""
SELECT event_type, CAST(sum(rows_processed) AS BIGINT) AS rows, round(sum(elapsed_time), 2) AS seconds,
  round(sum(rows_processed) / sum(elapsed_time), 6) AS rows_per_second
FROM ({RUNS_SQL}) GROUP BY event_type""")
def throughput(spark, sf_dir):
    log = table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(
        F.count(F.lit(1)).alias("rows_processed"), F.round(F.sum("value"), 2).alias("elapsed_time"))
    found = reports.throughput(log, ["event_type"])
    return found.withColumns({"seconds": F.round("seconds", 2),
                              "rows_per_second": F.round("rows_per_second", 6)})


@query("m8_linear_model", """
WITH d AS (
  SELECT l_extendedprice AS y, CAST(l_quantity AS DOUBLE) AS a, CAST(l_discount AS DOUBLE) AS b
  FROM lineitem),
s AS (
  SELECT count(*) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, var_pop(y) AS yy, var_pop(a) AS aa,
    var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS yb FROM d),
c AS (SELECT *, aa * bb - ab * ab AS det, (bb * ay - ab * yb) / (aa * bb - ab * ab) AS ba,
             (aa * yb - ab * ay) / (aa * bb - ab * ab) AS be FROM s),
v AS (SELECT *, (yy - ba * ay - be * yb) / (n - 3) AS noise FROM c),
terms AS (
  SELECT '(Intercept)' AS term, my - ba * ma - be * mb AS estimate,
    sqrt(noise * (1 + (ma * ma * bb - 2 * ma * mb * ab + mb * mb * aa) / det)) AS std_error FROM v
  UNION ALL SELECT 'l_quantity', ba, sqrt(noise * bb / det) FROM v
  UNION ALL SELECT 'l_discount', be, sqrt(noise * aa / det) FROM v)
SELECT term, round(estimate, 3) AS estimate, round(std_error, 4) AS std_error,
  round(estimate / std_error, 3) AS statistic FROM terms""")
def linear_model(spark, sf_dir):
    fit = reports.linear_model(table(spark, sf_dir, "lineitem"), "l_extendedprice",
                               ["l_quantity", "l_discount"])
    return fit.select("term", F.round("estimate", 3).alias("estimate"),
                      F.round("std_error", 4).alias("std_error"),
                      F.round("statistic", 3).alias("statistic"))


# --- order, slices, samples --------------------------------------------------------------------

@query("k2_restore_order", f"""
SELECT row_number() OVER (ORDER BY page_id) AS index,
  CASE WHEN {an.TEXT_OK_SQL} THEN length(text) || ' characters' END AS content
FROM (SELECT page_id, html AS text FROM pages)""")
def restore_order(spark, sf_dir):
    pages = batching.with_chunk(table(spark, sf_dir, "pages").select("page_id", "html"), 1000,
                                "page_id", index="index")
    results = inf.infer(pages, "html", "page_id", inf.chat_task(), an.ChatBackend,
                        chunk_size=None, retry=an.FAST_RETRY, keep=["index"])
    return results.orderBy("index").select("index", "content")


@query("k3_slice", """
SELECT o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS p FROM orders)
WHERE p BETWEEN 501 AND 1500""")
def slice_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return tables.slice_rows(orders, ["o_totalprice", "o_orderkey"], 501, 1500)


@query("k4_sample", """
SELECT doc_id, lang FROM documents ORDER BY md5(doc_id || ':7'), doc_id LIMIT 200""")
def sample_rows(spark, sf_dir):
    return tables.sample_rows(table(spark, sf_dir, "documents").select("doc_id", "lang"),
                              "doc_id", 200, seed=7)
