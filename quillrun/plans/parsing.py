"""Queries: response bodies and batch result lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrun.functions import responses as rs
from quillrun.functions.payload import NULL, Slot, render, text_slot
from quillrun.operators import reports, results
from quillrun.operators.exploding import each, each_object
from quillrun.operators.inference import messages_task, tidy_batched, tidy_responses
from quillrun.plans import answers as an
from quillrun.plans.registry import query, table
from quillrun.sources.jsonl import split_lines


def documents_of(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@query("e1_api_errors", f"""
SELECT doc_id, {an.CHAT_ERROR_SQL} AS error_msg FROM documents""")
def api_errors(spark, sf_dir):
    return an.chat_answers(documents_of(spark, sf_dir)).select(
        "doc_id", rs.api_error(F.col("status"), F.col("body"), F.col("failure")).alias("error_msg"))


@query("e2_error_rows", f"""
SELECT doc_id, true AS error, {an.CHAT_ERROR_SQL} AS error_msg,
  CAST({an.CHAT_STATUS_SQL} AS INTEGER) AS status FROM documents
WHERE doc_id % 10 IN (3, 5, 6, 7, 8)""")
def error_rows(spark, sf_dir):
    answered = an.chat_answers(documents_of(spark, sf_dir)).select(
        "doc_id", F.struct("status", "body", "failure").alias("response"))
    tidy = tidy_responses(answered, messages_task())
    return tidy.where("error").select("doc_id", "error", "error_msg", "status")


SIZE = 64


def wide_sql(condition: str, first: int = 1, count: int = SIZE) -> str:
    """V1..Vn out of a SQL list, NULL where the condition does not hold."""
    return ", ".join(f"CASE WHEN {condition} THEN CAST(embedding[{first + i}] AS DOUBLE) END "
                     f"AS V{i + 1}" for i in range(count))


def vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").withColumn(
        "vector", F.col("embedding").cast("array<double>"))


@query("e3_embedding_bodies", f"SELECT vec_id, {wide_sql('vec_id % 4 < 3')} FROM embeddings")
def embedding_bodies(spark, sf_dir):
    vector, kind = F.to_json("vector"), F.col("vec_id") % 4
    body = F.when(kind == 0, F.concat(F.lit("["), vector, F.lit("]"))) \
        .when(kind == 1, F.concat(F.lit('{"embedding":'), vector, F.lit("}"))) \
        .when(kind == 2, vector).otherwise('{"error":"none"}')
    return vectors(spark, sf_dir).withColumn("v", rs.embedding_vector(body)).select(
        "vec_id", *rs.widen(F.col("v"), SIZE))


@query("e4_indexed_embeddings", f"""
SELECT vec_id, CAST(0 AS INTEGER) AS oai_index, {wide_sql("true", 1, 32)} FROM embeddings
UNION ALL
SELECT vec_id, CAST(1 AS INTEGER), {wide_sql("true", 33, 32)} FROM embeddings""")
def indexed_embeddings(spark, sf_dir):
    data = [{"object": "embedding", "index": i,
             "embedding": Slot(F.to_json(F.slice("vector", 32 * i + 1, 32)))} for i in (0, 1)]
    body = F.when(F.col("vec_id") % 2 == 0, render({"data": data})).otherwise(render(data))
    rows = each_object(vectors(spark, sf_dir), rs.indexed_embeddings(body), ["vec_id"])
    return rows.select("vec_id", F.col("index").alias("oai_index"),
                       *rs.widen(F.col("embedding"), 32))


@query("e5_widen", f"SELECT vec_id, {wide_sql('vec_id % 3 = 0')} FROM embeddings")
def widen(spark, sf_dir):
    kind = F.col("vec_id") % 3
    vector = F.when(kind == 0, F.col("vector")).when(kind == 2, F.slice("vector", 1, SIZE - 1))
    return vectors(spark, sf_dir).withColumn("v", vector).select(
        "vec_id", *rs.widen(F.col("v"), SIZE))


def score():
    return (F.col("quality") * 4 + F.col("toxic") * 2 + 1) / 8


def scored(value, low="LABEL_0", high="LABEL_1"):
    return F.array(F.struct(F.lit(high).alias("label"), value.alias("score")),
                   F.struct(F.lit(low).alias("label"), (1 - value).alias("score")))


@query("e6_classification", """
SELECT doc_id, CASE WHEN doc_id % 5 <> 4 THEN (quality * 4 + toxic * 2 + 1) / 8 END AS "LABEL_1",
  CASE WHEN doc_id % 5 <> 4 THEN 1 - (quality * 4 + toxic * 2 + 1) / 8 END AS "LABEL_0" FROM labels""")
def classification(spark, sf_dir):
    kind = F.col("doc_id") % 5
    body = F.when(kind < 2, F.to_json(F.array(scored(score())))) \
        .when(kind < 4, F.to_json(scored(score()))) \
        .otherwise(F.to_json(scored(score(), "LABEL_1", "LABEL_1")))
    scores = rs.classification_scores(body)
    return table(spark, sf_dir, "labels").select(
        "doc_id", *rs.label_columns(scores, ["LABEL_0", "LABEL_1"]))


@query("e7_batch_classification", """
SELECT doc_id, unnest(['quality', 'toxic']) AS item,
  unnest([(quality * 2 + 1) / 4, (toxic * 2 + 1) / 4]) AS high,
  unnest([1 - (quality * 2 + 1) / 4, NULL]) AS low FROM labels""")
def batch_classification(spark, sf_dir):
    quality, toxic = (F.col("quality") * 2 + 1) / 4, (F.col("toxic") * 2 + 1) / 4
    body = F.to_json(F.array(scored(quality, "low", "high"),
                             F.array(F.struct(F.lit("high").alias("label"), toxic.alias("score")))))
    names = F.array(F.struct(F.lit("quality").alias("item")), F.struct(F.lit("toxic").alias("item")))
    responses = table(spark, sf_dir, "labels").select(
        F.transform(names, lambda x: x.withField("doc_id", F.col("doc_id"))).alias("items"),
        F.struct(F.lit(200).alias("status"), body.alias("body"),
                 F.lit(None).cast("string").alias("failure")).alias("response"))
    rows = tidy_batched(responses, "scores", rs.classification_scores_multi)
    return rows.select("doc_id", "item", *rs.label_columns(F.col("scores"), ["high", "low"]))


@query("e7_pivot_labels", """
SELECT doc_id, max(CASE WHEN true THEN (quality * 4 + toxic * 2 + 1) / 8 END) AS "LABEL_1",
  max(1 - (quality * 4 + toxic * 2 + 1) / 8) AS "LABEL_0" FROM labels GROUP BY doc_id""")
def pivot_labels(spark, sf_dir):
    long = table(spark, sf_dir, "labels").select("doc_id", F.inline(scored(score())))
    return long.groupBy("doc_id").pivot("label", ["LABEL_0", "LABEL_1"]).agg(F.first("score"))


@query("e8_completion_content", """
SELECT doc_id, CASE WHEN doc_id % 10 IN (0, 1, 2, 4) THEN text || ' ' || lang END AS content
FROM documents""")
def completion_content(spark, sf_dir):
    return an.chat_answers(documents_of(spark, sf_dir)).select(
        "doc_id", rs.completion_content(F.col("body")).alias("content"))


@query("e9_message_content", """
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN lang END AS content FROM documents""")
def message_content(spark, sf_dir):
    def block(column):
        return {"type": "text", "text": text_slot(F.col(column))}

    kind = F.col("doc_id") % 4
    body = F.when(kind == 0, render({"content": [block("text"), block("lang")]})) \
        .when(kind == 1, render({"content": [{"type": "tool_use"}, block("lang")]})) \
        .when(kind == 2, render({"content": []})).otherwise(render({"content": [{"type": "tool_use"}]}))
    return documents_of(spark, sf_dir).select("doc_id", rs.message_content(body).alias("content"))


@query("e10_response_fields", f"""
SELECT doc_id, CAST({an.CHAT_STATUS_SQL} AS INTEGER) AS status,
  CASE WHEN doc_id % 10 IN (0, 1, 2, 4) THEN text || ' ' || lang END AS content,
  CASE WHEN doc_id % 10 = 8 THEN 'Invalid response object' ELSE {an.CHAT_ERROR_SQL} END AS error_msg
FROM documents""")
def response_fields(spark, sf_dir):
    answered = an.chat_answers(documents_of(spark, sf_dir))
    return answered.select("doc_id", rs.response_fields(F.col("status"), F.col("body"))
                           .alias("fields")).select("doc_id", "fields.*")


@query("e11_safe_json", """
SELECT event_id, event_id % 3 <> 2 AS readable,
  CASE WHEN event_id % 3 = 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events""")
def safe_json(spark, sf_dir):
    kind = F.col("event_id") % 3
    text = F.when(kind == 0, F.col("props")).when(kind == 1, "[1, 2]").otherwise("{broken")
    return table(spark, sf_dir, "events").withColumn("json", rs.parse_json(text)).select(
        "event_id", F.col("json").isNotNull().alias("readable"),
        F.try_variant_get("json", "$.k", "bigint").alias("k"))


@query("e14_extract_field", """
SELECT event_id, unnest([json_extract_string(props, '$.k'), CAST(user_id AS VARCHAR), '"' || event_type || '"'])
  AS value, CAST(unnest([1, 2, 3]) AS INTEGER) AS place FROM events""")
def extract_field(spark, sf_dir):
    nested = render({
        "props": Slot(F.col("props")), "list": [{"k": an.number(F.col("user_id"))}, 7, {"k": NULL}],
        "last": {"deep": [{"k": text_slot(F.col("event_type"))}], "k": []}})
    events = table(spark, sf_dir, "events").select("event_id", rs.extract_field(nested, "k").alias("f"))
    return each(events, "f", ["event_id"], "value").select(
        "event_id", "value", (F.col("at") + 1).alias("place"))


@query("e15_embedding_lines", f"""
SELECT CASE WHEN vec_id % 10 = 6 THEN '__PARSE_ERROR_LINE_' || (vec_id + 1)
    ELSE CAST(vec_id AS VARCHAR) END AS custom_id, vec_id % 10 IN (3, 5, 6, 7) AS error,
  CASE vec_id % 10 WHEN 3 THEN 'Too many tokens' WHEN 5 THEN 'plain text'
    WHEN 6 THEN 'Failed to parse JSONL line ' || (vec_id + 1)
    WHEN 7 THEN 'No embedding found in response' END AS error_msg,
  {wide_sql("vec_id % 10 NOT IN (3, 5, 6, 7)")}
FROM embeddings""")
def embedding_lines(spark, sf_dir):
    lines = an.embedding_lines(table(spark, sf_dir, "embeddings"))
    return results.parse_lines(lines, "embeddings").select(
        "custom_id", "error", "error_msg", *rs.widen(F.col("embedding"), SIZE))


@query("e16_completion_lines", f"""
SELECT {an.LINE_ID_SQL} AS custom_id,
  CASE WHEN doc_id % 10 NOT IN (3, 5, 6, 7) THEN text || '/' || lang END AS content,
  doc_id % 10 IN (3, 5, 6) AS error, {an.CHAT_LINE_ERROR_SQL} AS error_msg FROM documents""")
def completion_lines(spark, sf_dir):
    lines = an.chat_lines(documents_of(spark, sf_dir), F.concat_ws("/", "text", "lang"))
    return results.parse_lines(lines, "completions")


@query("e16_completion_lines_strict", f"""
SELECT {an.LINE_ID_SQL} AS custom_id, doc_id % 10 IN (3, 5, 6, 7) AS error,
  CASE WHEN doc_id % 10 = 7 THEN 'Bad request ' || lang ELSE {an.CHAT_LINE_ERROR_SQL} END AS error_msg
FROM documents""")
def completion_lines_strict(spark, sf_dir):
    lines = an.chat_lines(documents_of(spark, sf_dir), F.col("text"))
    return results.parse_lines(lines, "completions", strict=True).drop("content")


MESSAGE_LINES_SQL = """
SELECT CASE WHEN kind = 6 THEN '__PARSE_ERROR_LINE_' || (doc_id + 1)
    ELSE CAST(doc_id AS VARCHAR) END AS custom_id,
  CASE WHEN kind NOT IN (2, 3, 4, 5, 6, 7) THEN text || ' ' || lang END AS content,
  kind IN (3, 4, 5, 6, 7) AS error,
  CASE kind WHEN 3 THEN 'Invalid ' || lang WHEN 4 THEN 'Unknown error' WHEN 5 THEN 'canceled'
    WHEN 6 THEN 'Failed to parse JSONL line ' || (doc_id + 1) WHEN 7 THEN 'expired' END AS error_msg,
  CASE WHEN kind = 1 THEN 'tool_use' WHEN kind = 2 THEN 'max_tokens'
    WHEN kind NOT IN (3, 4, 5, 6, 7) THEN 'end_turn' END AS stop_reason,
  CASE WHEN kind NOT IN (3, 4, 5, 6, 7) THEN n_chars END AS input_tokens,
  CASE WHEN kind NOT IN (3, 4, 5, 6, 7) THEN doc_id % 100 END AS output_tokens
FROM (SELECT *, doc_id % 10 AS kind FROM documents)"""


@query("e17_message_lines", MESSAGE_LINES_SQL)
def message_lines(spark, sf_dir):
    return results.parse_lines(an.message_lines(documents_of(spark, sf_dir)), "messages")


@query("e18_empty_content", f"""
SELECT * REPLACE (CASE WHEN error AND starts_with(custom_id, '__') THEN '__PARSE_ERROR_LINE_1'
                       ELSE custom_id END AS custom_id,
                  CASE WHEN starts_with(custom_id, '__') THEN 'Failed to parse JSONL line 1'
                       ELSE error_msg END AS error_msg)
FROM ({MESSAGE_LINES_SQL}) WHERE NOT blank""".replace("FROM (SELECT *,", ", doc_id % 3 = 0 AS blank FROM (SELECT *,")
       .replace("SELECT * REPLACE", "SELECT * EXCLUDE (blank) REPLACE"))
def empty_content(spark, sf_dir):
    """Files without content among files of one line: no rows for those, and no errors."""
    newlines = F.repeat(F.lit("\n"), (F.col("doc_id") % 4).cast("int"))
    files = an.message_lines(documents_of(spark, sf_dir)).select(
        F.when(F.col("doc_id") % 3 == 0, newlines).otherwise(F.concat(newlines, "line", newlines))
        .alias("body"))
    return results.parse_lines(split_lines(files, "body"), "messages")


@query("e19_http_dates", """
SELECT event_id, CASE WHEN event_id % 5 <> 4 THEN CAST(ts AS DATE) END AS day FROM events""")
def http_dates(spark, sf_dir):
    header = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    text = F.when(F.col("event_id") % 5 != 4, header).otherwise("yesterday")
    return table(spark, sf_dir, "events").select("event_id", rs.http_date(text).alias("day"))


def statuses(spark, sf_dir):
    """One provider batch per (user, event type): its status object as the provider reports it."""
    counted = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 5).alias("high"))
    done = F.col("user_id") % 3 != 0
    body = F.to_json(F.struct(
        F.concat_ws("-", F.lit("batch"), "user_id", "event_type").alias("id"),
        F.lit("message_batch").alias("type"),
        F.when(done, "ended").otherwise("in_progress").alias("processing_status"),
        F.struct(F.when(done, 0).otherwise(F.col("n") - F.col("high")).alias("processing"),
                 F.col("high").alias("succeeded"),
                 F.when(done, F.col("n") - F.col("high")).otherwise(0).alias("errored"),
                 F.lit(0).alias("canceled"), F.lit(0).alias("expired")).alias("request_counts")))
    return counted.select("user_id", "event_type", body.alias("body"))


STATUS_SQL = """
  SELECT user_id, event_type, user_id % 3 <> 0 AS ended, count(*) AS n,
         count(*) FILTER (value > 5) AS high FROM events GROUP BY user_id, event_type"""


@query("e20_batch_status", f"""
SELECT 'batch-' || user_id || '-' || event_type AS batch_id,
  CASE WHEN ended THEN 'ended' ELSE 'in_progress' END AS status, ended, high AS succeeded,
  CASE WHEN ended THEN 0 ELSE n - high END AS processing,
  CASE WHEN ended THEN n - high ELSE 0 END AS errored FROM ({STATUS_SQL})""")
def batch_status(spark, sf_dir):
    return results.status_table(statuses(spark, sf_dir), "body").select(
        "batch_id", "status", "ended", "succeeded", "processing", "errored")


@query("e20_job_progress", f"""
SELECT event_type, count(*) AS batches, bool_and(ended) AS all_ended,
  CAST(sum(CASE WHEN ended THEN 0 ELSE n - high END) AS BIGINT) AS processing,
  CAST(sum(high) AS BIGINT) AS succeeded,
  CAST(sum(CASE WHEN ended THEN n - high ELSE 0 END) AS BIGINT) AS errored,
  CAST(0 AS BIGINT) AS canceled, CAST(0 AS BIGINT) AS expired
FROM ({STATUS_SQL}) GROUP BY event_type""")
def job_progress(spark, sf_dir):
    progress = results.status_table(statuses(spark, sf_dir), "body", ["event_type"])
    return results.job_progress(progress, "event_type")


@query("e21_token_usage", """
SELECT doc_id, CASE WHEN ok THEN n_chars END AS input_tokens,
  CAST(CASE WHEN ok THEN 7 END AS BIGINT) AS output_tokens,
  CASE WHEN ok THEN n_chars + 7 END AS total_tokens
FROM (SELECT doc_id, n_chars, doc_id % 10 IN (0, 1, 2, 4) AS ok FROM documents)""")
def token_usage(spark, sf_dir):
    return an.chat_answers(documents_of(spark, sf_dir)).select(
        "doc_id", rs.token_usage(F.col("body")).alias("usage")).select("doc_id", "usage.*")


@query("m9_token_totals", f"""
SELECT stop_reason, count(*) AS n, coalesce(CAST(sum(input_tokens) AS BIGINT), 0) AS input_tokens,
  coalesce(CAST(sum(output_tokens) AS BIGINT), 0) AS output_tokens
FROM ({MESSAGE_LINES_SQL}) GROUP BY stop_reason""")
def token_totals(spark, sf_dir):
    return reports.token_totals(message_lines(spark, sf_dir))
