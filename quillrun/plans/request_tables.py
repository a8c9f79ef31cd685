"""Queries: request bodies and batch lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrun.functions import requests as rq
from quillrun.functions import responses as rs
from quillrun.operators import tables
from quillrun.operators.inference import chat_task, classify_task, request_table
from quillrun.operators.prepare import prepare_batches
from quillrun.operators.results import parse_lines
from quillrun.plans.answers import LINE_ID_SQL, REVIEW, chat_lines
from quillrun.plans.registry import query, table

PROMPT = 'Answer with "one word"\nonly.'
PROMPT_SQL = '\'"Answer with \\"one word\\"\\nonly."\''
RAW_SCHEMA = {"type": "json_schema", "json_schema": {"name": "raw", "schema": {
    "type": "object", "properties": {"note": {"type": ["string", "null"]}},
    "required": ["note"], "additionalProperties": False}, "strict": True}}
RAW_SCHEMA_SQL = (
    '{"type":"json_schema","json_schema":{"name":"raw","schema":{"type":"object","properties":'
    '{"note":{"type":["string","null"]}},"required":["note"],"additionalProperties":false},'
    '"strict":true}}')
REVIEW_SQL = (
    '{"type":"object","properties":{"lang":{"type":"string","enum":["de","en","es","fr"],'
    '"description":"language of the text"},"n_chars":{"type":"integer","description":'
    '"length of the text","minimum":1},"grade":{"type":"number","description":"1 to 5",'
    '"minimum":1,"maximum":5},"tags":{"type":"array","items":{"type":"object","properties":'
    '{"name":{"type":"string"},"weight":{"type":"number","minimum":0,"maximum":1}},'
    '"additionalProperties":false,"required":["name","weight"]},"minItems":1,"maxItems":3}},'
    '"additionalProperties":false,"required":["lang","n_chars","grade"]}')
REVIEW_FORMAT_SQL = ('{"type":"json_schema","json_schema":{"name":"review","schema":' + REVIEW_SQL
                     + ',"strict":true,"description":"Review of one document"}}')


def turns(spark, sf_dir):
    """Conversation turns under one text id."""
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("turn_id"), "role", "text")


TURN_ID = "conv_id || '-' || turn"


@query("b1_inference_requests", """
SELECT doc_id, '{"inputs":' || to_json(text) || ',"parameters":[]}' AS request FROM documents""")
def inference_requests(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", rq.inference_request(F.col("text")).alias("request"))


@query("b2_request_frame", """
SELECT doc_id, lang, source,
       '{"inputs":' || to_json(text) || ',"parameters":{"truncate":true}}' AS request
FROM documents""")
def request_frame(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.withColumn("request", rq.inference_request(
        F.col("text"), rq.EMBED_PARAMETERS)).select("doc_id", "lang", "source", "request")


@query("b3_task_parameters", """
SELECT page_id, '{"inputs":' || to_json(html)
  || ',"parameters":{"return_all_scores":true,"truncation":true,"max_length":512}}' AS request
FROM pages""")
def task_parameters(spark, sf_dir):
    return request_table(table(spark, sf_dir, "pages"), "html", "page_id", classify_task())


@query("b4_embedding_requests", """
SELECT doc_id, '{"input":' || to_json(text) || ',"model":"text-embedding-3-small",'
  || '"dimensions":null,"encoding_format":"float"}' AS request,
  CAST(length(text) AS BIGINT) AS total_chars FROM documents""")
def embedding_requests(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", rq.embedding_request(F.col("text")).alias("request"),
        F.length("text").cast("bigint").alias("total_chars"))


@query("b5_chat_requests", f"""
SELECT {TURN_ID} AS turn_id,
  '{{"model":"gpt-4.1-nano","messages":[{{"role":"system","content":' || {PROMPT_SQL}
  || '}},{{"role":"user","content":' || to_json(text)
  || '}}],"temperature":0.5,"max_tokens":500,"response_format":{REVIEW_FORMAT_SQL}}}' AS request
FROM conversations""")
def chat_requests(spark, sf_dir):
    return turns(spark, sf_dir).select("turn_id", rq.chat_request(
        F.col("text"), system_prompt=PROMPT, temperature=0.5, schema=REVIEW).alias("request"))


@query("b6_chat_request_list", """
SELECT page_id, '{"model":"gpt-4.1-nano","messages":[{"role":"user","content":' || to_json(html)
  || '}],"temperature":0,"max_tokens":500}' AS request FROM pages""")
def chat_request_list(spark, sf_dir):
    return request_table(table(spark, sf_dir, "pages"), "html", "page_id", chat_task(),
                         on_invalid="fail")


@query("b6_invalid_text_refused", "SELECT count(*) AS n_rows, true AS refused FROM documents")
def invalid_text_refused(spark, sf_dir):
    """With the refusing policy, one row without text stops the whole list, and says which it is."""
    documents = table(spark, sf_dir, "documents")
    blanked = documents.withColumn("text", F.when(F.col("doc_id") % 1000 != 8, F.col("text")))
    requests = request_table(blanked, "text", "doc_id", chat_task(), on_invalid="fail")
    try:
        requests.agg(F.max(F.length("request"))).collect()
        refused = False
    except Exception as error:  # raised in a task, and so wrapped in one of several types
        refused = tables.INVALID_TEXT in str(error) and "row " in str(error)
    return documents.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("refused", F.lit(refused))


@query("b7_messages_requests", f"""
SELECT {TURN_ID} AS turn_id,
  '{{"model":"claude-haiku-4-5","messages":[{{"role":"user","content":' || to_json(text)
  || '}}],"max_tokens":500,"temperature":0,"system":[{{"type":"text","text":' || {PROMPT_SQL}
  || ',"cache_control":{{"type":"ephemeral"}}}}],"output_config":{{"format":{{"type":"json_schema",'
  || '"schema":{REVIEW_SQL}}}}}}}' AS request
FROM conversations""")
def messages_requests(spark, sf_dir):
    return turns(spark, sf_dir).select("turn_id", rq.messages_request(
        F.col("text"), system_prompt=PROMPT, schema=REVIEW).alias("request"))


@query("b8_embedding_lines", """
SELECT doc_id, '{"custom_id":"' || doc_id || '","method":"POST","url":"/v1/embeddings","body":'
  || '{"input":' || to_json(text) || ',"model":"text-embedding-3-small","dimensions":360,'
  || '"encoding_format":"float"}}' AS line FROM documents""")
def embedding_batch_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", rq.embedding_batch_line(
        F.col("doc_id"), F.col("text"), dimensions=360).alias("line"))


CHAT_LINE_SQL = f"""'{{"custom_id":"' || doc_id || '","method":"POST","url":"/v1/chat/completions",'
  || '"body":{{"model":"gpt-4o-mini","messages":[{{"role":"system","content":' || {PROMPT_SQL}
  || '}},{{"role":"user","content":' || to_json(text) || '}}],"temperature":0,"max_tokens":500'"""


@query("b9_chat_lines", f"SELECT doc_id, {CHAT_LINE_SQL} || '}}}}' AS line FROM documents")
def chat_batch_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", rq.chat_batch_line(
        F.col("doc_id"), F.col("text"), system_prompt=PROMPT).alias("line"))


@query("b10_prepare_embeddings", """
SELECT doc_id, CAST(1 + (row_number() OVER (ORDER BY doc_id) - 1) // 50000
    + floor(before / (200000000 - longest)) AS BIGINT) AS batch, line
FROM (
  SELECT *, coalesce(sum(strlen(line) + 1) OVER (ORDER BY doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    max(strlen(line) + 1) OVER () AS longest
  FROM (SELECT doc_id, '{"custom_id":"' || doc_id || '","method":"POST","url":"/v1/embeddings",'
    || '"body":{"input":' || to_json(text) || ',"model":"text-embedding-3-small",'
    || '"encoding_format":"float"}}' AS line FROM documents))""")
def prepare_embeddings(spark, sf_dir):
    return prepare_batches(table(spark, sf_dir, "documents"), "text", "doc_id", "embeddings")


@query("b10_prepare_completions", f"""
SELECT doc_id, CAST(1 + (row_number() OVER (ORDER BY doc_id) - 1) // 400 AS BIGINT) AS batch,
  {CHAT_LINE_SQL} || ',"response_format":{REVIEW_FORMAT_SQL}}}}}' AS line FROM documents""")
def prepare_completions(spark, sf_dir):
    return prepare_batches(table(spark, sf_dir, "documents"), "text", "doc_id", "completions",
                           max_rows=400, max_bytes=10 ** 15, system_prompt=PROMPT, schema=REVIEW)


@query("b11_messages_entries", f"""
SELECT turn_id, '{{"custom_id":"' || turn_id
  || '","params":{{"model":"claude-haiku-4-5","max_tokens":1024,"temperature":0,"messages":'
  || '[{{"role":"user","content":' || to_json(text) || '}}],"system":' || {PROMPT_SQL}
  || ',"cache_control":{{"type":"ephemeral"}},"output_config":{{"format":{{"type":"json_schema",'
  || '"schema":{REVIEW_SQL}}}}}}}}}' AS line,
  CAST(1 + (row_number() OVER (ORDER BY turn_id) - 1) // 100000 AS BIGINT) AS batch
FROM (SELECT {TURN_ID} AS turn_id, text FROM conversations)""")
def messages_entries(spark, sf_dir):
    return prepare_batches(turns(spark, sf_dir), "text", "turn_id", "messages",
                           max_bytes=10 ** 15, system_prompt=PROMPT, schema=REVIEW)


@query("b12_request_ids", f"""
SELECT {TURN_ID} AS turn_id, role,
  '{{"model":"gpt-4.1-nano","messages":[{{"role":"user","content":' || to_json(text)
  || '}}],"temperature":0,"max_tokens":500}}' AS request FROM conversations""")
def request_ids(spark, sf_dir):
    return request_table(turns(spark, sf_dir), "text", "turn_id", chat_task(), keep=["role"])


@query("b13_rename_id", f"""
SELECT {LINE_ID_SQL} AS doc_id, doc_id % 10 IN (3, 5, 6) AS error FROM documents""")
def rename_id(spark, sf_dir):
    lines = chat_lines(table(spark, sf_dir, "documents"), F.col("source"))
    return parse_lines(lines, "completions", id="doc_id").select("doc_id", "error")


@query("b14_rename_labels", """
SELECT doc_id, (quality * 4 + toxic * 2 + 1) / 8 AS positive,
       1 - (quality * 4 + toxic * 2 + 1) / 8 AS negative FROM labels""")
def rename_labels(spark, sf_dir):
    score = (F.col("quality") * 4 + F.col("toxic") * 2 + 1) / 8
    body = F.to_json(F.array(F.array(
        F.struct(F.lit("LABEL_1").alias("label"), score.alias("score")),
        F.struct(F.lit("LABEL_0").alias("label"), (1 - score).alias("score")))))
    scores = rs.rename_labels(rs.classification_scores(body),
                              {"LABEL_0": "negative", "LABEL_1": "positive"})
    return table(spark, sf_dir, "labels").select(
        "doc_id", *rs.label_columns(scores, ["positive", "negative"]))


WIDE_SQL = ", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS V{i}" for i in range(1, 65))


@query("b15_embedding_columns", f"SELECT {WIDE_SQL} FROM embeddings")
def embedding_columns(spark, sf_dir):
    wide = table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", *rs.widen(F.col("embedding").cast("array<double>"), 64))
    return tables.embedding_columns(wide)


@query("b16_column_order", """
SELECT html AS text, doc_error AS error, doc_message AS error_msg, doc_status AS status, page_id
FROM (SELECT *, page_id % 7 = 0 AS doc_error,
             CASE WHEN page_id % 7 = 0 THEN 'planted' END AS doc_message,
             CAST(CASE WHEN page_id % 7 = 0 THEN 500 END AS INTEGER) AS doc_status FROM pages)""")
def column_order(spark, sf_dir):
    planted = F.col("page_id") % 7 == 0
    results = table(spark, sf_dir, "pages").select(
        "page_id", planted.alias("error"), F.when(planted, "planted").alias("error_msg"),
        F.when(planted, 500).alias("status"), F.col("html").alias("text"))
    return tables.order_columns(results, first=["text"])
