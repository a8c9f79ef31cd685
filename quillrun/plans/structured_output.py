"""Queries: schemas, validation, unnesting."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrun import schema as js
from quillrun.functions import requests as rq
from quillrun.functions import responses as rs
from quillrun.functions.payload import render, text_slot
from quillrun.operators import structured as st
from quillrun.plans import answers as an
from quillrun.plans.registry import query, table
from quillrun.plans.request_tables import RAW_SCHEMA, RAW_SCHEMA_SQL, REVIEW_FORMAT_SQL, REVIEW_SQL

GRADE_SQL = "CASE WHEN doc_id % 8 = 1 THEN n_chars % 5 + 6 ELSE n_chars % 5 + 1 END"


def reviews(spark, sf_dir):
    return an.with_review(table(spark, sf_dir, "documents"))


@query("f9_schema_payloads", f"""
SELECT page_id, '{{"model":"gpt-4.1-nano","messages":[{{"role":"user","content":' || to_json(html)
  || '}}],"temperature":0,"max_tokens":500,"response_format":{REVIEW_FORMAT_SQL}}}' AS chat,
  '{{"model":"claude-haiku-4-5","messages":[{{"role":"user","content":' || to_json(html)
  || '}}],"max_tokens":500,"temperature":0,"output_config":{{"format":{{"type":"json_schema",'
  || '"schema":{REVIEW_SQL}}}}}}}' AS messages FROM pages""")
def schema_payloads(spark, sf_dir):
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id", rq.chat_request(html, schema=an.REVIEW).alias("chat"),
        rq.messages_request(html, schema=an.REVIEW).alias("messages"))


@query("f13_raw_schema", f"""
SELECT doc_id, '{{"custom_id":"' || doc_id || '","method":"POST","url":"/v1/chat/completions",'
  || '"body":{{"model":"gpt-4o-mini","messages":[{{"role":"user","content":' || to_json(text)
  || '}}],"temperature":0,"max_tokens":500,"response_format":{RAW_SCHEMA_SQL}}}}}' AS line
FROM documents""")
def raw_schema(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", rq.chat_batch_line(
        F.col("doc_id"), F.col("text"), schema=RAW_SCHEMA).alias("line"))


@query("f10_valid_content", """
SELECT doc_id, doc_id % 8 = 0 AS valid,
  CAST(CASE doc_id % 8 WHEN 0 THEN 0 WHEN 5 THEN 1 WHEN 7 THEN 2 ELSE 1 END AS INTEGER) AS n_violations
FROM documents""")
def valid_content(spark, sf_dir):
    checked = st.validate_content(reviews(spark, sf_dir), an.REVIEW)
    return checked.select("doc_id", "valid", F.size("violations").alias("n_violations"))


@query("f10_violations", """
SELECT doc_id, 'grade' AS path, 'must be <= 5' AS message FROM documents WHERE doc_id % 8 = 1
UNION ALL SELECT doc_id, 'lang', 'must be equal to one of the allowed values' FROM documents
  WHERE doc_id % 8 = 2
UNION ALL SELECT doc_id, 'root', 'must have required property ''n_chars''' FROM documents
  WHERE doc_id % 8 = 3
UNION ALL SELECT doc_id, 'root', 'must NOT have additional properties' FROM documents
  WHERE doc_id % 8 = 4
UNION ALL SELECT doc_id, 'grade', 'must be number' FROM documents WHERE doc_id % 8 = 5
UNION ALL SELECT doc_id, 'root', 'must be valid JSON' FROM documents WHERE doc_id % 8 = 6
UNION ALL SELECT doc_id, 'tags/1/name', 'must be string' FROM documents WHERE doc_id % 8 = 7
UNION ALL SELECT doc_id, 'tags/1/weight', 'must be <= 1' FROM documents WHERE doc_id % 8 = 7""")
def violations(spark, sf_dir):
    return st.violation_rows(st.validate_content(reviews(spark, sf_dir), an.REVIEW), "doc_id")


EVENT = js.JsonSchema("event", js.object_(
    k=js.integer(minimum=10, maximum=80), user=js.object_(id=js.integer(), kind=js.enum(
        ["click", "view", "purchase"]), required=["id", "kind"]), required=["k", "user"]))


@query("f10_nested_violations", """
SELECT event_id, coalesce(string_agg(text, '; ' ORDER BY rank), '') AS problems FROM (
  SELECT event_id, 1 AS rank, CASE WHEN k < 10 THEN 'Field ''k'': must be >= 10'
    WHEN k > 80 THEN 'Field ''k'': must be <= 80' END AS text
  FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
  UNION ALL
  SELECT event_id, 2, CASE WHEN event_type NOT IN ('click', 'view', 'purchase')
    THEN 'Field ''user/kind'': must be equal to one of the allowed values' END FROM events)
GROUP BY event_id""")
def nested_violations(spark, sf_dir):
    content = F.concat(
        F.regexp_replace("props", r"\}\z", ',"user":'),
        render({"id": an.number(F.col("user_id")), "kind": text_slot(F.col("event_type"))}),
        F.lit("}"))
    events = table(spark, sf_dir, "events").select("event_id", content.alias("content"))
    texts = st.violation_messages(st.validate_content(events, EVENT))
    return texts.select("event_id", F.array_join("violations", "; ").alias("problems"))


TYPED = js.JsonSchema("typed", js.object_(
    k=js.enum([10, 20, 30, 40, 50], type="integer"), half=js.enum([2.5, 7, 20.5], type="number"),
    seen=js.boolean()))


@query("f5_f6_booleans_and_enums", """
SELECT event_id, CAST((k NOT IN (10, 20, 30, 40, 50))::INT + (k / 2 NOT IN (2.5, 7, 20.5))::INT
  + (event_id % 3 = 1)::INT AS INTEGER) AS n_violations
FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""")
def booleans_and_enums(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("bigint")
    content = F.concat(F.lit('{"k":'), k, F.lit(',"half":'), (k / 2).cast("string"), F.lit(',"seen":'),
                       F.when(F.col("event_id") % 3 == 1, '"yes"').when(F.col("event_id") % 3 == 0, "true")
                       .otherwise("false"), F.lit("}"))
    events = table(spark, sf_dir, "events").select("event_id", content.alias("content"))
    return st.validate_content(events, TYPED).select(
        "event_id", F.size("violations").alias("n_violations"))


@query("f12_require_all", """
SELECT doc_id, CAST(CASE doc_id % 8 WHEN 0 THEN 0 WHEN 7 THEN 2 ELSE 1 END
  + CASE WHEN doc_id % 3 = 0 AND doc_id % 8 NOT IN (6, 7) THEN 2 ELSE 0 END AS INTEGER) AS n_violations
FROM documents""")
def require_all(spark, sf_dir):
    """Reviews of which a third have ``tags`` under another name: missing for the strict form, one key
    too many for any, and its items are no longer looked at."""
    without = F.regexp_replace("content", r'"tags":', '"tags_":')
    rows = reviews(spark, sf_dir).withColumn("content", F.when(
        F.col("doc_id") % 3 == 0, without).otherwise(F.col("content")))
    return st.validate_content(rows, an.REVIEW.require_all()).select(
        "doc_id", F.size("violations").alias("n_violations"))


@query("f11_parse_and_validate", f"""
SELECT doc_id, doc_id % 8 = 0 AS valid, CASE WHEN doc_id % 8 = 0 THEN lang END AS lang,
  CASE WHEN doc_id % 8 = 0 THEN n_chars END AS n_chars,
  CASE WHEN doc_id % 8 = 0 THEN CAST({GRADE_SQL} AS DOUBLE) END AS grade,
  CASE WHEN doc_id % 8 = 6 THEN 'no json: ' || text END AS raw FROM documents""")
def parse_and_validate(spark, sf_dir):
    parsed = st.parse_content(reviews(spark, sf_dir).drop("lang", "n_chars"), an.REVIEW)
    raw = F.when(~F.col("valid") & F.col("content").startswith("no json"), F.col("content"))
    return parsed.select("doc_id", "valid", "parsed.lang", "parsed.n_chars", "parsed.grade",
                         raw.alias("raw"))


@query("e12_unnest_content", f"""
SELECT doc_id, CASE WHEN doc_id % 8 = 2 THEN 'xx' WHEN doc_id % 8 <> 6 THEN lang END AS lang,
  CASE WHEN doc_id % 8 NOT IN (3, 6) THEN n_chars END AS n_chars,
  CASE WHEN doc_id % 8 NOT IN (5, 6) THEN CAST({GRADE_SQL} AS DOUBLE) END AS grade,
  CAST(CASE doc_id % 8 WHEN 6 THEN NULL WHEN 7 THEN 2 ELSE 1 END AS INTEGER) AS n_tags
FROM documents""")
def unnest_content(spark, sf_dir):
    content = reviews(spark, sf_dir).select("doc_id", "content")
    return st.unnest_content(content, an.REVIEW).withColumn(
        "n_tags", F.when(F.col("tags").isNotNull(), F.size("tags"))).drop("tags")


@query("e13_unnest_objects", """
SELECT doc_id, text AS name, CAST(0.5 AS DOUBLE) AS weight FROM documents WHERE doc_id % 8 <> 6
UNION ALL
SELECT doc_id, CAST(n_chars AS VARCHAR), 2 FROM documents WHERE doc_id % 8 = 7""")
def unnest_objects(spark, sf_dir):
    parsed = reviews(spark, sf_dir).select(
        "doc_id", rs.structured(F.col("content"), an.REVIEW)["tags"].alias("tags"))
    return st.unnest_objects(parsed, "tags")


@query("e13_unnest_objects_outer", """
SELECT doc_id, CASE WHEN doc_id % 8 <> 6 THEN text END AS name FROM documents
UNION ALL SELECT doc_id, CAST(n_chars AS VARCHAR) FROM documents WHERE doc_id % 8 = 7""")
def unnest_objects_outer(spark, sf_dir):
    parsed = reviews(spark, sf_dir).select(
        "doc_id", rs.structured(F.col("content"), an.REVIEW)["tags"].alias("tags"))
    return st.unnest_objects(parsed, "tags", keep_empty=True).select("doc_id", "name")


@query("e12_unnest_props", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def unnest_props(spark, sf_dir):
    props = js.JsonSchema("props", js.object_(k=js.integer()))
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    return st.unnest_content(events, props, "props")
