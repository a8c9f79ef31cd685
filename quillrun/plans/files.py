"""Queries: sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrun.functions import requests as rq
from quillrun.operators.batching import BATCH_FILE_BYTES, CHAT_BATCH_ROWS, with_chunk
from quillrun.operators.prepare import prepare_batches
from quillrun.operators.tables import from_vectors, scan_text
from quillrun.plans.batches import batch_number_sql
from quillrun.plans.registry import query, table
from quillrun.session import fresh_dir
from quillrun.sources import jsonl, runs


@query("a1_scan_text", "SELECT page_id, html FROM pages")
def scan(spark, sf_dir):
    return scan_text(table(spark, sf_dir, "pages"), "html", "page_id")


@query("a3_chunk_files", """
SELECT event_id, event_type, value,
       CAST(ceil(row_number() OVER (ORDER BY event_id) / 5000.0) AS INTEGER) AS chunk
FROM events""")
def chunk_files(spark, sf_dir):
    path = fresh_dir(spark, "chunks")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    runs.write_chunks(with_chunk(events, 5000), path)
    return runs.read_chunks(spark, path)


@query("a4_read_chunks", """
SELECT CAST(ceil(position / 2500.0) AS INTEGER) AS chunk, count(*) AS n,
  min(event_id) AS first_id, max(event_id) AS last_id
FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS position FROM events)
GROUP BY 1""")
def read_chunks(spark, sf_dir):
    path = fresh_dir(spark, "chunks")
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    runs.write_chunks(with_chunk(events, 2500, ["ts", "event_id"]), path)
    return runs.read_chunks(spark, path).groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"))


def _run_sql(table: str) -> str:
    return f"""
SELECT '{table}' AS source, CAST(NULL AS VARCHAR) AS run_id, true AS in_its_folder,
  'https://models.example/{table}' AS endpoint_url,
  'text-embedding-3-small' AS model, CAST(NULL AS VARCHAR) AS schema, CAST(NULL AS VARCHAR) AS system_prompt,
  CAST(0.5 AS DOUBLE) AS temperature, 64 AS max_tokens, 3 AS dimensions,
  '{{"truncate": true}}' AS inference_parameters, 500 AS chunk_size,
  CAST(ceil(count(*) / 500.0) AS INTEGER) AS n_chunks, count(*) AS n_texts, 4 AS concurrent_requests,
  CAST(20 AS DOUBLE) AS timeout, 2 AS max_retries, 'KEY' AS key_name, count(*) AS rows_processed,
  CAST(1.5 AS DOUBLE) AS elapsed_time, true AS stamped FROM {table}"""


@query("a5_run_log", " UNION ALL ".join(_run_sql(t) for t in ("documents", "pages")))
def run_log(spark, sf_dir):
    """Every field of what runs over two tables record, read back as one table."""
    folders = {}
    for name in ("documents", "pages"):
        folder = folders[name] = fresh_dir(spark, f"run-{name}")
        rows = table(spark, sf_dir, name)
        runs.write_chunks(with_chunk(rows, 500), f"{folder}/chunks")
        done = runs.read_chunks(spark, f"{folder}/chunks").agg(F.count(F.lit(1)), F.max("chunk")).first()
        runs.write_metadata(spark, folder, {
            "endpoint_url": f"https://models.example/{name}", "model": rq.EMBEDDING_MODEL, "temperature": 0.5,
            "max_tokens": 64, "dimensions": 3, "inference_parameters": rq.EMBED_PARAMETERS, "chunk_size": 500,
            "n_chunks": done[1], "n_texts": rows.count(), "concurrent_requests": 4, "timeout": 20.0,
            "max_retries": 2, "key_name": "KEY", "rows_processed": done[0], "elapsed_time": 1.5})
    source = F.regexp_extract("output_dir", "run-([a-z]+)-", 1)
    log = runs.run_log(spark, *folders.values())
    rest = [c for c in log.columns if c not in ("output_dir", "timestamp")]
    return log.select(source.alias("source"), F.col("output_dir").isin(*folders.values()).alias("in_its_folder"),
                      *rest, F.to_timestamp("timestamp").isNotNull().alias("stamped"))


@query("a2_lists_held_by_the_caller", """
SELECT item_id AS id, text, length(text) AS n_chars FROM benchmark
UNION ALL SELECT -1 - s_suppkey, s_name, length(s_name) FROM supplier""")
def lists_held_by_the_caller(spark, sf_dir):
    """Texts and ids that the caller holds as lists, here of two of the smaller tables."""
    items = table(spark, sf_dir, "benchmark").select("item_id", "text").collect()
    names = table(spark, sf_dir, "supplier").select((-1 - F.col("s_suppkey")).alias("item_id"),
                                                    F.col("s_name").alias("text")).collect()
    held = [*items, *names]
    made = from_vectors(spark, [r["text"] for r in held], [r["item_id"] for r in held])
    return made.withColumn("n_chars", F.length("text").cast("bigint"))


@query("a6_output_paths", """
SELECT doc_id, n_chars, rule FROM documents, (SELECT unnest(['none', 'auto', 'given']) AS rule)""")
def output_paths(spark, sf_dir):
    """A CSV file by each rule for its place: a new shared folder, a stamped name, a given one."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    base = fresh_dir(spark, "outputs")
    places = {"none": runs.output_file(spark), "auto": runs.output_file(spark, "auto", f"{base}/run"),
              "given": runs.output_file(spark, f"{base}/given.CSV")}
    found = None
    for rule, place in places.items():
        documents.write.option("header", True).csv(place)
        rows = spark.read.schema("doc_id bigint, n_chars bigint").option("header", True).csv(place) \
            .withColumn("rule", F.lit(rule))
        found = rows if found is None else found.unionByName(rows)
    return found


LINE_SQL = """'{"custom_id":"' || doc_id || '","method":"POST","url":"/v1/embeddings","body":{"input":'
  || to_json(text) || ',"model":"text-embedding-3-small","encoding_format":"float"}}'"""


@query("a7_jsonl_files", f"""
SELECT CAST(batch AS INTEGER) AS batch, line
FROM ({batch_number_sql('strlen(line) + 1', BATCH_FILE_BYTES, CHAT_BATCH_ROWS,
                        f'(SELECT doc_id, {LINE_SQL} AS line FROM documents)')})""")
def jsonl_files(spark, sf_dir):
    path = fresh_dir(spark, "jsonl")
    lines = prepare_batches(table(spark, sf_dir, "documents"), "text", "doc_id", "embeddings")
    jsonl.write_batches(lines, "line", path, order_by="doc_id")
    return spark.read.text(path).select(F.col("batch").cast("int"), F.col("value").alias("line"))


@query("a8_jsonl_lines", """
WITH split AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS parts FROM documents)
SELECT doc_id, CAST(unnest(generate_series(1, len(parts))) AS INTEGER) AS line_no,
       unnest(parts) AS line FROM split""")
def jsonl_lines(spark, sf_dir):
    return jsonl.split_lines(table(spark, sf_dir, "documents"), "text", ["doc_id"])


@query("a8_file_line_numbers", """
WITH placed AS (
  SELECT l_orderkey, l_linenumber,
         row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS position FROM lineitem)
SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
       CAST((position - 1) // 25000 + 1 AS INTEGER) AS batch,
       CAST((position - 1) % 25000 + 1 AS INTEGER) AS line_no FROM placed""")
def file_line_numbers(spark, sf_dir):
    key = ["l_orderkey", "l_linenumber"]
    items = table(spark, sf_dir, "lineitem").select(*key, F.to_json(F.struct(*key)).alias("line"))
    path = fresh_dir(spark, "numbered")
    jsonl.write_batches(with_chunk(items, 25_000, key, chunk="batch"), "line", path, order_by=key)
    numbered = jsonl.line_numbers(jsonl.read_lines(spark, path))
    return numbered.select(
        F.from_json("line", "l_orderkey bigint, l_linenumber int").alias("key"),
        F.regexp_extract("file", r"batch=(\d+)", 1).cast("int").alias("batch"), "line_no") \
        .select("key.*", "batch", "line_no")
