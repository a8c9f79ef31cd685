"""Queries of the operators that run on DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrun.llm.chat_format import rotate_perspectives
from quillrun.llm.exact_dedup import exact_groups
from quillrun.llm.hilbert_shards import by_name, by_size, hilbert_shards
from quillrun.llm.registry import query, table

SHARDS = 40


@query("op1_perspective_rotation", """
WITH base AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text,
         CAST(floor(turn / 64.0) AS BIGINT) AS part
  FROM conversations),
cast_ AS (SELECT DISTINCT conv_id, speaker AS assistant FROM base WHERE speaker <> 'system'),
marked AS (
  SELECT b.*, c.assistant,
         CASE WHEN b.speaker = c.assistant THEN '<|im_start|>assistant' || chr(10)
              WHEN b.speaker = 'system' THEN '<|im_start|>system' || chr(10)
              ELSE '<|im_start|>user name=' || b.speaker || chr(10) END AS mark,
         b.text || '<|im_end|>' || chr(10) AS body
  FROM base b JOIN cast_ c ON b.conv_id IS NOT DISTINCT FROM c.conv_id),
placed AS (
  SELECT *, sum(length(mark) + length(body)) OVER (
              PARTITION BY conv_id, assistant, part ORDER BY turn NULLS FIRST, speaker, md5(text)
              ROWS UNBOUNDED PRECEDING) AS ends
  FROM marked)
SELECT conv_id, assistant, part, '' AS piece, CAST(0 AS BIGINT) AS run, CAST(count(*) AS INTEGER) AS n_turns,
       string_agg(mark || body, '' ORDER BY turn NULLS FIRST, speaker, md5(text)) AS rendered,
       coalesce(string_agg(CASE WHEN speaker = assistant
                     THEN CAST(ends - length(body) AS BIGINT) || ':' || CAST(ends AS BIGINT) END,
                  ',' ORDER BY turn NULLS FIRST, speaker, md5(text)), '') AS spans
FROM placed GROUP BY conv_id, assistant, part
""")
def op1_perspective_rotation(spark, sf_dir):
    parts = rotate_perspectives(table(spark, sf_dir, "conversations"))
    return parts.withColumnRenamed("dialogue", "conv_id").withColumn("spans", F.expr(
        "array_join(transform(spans, s -> concat(s.from_char, ':', s.to_char)), ',')"))


@query("op9_bloom_exact_dedup", """
WITH base AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(translate(coalesce(text, ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ', ''))
           AS text_sha256
  FROM documents),
placed AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id
  FROM base)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM placed
""")
def op9_bloom_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op10_hilbert_shards")
def op10_hilbert_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    dims = {"source": by_name("source"), "lang": by_name("lang"),
            "length": by_size(F.octet_length("text"))}
    return hilbert_shards(docs, SHARDS, dims).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve_index")
