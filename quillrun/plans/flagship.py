"""One job end to end: batch files, answers, parse, validate, unnest, join back, report."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrun.operators import joining, reports, results
from quillrun.operators import structured as st
from quillrun.operators.prepare import prepare_batches
from quillrun.plans import answers as an
from quillrun.plans.registry import query, table
from quillrun.session import fresh_dir
from quillrun.sources import jsonl


@query("flagship_structured_batch", """
WITH reviewed AS (
  SELECT lang, n_chars, doc_id % 10 NOT IN (3, 5, 6) AS answered,
    doc_id % 10 NOT IN (3, 5, 6, 7) AND doc_id % 8 = 0 AS valid, n_chars % 5 + 1 AS grade
  FROM documents)
SELECT lang, count(*) AS total, count(*) FILTER (answered) AS succeeded,
  count(*) FILTER (NOT answered) AS failed,
  round(100.0 * count(*) FILTER (answered) / count(*), 1) AS succeeded_pct,
  round(100.0 * count(*) FILTER (NOT answered) / count(*), 1) AS failed_pct,
  count(*) FILTER (valid) AS valid, round(avg(CASE WHEN valid THEN grade END), 6) AS mean_grade,
  CAST(sum(CASE WHEN valid THEN n_chars END) AS BIGINT) AS reviewed_chars
FROM reviewed GROUP BY lang""")
def structured_batch(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    folder = fresh_dir(spark, "flagship")

    # request lines, in files under the provider's caps
    lines = prepare_batches(documents, "text", "doc_id", "completions",
                            system_prompt="Review the document.", schema=an.REVIEW)
    jsonl.write_batches(lines, "line", f"{folder}/requests", single_file=False)

    # what the provider would send back for the requests in those files, landed as files
    sent = spark.read.text(f"{folder}/requests").select(
        F.get_json_object("value", "$.custom_id").cast("bigint").alias("doc_id"),
        F.get_json_object("value", "$.body.messages[1].content").alias("text")) \
        .withColumn("n_chars", F.length("text").cast("bigint"))
    asked = sent.join(documents.select("doc_id", "lang", "source"), "doc_id")
    an.chat_lines(asked, an.review_content()).select("line").write.text(f"{folder}/answers")

    # answers to rows, checked against the schema and joined to their documents
    parsed = results.parse_files(spark, f"{folder}/answers", "completions")
    checked = st.parse_content(parsed, an.REVIEW).select(
        "custom_id", "error", "valid", "parsed.grade", F.col("parsed.n_chars").alias("chars"))
    joined = joining.attach_results(documents.select("doc_id", "lang"), checked, "doc_id") \
        .withColumn("error", F.coalesce("error", F.lit(True)))
    return reports.job_summary(
        joined, ["lang"],
        F.count_if(F.coalesce("valid", F.lit(False))).alias("valid"),
        F.round(F.avg("grade"), 6).alias("mean_grade"),
        F.sum("chars").alias("reviewed_chars"))
