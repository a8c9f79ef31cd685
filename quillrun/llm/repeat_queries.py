"""Queries of the operators that delete repeated passages."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrun.llm.line_dedup import dedup_lines
from quillrun.llm.registry import query, table
from quillrun.llm.suffix_dedup import remove_repeats


@query("op7_repeated_line_runs", """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line_no
  FROM documents),
counted AS (
  SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words FROM lines),
ahead AS (
  SELECT *, lead(line, 1) OVER d AS line1, lead(line, 2) OVER d AS line2, lead(words, 1) OVER d AS words1
  FROM counted WINDOW d AS (PARTITION BY doc_id ORDER BY line_no)),
runs AS (
  SELECT doc_id, line_no, 1 AS n, [line] AS run FROM ahead WHERE words >= 50
  UNION ALL SELECT doc_id, line_no, 2, [line, line1] FROM ahead WHERE line1 IS NOT NULL AND words + words1 >= 50
  UNION ALL SELECT doc_id, line_no, 3, [line, line1, line2] FROM ahead WHERE line2 IS NOT NULL),
placed AS (
  SELECT doc_id, line_no, n, row_number() OVER (PARTITION BY run ORDER BY doc_id, line_no) AS nth FROM runs),
gone AS (SELECT DISTINCT doc_id, unnest(range(line_no, line_no + n)) AS line_no FROM placed WHERE nth > 1),
marked AS (
  SELECT l.*, g.line_no IS NOT NULL AS gone,
         lag(g.line_no IS NOT NULL, 1, false) OVER (PARTITION BY l.doc_id ORDER BY l.line_no) AS gone_before
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.line_no = g.line_no)
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_lines, CAST(count(*) FILTER (gone) AS INTEGER) AS n_removed,
       CAST(count(*) FILTER (gone AND NOT gone_before) AS INTEGER) AS n_runs,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def op7_repeated_line_runs(spark, sf_dir):
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select(F.col("id").alias("doc_id"), "n_lines", "n_removed", "n_runs",
                       F.sha2("text", 256).alias("kept_sha256"))


@query("op8_repeated_strings")
def op8_repeated_strings(spark, sf_dir):
    return (remove_repeats(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
                    F.octet_length("kept").cast("long").alias("n_kept"),
                    # a cut may fall inside a character, whose rest then reads as the replacement one
                    F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text")))
