"""Provider batch result lines to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrun.functions import responses as rs
from quillrun.operators.exploding import computed_once
from quillrun.session import materialise
from quillrun.sources.jsonl import line_numbers, read_lines

KINDS = ("embeddings", "completions", "messages")


def _line(kind: str, parsed: Column, line_no: Column, strict: bool) -> Column:
    if kind == "embeddings":
        return rs.embedding_line(parsed, line_no, strict)
    if kind == "completions":
        return rs.completion_line(parsed, line_no, strict)
    if kind == "messages":
        return rs.message_line(parsed, line_no)
    raise ValueError(f"kind must be one of {', '.join(KINDS)}")


def with_json(lines: DataFrame) -> DataFrame:
    """Lines with their parsed form, NULL when unreadable."""
    return computed_once(lines, "__json", rs.parse_json(F.col("line")))


def parse_lines(lines: DataFrame, kind: str, id: str = "custom_id", strict: bool = False,
                keep: Sequence[str] = ()) -> DataFrame:
    """Rows of a (line, line_no) table. No lines give no rows, with the same columns.

    ``id`` renames ``custom_id`` to the caller's id column.
    """
    parsed = lines if "__json" in lines.columns else with_json(lines)
    read = parsed.select(*keep, _line(kind, F.col("__json"), F.col("line_no"), strict).alias("__r"))
    return _columns(read, kind, id, keep)


def _columns(read: DataFrame, kind: str, id: str, keep: Sequence[str]) -> DataFrame:
    value = "embedding" if kind == "embeddings" else "content"
    usage = ["stop_reason", "input_tokens", "output_tokens"] if kind == "messages" else []
    return read.select(
        *keep, F.col("__r.custom_id").alias(id), f"__r.{value}",
        F.col("__r.error_msg").isNotNull().alias("error"), "__r.error_msg",
        *[f"__r.{c}" for c in usage])


def parse_placed_lines(lines: DataFrame, kind: str, id: str = "custom_id", strict: bool = False,
                       keep: Sequence[str] = ()) -> DataFrame:
    """Rows of lines read from files: each line is read and parsed once, and its row stored.

    Only unreadable lines need, and get, a line number, from the places of the stored rows.
    """
    place = ["file", "split", "row"]
    rest = [c for c in keep if c not in place]
    nowhere = F.lit(None).cast("int")
    read = with_json(lines).select(
        *place, *rest, F.col("__json").isNull().alias("__bad"),
        _line(kind, F.col("__json"), nowhere, strict).alias("__r"))
    stored = materialise(read, "parsed")
    bad = line_numbers(stored, F.col("__bad"), rest).withColumn("__json", F.lit(None).cast("variant"))
    failed = bad.select("file", *rest, _line(kind, F.col("__json"), F.col("line_no"), strict).alias("__r"))
    return _columns(stored.where("NOT __bad").select("file", *rest, "__r").unionByName(failed),
                    kind, id, keep)


def parse_files(spark: SparkSession, path: str | list[str], kind: str, id: str = "custom_id",
                strict: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of one or many result files or folders. ``keep=("file",)`` keeps the file name."""
    return parse_placed_lines(read_lines(spark, path), kind, id, strict, keep)


def status_table(statuses: DataFrame, body: str, keep: Sequence[str] = ()) -> DataFrame:
    """Status objects to one progress row each."""
    return statuses.select(*keep, rs.batch_status(F.col(body)).alias("__s")) \
        .select(*keep, "__s.*")


def job_progress(progress: DataFrame, job: str) -> DataFrame:
    """Per job: batches, counts, and whether every batch has ended."""
    counts = ["processing", "succeeded", "errored", "canceled", "expired"]
    return progress.groupBy(job).agg(
        F.count(F.lit(1)).alias("batches"),
        F.bool_and(F.coalesce("ended", F.lit(False))).alias("all_ended"),
        *[F.sum(F.coalesce(c, F.lit(0))).cast("bigint").alias(c) for c in counts])
