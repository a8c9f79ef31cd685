"""JSONL text: lines out of strings and files, batch files out of lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillrun.functions.text import lines as lines_of_text
from quillrun.operators.exploding import each


def split_lines(df: DataFrame, body: str, keep: Sequence[str] = ()) -> DataFrame:
    """The non-empty lines of a string column, numbered from 1."""
    return each(df, lines_of_text(F.col(body)), keep, "line", "__at") \
        .select(*keep, (F.col("__at") + 1).alias("line_no"), "line")


def file_lines(files: DataFrame) -> DataFrame:
    """Non-empty lines with the place they were read from: file, split, row.

    Files are read in splits, so a file of any size spreads over tasks. ``row`` grows within a
    split; see ``line_numbers`` for numbers within the file.
    """
    placed = files.select(F.col("_metadata.file_path").alias("file"),
                          F.col("_metadata.file_block_start").alias("split"),
                          F.col("value").alias("line"))
    return placed.where(F.length("line") > 0).withColumn("row", F.monotonically_increasing_id())


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return file_lines(spark.read.text(path))


def line_numbers(lines: DataFrame, wanted: Column | None = None,
                 keep: Sequence[str] = ("line",)) -> DataFrame:
    """Number lines from 1 within their file, optionally only the ``wanted`` ones.

    Lines per split are counted first (one row per split), so only the wanted lines are
    shuffled. With a ``wanted`` that picks the unreadable lines this moves next to nothing.
    """
    splits = lines.groupBy("file", "split").agg(
        F.min("row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = splits.select("file", "split", "__first",
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__earlier"))
    chosen = lines if wanted is None else lines.where(wanted)
    number = F.col("__earlier") + F.col("row") - F.col("__first") + 1
    return chosen.join(starts, ["file", "split"]).select(
        "file", number.cast("int").alias("line_no"), *keep)


def write_batches(df: DataFrame, line: str, path: str, batch: str = "batch",
                  order_by: str | Sequence[str] | None = None, single_file: bool = True) -> None:
    """JSONL files below ``path``, one folder per batch.

    With ``single_file`` the lines of a batch meet in one task, in ``order_by`` order; a batch is
    capped by rows and bytes, so that is bounded work. Without it nothing is shuffled: a batch
    that spans tasks is several files, to be sent one after the other.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by or [])
    rows = df.select(batch, *[F.col(c) for c in order if c != batch], F.col(line).alias("value"))
    if single_file:
        rows = rows.repartition(batch)
        if order:
            rows = rows.sortWithinPartitions(batch, *order)
    rows.select(batch, "value").write.partitionBy(batch).text(path)
