"""Run folders: chunk files, job metadata, and where they go."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrun.session import fresh_dir

# What a run's metadata records.
METADATA = ("run_id string, output_dir string, endpoint_url string, model string, schema string, "
            "system_prompt string, temperature double, max_tokens int, dimensions int, "
            "inference_parameters string, chunk_size int, n_chunks int, n_texts bigint, "
            "concurrent_requests int, timeout double, max_retries int, key_name string, "
            "rows_processed bigint, elapsed_time double, timestamp string")
STAMP = "%d%m%Y_%H%M%S"
FOLDER = "chunk_folder"
CHUNKS_PER_FOLDER = 200
MAX_TASKS = 100_000  # of a job that writes chunks
# a task's file is moved into its place when the task is done, not when the job is
AS_TASKS_END = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def output_dir(spark: SparkSession, given: str | None = None,
               base: str = "batch_processing", now: datetime | None = None) -> str:
    """``None``: a new shared folder; ``"auto"``: base, time and a run id; else as given."""
    if given is None:
        return fresh_dir(spark, base)
    if given == "auto":
        stamp = (now or datetime.now(timezone.utc)).strftime(STAMP)
        return f"{base}_{stamp}_{uuid.uuid4().hex[:8]}"
    return given


def output_file(spark: SparkSession, given: str | None = None,
                base: str = "batch_processing", now: datetime | None = None) -> str:
    """The same rule for a single CSV file."""
    if given is None or given == "auto":
        return output_dir(spark, given, base, now) + ".csv"
    if not given.lower().endswith(".csv"):
        raise ValueError("output_file must have a .csv extension")
    return given


def by_chunk(rows: DataFrame, n_chunks: int, chunk: str = "chunk") -> DataFrame:
    """Rows dealt out so that a task holds one chunk, or a few consecutive ones of very many."""
    each = -(-n_chunks // MAX_TASKS)
    task = F.floor((F.col(chunk) - 1) / F.lit(max(1, each))).cast("int")
    return rows.repartitionById(max(1, -(-n_chunks // max(1, each))), task)


def write_chunks(results: DataFrame, path: str, mode: str = "errorifexists",
                 single_file: bool = True, chunks_per_folder: int = CHUNKS_PER_FOLDER) -> None:
    """Results as parquet, in folders of ``chunks_per_folder`` consecutive chunks.

    With ``single_file`` a task writes the file of one chunk and puts it in its place as it ends, so
    chunks can be read while others are still being made, and a task that runs again replaces its own
    file. ``results`` is then read for its last chunk too. Without it nothing is shuffled.
    """
    number = F.floor((F.col("chunk") - 1) / F.lit(chunks_per_folder)).cast("int")
    rows = results.withColumn(FOLDER, number)
    if single_file:
        rows = by_chunk(rows, results.agg(F.max("chunk")).first()[0] or 1).sortWithinPartitions(FOLDER, "chunk")
    rows.write.mode(mode).options(**AS_TASKS_END).partitionBy(FOLDER).parquet(path)


def read_chunks(spark: SparkSession, path: str, first: int | None = None, last: int | None = None,
                chunks_per_folder: int = CHUNKS_PER_FOLDER) -> DataFrame:
    """The chunks of a run, or those from ``first`` to ``last``, as one lazy table. Only folders that
    may hold them are listed, and only the row groups that do are read."""
    rows = spark.read.parquet(path)
    if first is not None:
        folder = (first - 1) // chunks_per_folder
        rows = rows.where((F.col("chunk") >= first) & (F.col(FOLDER) >= folder))
    if last is not None:
        folder = (last - 1) // chunks_per_folder
        rows = rows.where((F.col("chunk") <= last) & (F.col(FOLDER) <= folder))
    return rows.drop(FOLDER)


def write_metadata(spark: SparkSession, run_dir: str, values: Mapping[str, Any]) -> None:
    """One JSON row with the settings of a run."""
    stamped = {"timestamp": datetime.now(timezone.utc).isoformat(), "output_dir": run_dir,
               **{k: v if v is None or isinstance(v, (str, int, float, bool))
                  else json.dumps(v, ensure_ascii=False) for k, v in values.items()}}
    line = json.dumps(stamped, ensure_ascii=False)
    spark.createDataFrame([(line,)], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{run_dir}/metadata")


def read_metadata(spark: SparkSession, run_dir: str) -> dict[str, Any] | None:
    """The settings a run has written, or None if it hasn't yet."""
    try:
        row = spark.read.text(f"{run_dir}/metadata").first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if row is None else json.loads(row[0])


def run_log(spark: SparkSession, *run_dirs: str) -> DataFrame:
    """The metadata of many runs as one table."""
    return spark.read.schema(METADATA).json([f"{d}/metadata" for d in run_dirs])
