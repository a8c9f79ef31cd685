"""Runs that survive interruption, and second tries for failed rows."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrun.operators.inference import (BackendFactory, Retry, Task, infer, perform,
                                          text_rows, tidy_responses, with_request,
                                          write_run_metadata)
from quillrun.sources.runs import AS_TASKS_END, by_chunk, read_metadata


def written(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path`` if anything has been written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def pending(requests: DataFrame, done: DataFrame | None, key: str) -> DataFrame:
    """Requests without a written response."""
    return requests if done is None else requests.join(done.select(key), key, "left_anti")


def run_digest(df: DataFrame, text: str, id: str, task: Task, keep: Sequence[str],
               settings: Mapping[str, Any]) -> str:
    """What decides a run's result: its rows (number and order-free hash sum), task and settings."""
    columns = list(dict.fromkeys([id, text, *keep]))
    rows = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first()
    facts = {"rows": rows[0], "sum": str(rows[1]), "columns": columns, "task": task.name,
             "parameters": task.metadata, **settings}
    return hashlib.sha256(json.dumps(facts, sort_keys=True, default=str).encode()).hexdigest()


def run_in_chunks(df: DataFrame, text: str, id: str, task: Task, backend: BackendFactory,
                  run_dir: str, *, chunk_size: int = 5000, concurrency: int = 5,
                  retry: Retry = Retry(), on_invalid: str = "error_row",
                  keep: Sequence[str] = ()) -> DataFrame:
    """Inference that loses at most the chunks under way when it is cut off.

    The texts are written once with their chunks; the run's metadata is written after them and marks
    them complete. One job calls all chunks, a chunk to a task, and a chunk's responses are in place the
    moment its task ends: the files are the ledger of what is done. Calling again with the same
    ``run_dir`` calls the chunks that have no file; with another table, task or other settings that
    decide the result it is refused.
    """
    spark = df.sparkSession
    texts_path, responses_path = f"{run_dir}/texts", f"{run_dir}/responses"
    of_run = run_digest(df, text, id, task, keep, {"chunk_size": chunk_size, "on_invalid": on_invalid})
    known = read_metadata(spark, run_dir)
    if known is not None and known.get("run_digest") != of_run:
        raise ValueError(f"{run_dir} holds a run of another table, task or settings")
    if known is None:
        text_rows(df, text, id, chunk_size, on_invalid, keep, index="row_index") \
            .write.mode("overwrite").parquet(texts_path)
        stored = written(spark, texts_path)
        n_texts = 0 if stored is None else stored.count()
        write_run_metadata(spark, run_dir, task, n_texts, chunk_size, concurrency, retry,
                           run_digest=of_run)
    texts = written(spark, texts_path)
    if texts is None or texts.isEmpty():  # nothing to call: an empty table, or no text that may be sent
        return infer(df.limit(0), text, id, task, backend, chunk_size=chunk_size, keep=keep,
                     concurrency=concurrency, retry=retry)
    done = written(spark, responses_path)
    # a chunk is there as a whole or not at all, so few numbers tell what is left
    todo = pending(texts, None if done is None else done.select("chunk").distinct(), "chunk")
    if done is None or not todo.isEmpty():
        dealt = by_chunk(todo, texts.agg(F.max("chunk")).first()[0])
        perform(with_request(dealt, text, task, keep), backend, concurrency, retry) \
            .write.mode("append").options(**AS_TASKS_END).parquet(responses_path)
    return tidy_responses(spark.read.parquet(responses_path).drop("row_index"), task)


def latest_attempt(attempts: DataFrame, id: str, attempt: str = "attempt") -> DataFrame:
    """The last result row of each id out of a log of attempts."""
    rest = [c for c in attempts.columns if c != id]
    last = attempts.groupBy(id).agg(F.max_by(F.struct(*rest), attempt).alias("__last"))
    return last.select(id, *[F.col(f"__last.`{c}`").alias(c) for c in rest])


def retry_failed(results: DataFrame, source: DataFrame, text: str, id: str, task: Task,
                 backend: BackendFactory, key: Sequence[str] | None = None,
                 **settings) -> DataFrame:
    """Call again for the error rows with other settings; one row per row, ``attempt`` 1 or 2.

    ``results`` must be a stored table: it feeds both the kept rows and the retried ones. ``key``
    (default: the id) names columns of both tables that tell failed rows apart, such as a row number
    that ``infer`` was told to ``keep``. Failed rows that share a key are refused: which text belongs
    to which could not be told.
    """
    key = [id] if key is None else list(key)
    failed = results.where("error")
    same = F.lit(True)
    for name in key:
        same = same & source[name].eqNullSafe(F.col(f"f.{name}"))
    again = source.join(failed.select(*key).alias("f"), same, "left_semi")
    repeated = failed.select(*key, F.lit(0).alias("side")).unionAll(
        again.select(*key, F.lit(1).alias("side"))).groupBy(*key, "side").count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"{', '.join(key)}: does not tell the failed rows apart; name a key that does")
    kept = [c for c in dict.fromkeys([*key, *settings.pop("keep", ())]) if c != id]
    retried = infer(again, text, id, task, backend, chunk_size=None, keep=kept, **settings)
    if "chunk" in results.columns:
        at = F.lit(True)
        for name in key:
            at = at & retried[name].eqNullSafe(F.col(f"f.{name}"))
        retried = retried.join(failed.select(*key, "chunk").alias("f"), at).select(
            *[retried[c] for c in retried.columns], "f.chunk")
    return results.where("not error").withColumn("attempt", F.lit(1)).unionByName(
        retried.withColumn("attempt", F.lit(2)), allowMissingColumns=True)
