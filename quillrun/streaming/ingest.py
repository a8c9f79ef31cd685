"""Result files and input tables that keep arriving.

A micro-batch costs what it holds and not what has been written before: a stream reads each file
once, and where ids may only count once they are remembered in its own state. Each micro-batch
writes its own folder, replacing it if the batch runs again after a failure.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrun.functions.responses import parse_json
from quillrun.operators.inference import BackendFactory, Retry, Task, perform, request_table, \
    tidy_responses
from quillrun.operators.resume import written
from quillrun.operators.results import parse_lines
from quillrun.sources.jsonl import line_numbers, read_lines

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE_PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    """Session settings a query takes over when it starts, put back afterwards."""
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _run(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
         trigger: dict | None, state_partitions: int | None) -> None:
    # ids to be remembered live in RocksDB and not on the heap
    settings = {_STATE_STORE: _ROCKSDB}
    if state_partitions is not None:
        settings[_STATE_PARTITIONS] = str(state_partitions)
    with _settings(stream.sparkSession, settings):
        query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint) \
            .trigger(**(trigger or {"availableNow": True})).start()
        query.awaitTermination()


def _write_epoch(rows: DataFrame, target: str, epoch: int) -> None:
    rows.write.mode("overwrite").parquet(f"{target}/epoch={epoch}")


def _read_epochs(spark: SparkSession, target: str) -> DataFrame | None:
    rows = written(spark, target)
    return None if rows is None else rows.drop("epoch")


def ingest_results(spark: SparkSession, source: str, kind: str, target: str, checkpoint: str,
                   id: str = "custom_id", files_per_batch: int = 1000,
                   trigger: dict | None = None) -> DataFrame:
    """Parse provider result files as they land in ``source`` and append their rows to ``target``.

    The same rows as a batch read of all files gives, with the ``file`` they came from: batches may
    use the same ids, and an error and a later success of one id are both kept
    (``resume.latest_attempt`` picks). The stream reads every file once, so it keeps no ids. Lines
    without a readable id are reported by file and line number, for which only the files that hold
    some are read again.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(source) \
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")) \
        .where(F.length("line") > 0).withColumn("line_no", F.lit(None).cast("int"))
    rows = parse_lines(lines, kind, "__id", keep=("file",))

    def handle(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            good = batch.where("__id is not null").withColumnRenamed("__id", id)
            # at most files_per_batch names
            damaged = [r["file"] for r in batch.where("__id is null").select("file").distinct()
                       .collect()]
            if damaged:
                again = read_lines(batch.sparkSession, damaged)
                without_id = F.try_variant_get(parse_json(F.col("line")), "$.custom_id", "string")
                bad = line_numbers(again, without_id.isNull())
                good = good.unionByName(parse_lines(bad, kind, id, keep=("file",)))
            _write_epoch(good, target, epoch)
        finally:
            batch.unpersist()

    _run(rows, handle, checkpoint, trigger, None)
    results = _read_epochs(spark, target)
    if results is None:
        nothing = spark.createDataFrame([], "file string, line_no int, line string")
        return parse_lines(nothing, kind, id, keep=("file",))
    return results


def infer_arrivals(spark: SparkSession, source: str, schema, text: str, id: str, task: Task,
                   backend: BackendFactory, target: str, checkpoint: str, *,
                   concurrency: int = 5, retry: Retry = Retry(), on_invalid: str = "error_row",
                   keep: Sequence[str] = (), files_per_batch: int = 1000,
                   trigger: dict | None = None, once_per_id: bool = False,
                   remember: str | None = "30 days",
                   state_partitions: int | None = None) -> DataFrame:
    """Call the model for the rows of parquet files arriving in ``source``, one result per row.

    ``once_per_id`` leaves out rows whose id an earlier row has had, in any file; rows without an id
    are never each other's repeats. An id is remembered for the time ``remember`` after its row was read,
    by the clock of the stream, so that no file is ever too old to be read; then its state is dropped and
    the id counts as new. None: for as long as the checkpoint lives. State is spread over
    ``state_partitions`` (fixed by the first run); without ``once_per_id`` the stream keeps nothing.
    """
    def responses(rows: DataFrame) -> DataFrame:
        requests = request_table(rows, text, id, task, on_invalid=on_invalid, keep=keep)
        return perform(requests, backend, concurrency, retry)

    arrivals = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch) \
        .parquet(source)
    if once_per_id:
        place = F.concat_ws(":", F.lit("row"), "_metadata.file_path", "_metadata.row_index")
        known = F.concat(F.lit("id:"), F.col(id).cast("string"))
        arrivals = arrivals.select("*", F.coalesce(known, place).alias("__key"))
        if remember is None:
            arrivals = arrivals.dropDuplicates(["__key"])
        else:
            arrivals = arrivals.withColumn("__read", F.current_timestamp()).withWatermark("__read", remember) \
                .dropDuplicatesWithinWatermark(["__key"]).drop("__read")
        arrivals = arrivals.drop("__key")
    _run(arrivals, lambda batch, epoch: _write_epoch(responses(batch), target, epoch),
         checkpoint, trigger, state_partitions)
    found = _read_epochs(spark, target)
    if found is None:
        found = responses(spark.createDataFrame([], schema))
    return tidy_responses(found, task)
