"""Applying a model to a text column.

The model is a *backend*: ``backend(request_json, timeout) -> (status, body)``, or with the wait
that the provider asks for as a third part. A picklable factory builds one per task. Everything around the call is declarative: requests are Catalyst
projections, responses are parsed by Catalyst projections, and only the call itself runs in
Python, in Arrow batches with a thread pool of ``concurrency`` calls in flight per task.

Spark may plan a Python map once per branch that reads it, and a model call is expensive, so
``infer`` writes the responses before anything branches off them.
"""

from __future__ import annotations

import json
import threading
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import accumulate, islice
from typing import Any, NamedTuple

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillrun.functions import requests as rq
from quillrun.functions import responses as rs
from quillrun.operators.batching import with_chunk
from quillrun.operators.exploding import computed_once, each
from quillrun.operators.tables import INVALID_TEXT, apply_invalid_policy, require_columns
from quillrun.schema import JsonSchema
from quillrun.session import fresh_dir
from quillrun.sources.runs import write_metadata

# (status, body), or with a third part: the seconds a provider asks to wait before the next try
Backend = Callable[[str, float], tuple[int, str] | tuple[int, str, float | None]]
BackendFactory = Callable[[], Backend]

RESPONSE = "struct<status:int,body:string,failure:string,tries:int>"
UNREADABLE = "Error processing response"
WRONG_COUNT = "Response does not hold one result per text"
NO_ANSWER = "No answer within the time for all tries"
ANSWERS_AT_ONCE = 256  # bodies a task holds, and rows of the batches it passes on
GRACE_SECONDS = 1.0
TOO_MANY = (429, 529)  # fixed values: what providers answer when they get too many calls

_ARROW_RESPONSE = pa.struct([("status", pa.int32()), ("body", pa.string()),
                             ("failure", pa.string()), ("tries", pa.int32())])


@dataclass(frozen=True)
class Retry:
    """Try again on a retryable status or when no response came, waiting as long as the provider asks
    (up to ``longest_wait``), or else 2, 4, 8, ... seconds."""

    max_tries: int = 5
    statuses: tuple[int, ...] = (429, 503)
    backoff: float = 2.0
    timeout: float = 30.0
    sleep: Callable[[float], None] = time.sleep
    longest_wait: float = 600.0

    def __post_init__(self) -> None:
        if self.max_tries < 1:
            raise ValueError("max_tries must be a positive integer")
        if self.timeout <= 0:
            raise ValueError(f"a call needs time to be answered, not {self.timeout} seconds")

    def wait(self, tries: int, asked: float | None) -> float:
        if asked is None or not asked >= 0:  # also where it isn't a number
            return self.backoff ** tries
        return min(float(asked), self.longest_wait)


class Throttle:
    """How many calls run at once: half as many after a provider says they are too many, and one more
    after as many good answers in a row as may run, up to ``most``. Calls that were under way when the
    limit fell don't lower it again."""

    def __init__(self, most: int, limit: int | None = None) -> None:
        self.most, self.limit = most, limit or most
        self._running, self._good, self._falls = 0, 0, 0
        self._free = threading.Condition()

    def enter(self) -> int:
        with self._free:
            self._free.wait_for(lambda: self._running < self.limit)
            self._running += 1
            return self._falls

    def leave(self, entered: int, too_many: bool, good: bool) -> None:
        with self._free:
            self._running -= 1
            if too_many and entered == self._falls:
                self.limit, self._good, self._falls = max(1, self.limit // 2), 0, self._falls + 1
            elif good:
                self._good += 1
                if self._good >= self.limit and self.limit < self.most:
                    self.limit, self._good = self.limit + 1, 0
            self._free.notify_all()


class Answer(NamedTuple):
    """What came of a request: a status and body, or what failed, and after how many tries."""

    status: int | None
    body: str | None
    failure: str | None
    tries: int


def call_with_retry(backend: Backend, request: str | None, retry: Retry,
                    throttle: Throttle | None = None, granted: list[float] | None = None) -> Answer:
    """One request to one answer. Never raises: a failure is a value. ``granted`` gets every wait that
    a provider asks for."""
    if request is None:
        return Answer(None, None, INVALID_TEXT, 0)
    throttle = throttle or Throttle(1)
    tries = 1
    while True:
        asked, status = None, None
        entered = throttle.enter()
        try:
            status, body, *more = backend(request, retry.timeout)
            asked = more[0] if more else None
            answer = Answer(int(status), body, None, tries)
        except Exception as error:  # any failure of the caller's client becomes a row
            answer = Answer(None, None, str(error) or type(error).__name__, tries)
        finally:
            throttle.leave(entered, status in TOO_MANY, status is not None and status < 400)
        if tries >= retry.max_tries or (answer.failure is None and status not in retry.statuses):
            return answer
        wait = retry.wait(tries, asked)
        if granted is not None and asked is not None:
            granted.append(wait)
        retry.sleep(wait)
        tries += 1


class Caller:
    """Answers requests in order, at most ``concurrency`` of them at a time.

    Twice as many are waiting or under way, so a slow one holds up no more than that. A client that
    ignores its timeout is given up once all tries and the waits its provider asked for could have run:
    its row is an error, and fresh threads take over.
    """

    def __init__(self, backend: Backend, concurrency: int, retry: Retry) -> None:
        self._backend, self._concurrency, self._retry = backend, concurrency, retry
        waits = sum(retry.backoff ** i for i in range(1, retry.max_tries))
        self._patience = retry.max_tries * retry.timeout + waits + GRACE_SECONDS
        self.throttle = Throttle(concurrency)
        self._pool = ThreadPoolExecutor(concurrency)

    def answers(self, requests: Iterable[str | None]) -> Iterator[Answer]:
        waiting: deque[tuple[Future, list[float]]] = deque()
        for request in requests:
            granted: list[float] = []
            waiting.append((self._pool.submit(call_with_retry, self._backend, request, self._retry,
                                              self.throttle, granted), granted))
            if len(waiting) >= 2 * self._concurrency:
                yield self._answer(*waiting.popleft())
        while waiting:
            yield self._answer(*waiting.popleft())

    def _answer(self, call: Future, granted: list[float]) -> Answer:
        waited = 0.0
        while True:
            allowed = self._patience + sum(granted)
            try:
                return call.result(timeout=allowed - waited)
            except TimeoutError:
                waited = allowed
                if self._patience + sum(granted) > allowed:
                    continue
                self._pool.shutdown(wait=False)
                self._pool = ThreadPoolExecutor(self._concurrency)
                self.throttle = Throttle(self._concurrency, self.throttle.limit)
                return Answer(None, None, NO_ANSWER, self._retry.max_tries)

    def close(self) -> None:
        self._pool.shutdown(wait=False, cancel_futures=True)


def _answer_array(answers: Sequence[Answer]) -> pa.Array:
    columns = zip(*answers) if answers else [()] * len(_ARROW_RESPONSE)
    return pa.StructArray.from_arrays(
        [pa.array(values, field.type) for values, field in zip(columns, _ARROW_RESPONSE)],
        fields=list(_ARROW_RESPONSE))


def _in_parts(answers: Iterator[Answer], count: int) -> Iterator[tuple[int, pa.Array]]:
    """Answers as arrays of at most ``ANSWERS_AT_ONCE``, each with the place of its first."""
    for start in range(0, count, ANSWERS_AT_ONCE):
        yield start, _answer_array(list(islice(answers, min(ANSWERS_AT_ONCE, count - start))))


def perform(requests: DataFrame, backend: BackendFactory, concurrency: int = 5,
            retry: Retry = Retry(), request: str = "request") -> DataFrame:
    """Call the backend for every row; the request column is replaced by its response.

    Calls in flight over the cluster are at most running tasks times ``concurrency``, so the
    number of partitions of ``requests`` (and the cores) set the cap.
    """
    if concurrency < 1:
        raise ValueError("concurrency must be a positive integer")
    carried = [c for c in requests.columns if c != request]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caller = Caller(backend(), concurrency, retry)
        try:
            for batch in batches:
                answers = caller.answers(r.as_py() for r in batch.column(request))
                for start, part in _in_parts(answers, batch.num_rows):
                    rows = batch.slice(start, len(part))
                    yield pa.RecordBatch.from_arrays(
                        [*[rows.column(c) for c in carried], part], [*carried, "response"])
        finally:
            caller.close()

    schema = T.StructType([*requests.select(*carried).schema.fields,
                           T.StructField("response", T._parse_datatype_string(RESPONSE))])
    return requests.mapInArrow(run, schema)


def perform_batched(df: DataFrame, text: str, backend: BackendFactory,
                    body: Mapping[str, Any], texts_key: str, batch_size: int = 8,
                    concurrency: int = 5, retry: Retry = Retry()) -> DataFrame:
    """Many texts per request, grouped inside each task, so without a shuffle.

    Gives one row per request: ``items`` (the carried columns of its rows, in order) and
    ``response``. ``body`` is the constant part of the request, ``texts_key`` where the list of
    texts goes. Rows without text form requests of their own that are never sent.
    """
    if batch_size < 1 or concurrency < 1:
        raise ValueError("batch_size and concurrency must be positive integers")
    carried = [c for c in df.columns if c != text]

    def request_of(texts: pa.Array, group: list[int]) -> str | None:
        sent = [texts[i].as_py() for i in group]
        return json.dumps({texts_key: sent, **body}, ensure_ascii=False,
                          separators=(",", ":")) if sent[0] else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caller = Caller(backend(), concurrency, retry)
        try:
            for batch in batches:
                texts = batch.column(text)
                sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
                full = [i for i, n in enumerate(sizes) if n]
                groups = [full[i:i + batch_size] for i in range(0, len(full), batch_size)]
                groups += [[i] for i, n in enumerate(sizes) if not n]
                answers = caller.answers(request_of(texts, g) for g in groups)
                for start, part in _in_parts(answers, len(groups)):
                    own = groups[start:start + len(part)]
                    rows = pa.StructArray.from_arrays(
                        [batch.column(c) for c in carried], carried).take(
                        pa.array([i for g in own for i in g], pa.int64()))
                    offsets = list(accumulate((len(g) for g in own), initial=0))
                    items = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)
                    yield pa.RecordBatch.from_arrays([items, part], ["items", "response"])
        finally:
            caller.close()

    row = T.StructType(df.select(*carried).schema.fields)
    schema = T.StructType([T.StructField("items", T.ArrayType(row)),
                           T.StructField("response", T._parse_datatype_string(RESPONSE))])
    return df.mapInArrow(run, schema)


@dataclass(frozen=True)
class Task:
    """How a text becomes a request and a response body becomes a result.

    ``tidy`` maps the body Column to the result Column; where ``required``, a NULL result of a
    successful response is an error row.
    """

    name: str
    result: str
    result_type: str
    build: Callable[[Column], Column]
    tidy: Callable[[Column], Column]
    required: bool = True
    missing: str = UNREADABLE
    metadata: Mapping[str, Any] = field(default_factory=dict)


def embed_task(parameters: Mapping[str, Any] | None = None,
               tidy: Callable[[Column], Column] = rs.embedding_vector) -> Task:
    sent = dict(rq.EMBED_PARAMETERS if parameters is None else parameters)
    return Task("embed", "embedding", "array<double>",
                lambda text: rq.inference_request(text, sent), tidy,
                metadata={"inference_parameters": sent})


def indexed_embed_task(model: str = rq.EMBEDDING_MODEL, dimensions: int | None = None) -> Task:
    return Task("embed", "embedding", "array<double>",
                lambda text: rq.embedding_request(text, model, dimensions), rs.indexed_embedding,
                metadata={"model": model, "dimensions": dimensions})


def classify_task(max_length: int = 512,
                  tidy: Callable[[Column], Column] = rs.classification_scores) -> Task:
    sent = rq.classify_parameters(max_length)
    return Task("classify", "scores", "map<string,double>",
                lambda text: rq.inference_request(text, sent), tidy,
                metadata={"inference_parameters": sent})


def _schema_text(schema: JsonSchema | dict | None) -> str | None:
    raw = schema.chat_format() if isinstance(schema, JsonSchema) else schema
    return None if raw is None else json.dumps(raw, ensure_ascii=False)


def chat_task(model: str = rq.CHAT_MODEL, system_prompt: str | None = None, temperature: float = 0,
              max_tokens: int = 500, schema: JsonSchema | dict | None = None) -> Task:
    return Task("complete", "content", "string",
                lambda text: rq.chat_request(text, model, system_prompt, temperature, max_tokens,
                                             schema),
                rs.completion_content, missing="No content found in response",
                metadata={"model": model, "system_prompt": system_prompt,
                          "temperature": temperature, "max_tokens": max_tokens,
                          "schema": _schema_text(schema)})


def messages_task(model: str = rq.MESSAGES_MODEL, system_prompt: str | None = None,
                  temperature: float = 0, max_tokens: int = 1024,
                  schema: JsonSchema | dict | None = None) -> Task:
    """An answer without a text block is a success with NULL content."""
    return Task("complete", "content", "string",
                lambda text: rq.messages_request(text, model, system_prompt, temperature,
                                                 max_tokens, schema),
                rs.message_content, required=False,
                metadata={"model": model, "system_prompt": system_prompt,
                          "temperature": temperature, "max_tokens": max_tokens,
                          "schema": _schema_text(schema)})


def error_columns(response: Column, unreadable: Column, missing: str = UNREADABLE) -> list[Column]:
    """(error, error_msg, status) of a response; all but ``error`` are NULL on success."""
    status = response["status"]
    failed = status.isNull() | (status >= 400)
    message = F.when(failed, rs.api_error(status, response["body"], response["failure"],
                                          "Request failed")).when(unreadable, F.lit(missing))
    return [F.coalesce(failed | unreadable, F.lit(True)).alias("error"),
            message.alias("error_msg"),
            F.when(status >= 400, status).cast("int").alias("status")]


def tidy_responses(responses: DataFrame, task: Task) -> DataFrame:
    """Response rows to result rows: carried columns, the result, error, error_msg, status."""
    response = F.col("response")
    failed = response["status"].isNull() | (response["status"] >= 400)
    result = F.when(~failed, task.tidy(response["body"]).cast(task.result_type))
    if task.required:  # whether a row failed depends on its result, so filters will ask for it
        parsed = computed_once(responses, "__result", result)
        unreadable = ~failed & F.col("__result").isNull()
    else:
        parsed, unreadable = responses.withColumn("__result", result), F.lit(False)
    carried = [c for c in responses.columns if c not in ("response", "chunk")]
    return parsed.select(
        *carried, F.col("__result").alias(task.result),
        *error_columns(response, unreadable, task.missing),
        *(["chunk"] if "chunk" in responses.columns else []))


def tidy_batched(responses: DataFrame, result: str, many: Callable[[Column], Column]) -> DataFrame:
    """Scatter the results of many-text requests back to one row per text, by place.

    ``many`` maps a body to an array with one result per text. A response with another number
    of results fails all rows of its request.
    """
    response = F.col("response")
    failed = response["status"].isNull() | (response["status"] >= 400)
    parsed = computed_once(responses, "__results", F.when(~failed, many(response["body"])))
    wrong = ~failed & (F.coalesce(F.size("__results"), F.lit(-1)) != F.size("items"))
    # what a row needs of its request, made before the rows are: no body is copied onto them
    usable = ~wrong & F.col("__results").isNotNull()
    values = F.when(usable, F.col("__results")).otherwise(F.transform("items", lambda x: F.lit(None)))
    error, message, status = error_columns(response, wrong, WRONG_COUNT)
    requests = parsed.select(
        error.alias("__failed"), message.alias("__message"), status.alias("__status"),
        F.arrays_zip(F.col("items").alias("item"), values.alias("value"))
        .alias("__rows"))
    rows = each(requests, "__rows", ["__failed", "__message", "__status"], "__row", "__at")
    lost = ~F.col("__failed") & F.col("__row.value").isNull()
    return rows.select(
        "__row.item.*", F.col("__row.value").alias(result),
        (F.col("__failed") | lost).alias("error"),
        F.when(lost, F.lit(WRONG_COUNT)).otherwise(F.col("__message")).alias("error_msg"),
        F.col("__status").alias("status"))


def text_rows(df: DataFrame, text: str, id: str, chunk_size: int | None = None,
              on_invalid: str = "error_row", keep: Sequence[str] = (),
              index: str | None = None) -> DataFrame:
    """id, text, kept columns, and with a chunk size the chunk (and position ``index``)."""
    require_columns(df, id, text, *keep)
    rows = apply_invalid_policy(df.select(*dict.fromkeys([id, text, *keep])), text, on_invalid,
                                id)
    # in stored order, which moves no text; a table that isn't read from files is ordered by id
    return rows if chunk_size is None else with_chunk(rows, chunk_size, None, index=index,
                                                      fallback=id)


def with_request(rows: DataFrame, text: str, task: Task, keep: Sequence[str] = ()) -> DataFrame:
    """The text column turned into the request; kept as well if ``keep`` names it."""
    carried = [c for c in rows.columns if c != text or c in keep]
    return rows.select(*carried, task.build(F.col(text)).alias("request"))


def request_table(df: DataFrame, text: str, id: str, task: Task, chunk_size: int | None = None,
                  on_invalid: str = "error_row", keep: Sequence[str] = ()) -> DataFrame:
    """id, kept columns, chunk and request of each row.

    The id is a column of the request's row, so nothing has to be matched up afterwards.
    """
    return with_request(text_rows(df, text, id, chunk_size, on_invalid, keep), text, task, keep)


def write_run_metadata(spark: SparkSession, run_dir: str, task: Task, n_texts: int,
                       chunk_size: int | None, concurrency: int, retry: Retry, **more: Any) -> None:
    write_metadata(spark, run_dir, {
        **task.metadata, **more, "n_texts": n_texts, "chunk_size": chunk_size,
        "n_chunks": None if chunk_size is None else -(-n_texts // chunk_size),
        "concurrent_requests": concurrency, "max_retries": retry.max_tries,
        "timeout": retry.timeout})


def infer(df: DataFrame, text: str, id: str, task: Task, backend: BackendFactory, *,
          chunk_size: int | None = 5000, concurrency: int = 5, retry: Retry = Retry(),
          on_invalid: str = "error_row", keep: Sequence[str] = (),
          partitions: int | None = None, run_dir: str | None = None) -> DataFrame:
    """One model call per text; one result row per text.

    Responses are written to ``run_dir`` (default: a new folder below the shared one) and read
    back, so the result can be filtered, joined and counted freely without calling again. A given
    ``run_dir`` also gets the run's metadata. ``chunk_size=None`` leaves chunk numbers out. They follow
    the stored order and cost no shuffle, unless rows don't come from files. ``partitions`` times ``concurrency`` bounds the calls in flight.
    """
    spark = df.sparkSession
    rows = text_rows(df, text, id, chunk_size, on_invalid, keep)
    if partitions is not None:  # texts are moved, not the larger requests
        rows = rows.repartition(partitions)
    requests = with_request(rows, text, task, keep)
    folder = (run_dir or fresh_dir(spark, task.name)).rstrip("/")
    perform(requests, backend, concurrency, retry).write.parquet(f"{folder}/responses")
    responses = spark.read.parquet(f"{folder}/responses")
    if run_dir is not None:
        write_run_metadata(spark, folder, task, responses.count(), chunk_size, concurrency, retry)
    return tidy_responses(responses, task)


def infer_batched(df: DataFrame, text: str, id: str, backend: BackendFactory, *, result: str,
                  many: Callable[[Column], Column], body: Mapping[str, Any] | None = None,
                  texts_key: str = "inputs", batch_size: int = 8, concurrency: int = 5,
                  retry: Retry = Retry(), include_texts: bool = False,
                  on_invalid: str = "error_row", keep: Sequence[str] = (),
                  partitions: int | None = None, run_dir: str | None = None) -> DataFrame:
    """As ``infer`` with many texts per request; ``include_texts`` keeps the text column. A given
    ``run_dir`` also gets the run's metadata."""
    sent = {"parameters": []} if body is None else dict(body)
    spark = df.sparkSession
    rows = text_rows(df, text, id, None, on_invalid, keep)
    if partitions is not None:
        rows = rows.repartition(partitions)
    carried = include_texts or text in keep
    if carried:
        rows = rows.withColumn("__sent", F.col(text))
    folder = (run_dir or fresh_dir(spark, "batched")).rstrip("/")
    perform_batched(rows, "__sent" if carried else text, backend, sent, texts_key,
                    batch_size, concurrency, retry).write.parquet(f"{folder}/responses")
    results = tidy_batched(spark.read.parquet(f"{folder}/responses"), result, many)
    if run_dir is not None:
        write_metadata(spark, folder, {
            "inference_parameters": sent, "model": sent.get("model"), "dimensions": sent.get("dimensions"),
            "batch_size": batch_size, "n_texts": results.count(), "concurrent_requests": concurrency,
            "max_retries": retry.max_tries, "timeout": retry.timeout})
    return results
