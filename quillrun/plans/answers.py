"""A deterministic stand-in for a provider.

Answers depend only on the row, so SQL over the base tables can say what reading them must give.
The Column forms answer whole tables without Python. The backends answer one request at a time,
as a network client would, with planted errors. Failures are planted by remainders of the id (or
the text length); no row is left out.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun import schema as js
from quillrun.functions.payload import NULL, Slot, json_value, render, text_slot
from quillrun.operators.inference import Retry


def no_wait(_seconds: float) -> None:
    """Backoff against a stand-in, which never needs time to recover."""


FAST_RETRY = Retry(max_tries=3, sleep=no_wait)


def number(value: Column) -> Slot:
    return Slot(json_value(value))


def words(prefix: str, column: str) -> Slot:
    return text_slot(F.concat(F.lit(prefix), F.col(column)))


# --- structured content -----------------------------------------------------------------------

REVIEW = js.JsonSchema(
    "review",
    js.object_(
        lang=js.enum(["de", "en", "es", "fr"], "language of the text"),
        n_chars=js.integer("length of the text", minimum=1),
        grade=js.number("1 to 5", minimum=1, maximum=5),
        tags=js.array(js.object_(name=js.string(), weight=js.number(minimum=0, maximum=1),
                                 required=["name", "weight"]), min_items=1, max_items=3),
        required=["lang", "n_chars", "grade"],
    ),
    description="Review of one document",
)


def review_content() -> Column:
    """A review of a document as JSON; only remainder 0 keeps to the schema in full."""
    kind, n_chars = F.col("doc_id") % 8, F.col("n_chars")
    tag = {"name": text_slot(F.col("text")), "weight": 0.5}

    def review(**changes) -> Column:
        return render({"lang": text_slot(F.col("lang")), "n_chars": number(n_chars),
                       "grade": number(n_chars % 5 + 1), "tags": [tag], **changes})

    return (
        F.when(kind == 1, review(grade=number(n_chars % 5 + 6)))
        .when(kind == 2, review(lang="xx"))
        .when(kind == 3, review(n_chars=None))
        .when(kind == 4, review(extra=True))
        .when(kind == 5, review(grade="five"))
        .when(kind == 6, F.concat(F.lit("no json: "), "text"))
        .when(kind == 7, review(tags=[tag, {"name": number(n_chars), "weight": 2}]))
        .otherwise(review()))


def with_review(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "lang", "source", "n_chars",
                            review_content().alias("content"))


# --- answers to chat requests -------------------------------------------------------------------

def chat_body(content: Column) -> Column:
    n_chars = F.col("n_chars")
    return render({
        "choices": [{"index": 0, "message": {"role": "assistant", "content": text_slot(content)},
                     "finish_reason": "stop"}],
        "usage": {"prompt_tokens": number(n_chars), "completion_tokens": 7,
                  "total_tokens": number(n_chars + 7)}})


def chat_answers(documents: DataFrame) -> DataFrame:
    """Documents with (status, body, failure) of the answer to a request about each."""
    kind = F.col("doc_id") % 10
    body = (
        F.when(kind == 3, render({"error": {"message": words("Rate limit for ", "lang"),
                                            "type": "rate"}}))
        .when(kind == 5, render({"error": words("Model is loading ", "lang")}))
        .when(kind == 6, F.lit("<html>bad gateway</html>"))
        .when(kind == 7, render({"message": words("Overloaded ", "lang")}))
        .when(kind == 9, F.lit('{"choices":[]}'))
        .when(kind != 8, chat_body(F.concat_ws(" ", "text", "lang"))))
    status = F.when(kind == 3, 429).when(kind == 5, 500).when(kind == 6, 502) \
        .when(kind == 7, 529).when(kind != 8, 200)
    failure = F.when(kind == 8, F.concat(F.lit("Connection timed out: "), "source"))
    return documents.withColumns({"status": status.cast("int"), "body": body, "failure": failure})


CHAT_STATUS_SQL = """CASE doc_id % 10 WHEN 3 THEN 429 WHEN 5 THEN 500 WHEN 6 THEN 502
  WHEN 7 THEN 529 WHEN 8 THEN NULL ELSE 200 END"""
CHAT_ERROR_SQL = """CASE doc_id % 10 WHEN 3 THEN 'Rate limit for ' || lang
  WHEN 5 THEN 'Model is loading ' || lang WHEN 6 THEN 'HTTP 502'
  WHEN 7 THEN 'Overloaded ' || lang WHEN 8 THEN 'Connection timed out: ' || source END"""


# --- offline batch result lines -----------------------------------------------------------------

def chat_lines(documents: DataFrame, content: Column) -> DataFrame:
    """(doc_id, line_no, line): one chat result line per document."""
    kind, id = F.col("doc_id") % 10, text_slot(F.col("doc_id"))
    line = (
        F.when(kind == 3, render({"custom_id": id, "error": {"message": words("Refused ", "lang")}}))
        .when(kind == 5, render({"custom_id": id, "error": {"code": "x"}}))
        .when(kind == 6, F.concat(F.lit('{"custom_id": broken '), "lang"))
        .when(kind == 7, render({"custom_id": id, "error": NULL, "response": {
            "status_code": 400, "body": {"error": {"message": words("Bad request ", "lang")}}}}))
        .otherwise(render({"custom_id": id, "error": NULL, "response": {
            "status_code": 200, "body": Slot(chat_body(content))}})))
    return documents.select("doc_id", (F.col("doc_id") + 1).cast("int").alias("line_no"),
                            line.alias("line"))


CHAT_LINE_ERROR_SQL = """CASE doc_id % 10 WHEN 3 THEN 'Refused ' || lang
  WHEN 5 THEN 'Unknown error' WHEN 6 THEN 'Failed to parse JSONL line ' || (doc_id + 1) END"""
LINE_ID_SQL = """CASE WHEN doc_id % 10 = 6 THEN '__PARSE_ERROR_LINE_' || (doc_id + 1)
  ELSE CAST(doc_id AS VARCHAR) END"""


def embedding_lines(embeddings: DataFrame) -> DataFrame:
    """(vec_id, line_no, line): one embeddings result line per vector."""
    kind, id = F.col("vec_id") % 10, text_slot(F.col("vec_id"))
    vector = Slot(F.to_json(F.col("embedding").cast("array<double>")))
    line = (
        F.when(kind == 3, render({"custom_id": id, "error": {"message": "Too many tokens"}}))
        .when(kind == 5, render({"custom_id": id, "error": "plain text"}))
        .when(kind == 6, F.lit("[not json"))
        .when(kind == 7, render({"custom_id": id, "response": {"body": {"data": []}}}))
        .otherwise(render({"custom_id": id, "error": NULL, "response": {
            "status_code": 200, "body": {"data": [{"index": 0, "embedding": vector}]}}})))
    return embeddings.select("vec_id", (F.col("vec_id") + 1).cast("int").alias("line_no"),
                             line.alias("line"))


def message_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, line_no, line): one message batch result line per document."""
    kind, id = F.col("doc_id") % 10, text_slot(F.col("doc_id"))

    def answer(stop: str, *blocks) -> dict:
        return {"custom_id": id, "result": {"type": "succeeded", "message": {
            "role": "assistant", "content": list(blocks), "stop_reason": stop,
            "usage": {"input_tokens": number(F.col("n_chars")),
                      "output_tokens": number(F.col("doc_id") % 100)}}}}

    text = {"type": "text", "text": text_slot(F.concat_ws(" ", "text", "lang"))}
    tool = {"type": "tool_use", "name": "lookup"}
    line = (
        F.when(kind == 1, render(answer("tool_use", tool, text, {"type": "text", "text": "later"})))
        .when(kind == 2, render(answer("max_tokens")))
        .when(kind == 3, render({"custom_id": id, "result": {
            "type": "errored", "error": {"type": "invalid", "message": words("Invalid ", "lang")}}}))
        .when(kind == 4, render({"custom_id": id, "result": {"type": "errored"}}))
        .when(kind == 5, render({"custom_id": id, "result": {"type": "canceled"}}))
        .when(kind == 6, F.lit('{"custom_id": '))
        .when(kind == 7, render({"custom_id": id, "result": {"type": "expired"}}))
        .otherwise(render(answer("end_turn", text))))
    return documents.select("doc_id", (F.col("doc_id") + 1).cast("int").alias("line_no"),
                            line.alias("line"))


# --- backends: one request in, (status, body) out -----------------------------------------------

class _Planted:
    """Plants failures by the length of the text.

    Some answers come on the second try. Tries are counted per thread until one succeeds, as all
    tries of a call run in one thread; so equal texts do not count for each other.
    """

    def __init__(self) -> None:
        self._thread = threading.local()

    def _tries(self, request: str, done: bool) -> int:
        before, count = getattr(self._thread, "last", (None, 0))
        count = count + 1 if before == request else 1
        self._thread.last = (None, 0) if done else (request, count)
        return count

    def __call__(self, request: str, timeout: float) -> tuple[int, str]:
        text = self.text_of(json.loads(request))
        kind = (len(text) if isinstance(text, str) else 0) % 17
        if kind == 5:
            return 429, '{"error":{"message":"Too many requests"}}'
        if kind == 6:
            return 500, '{"error":"Internal failure"}'
        if kind == 7:
            raise ConnectionError("connection reset by peer")
        if kind == 8:
            if self._tries(request, done=False) == 1:
                return 503, '{"message":"Overloaded"}'
            self._tries(request, done=True)
        if kind == 9:
            return 200, '{"unexpected":true}'
        return 200, json.dumps(self.answer(text), ensure_ascii=False)

    def text_of(self, body: dict):
        return body["inputs"]

    def answer(self, text):
        raise NotImplementedError


def vector_of(text: str) -> list[float]:
    return [float(len(text)), float(text.count("a")), float(text.count(" "))]


def score_of(text: str) -> float:
    return len(text) % 64 / 64


class EmbedBackend(_Planted):
    def answer(self, text):
        return [vector_of(text)]


class EmbedManyBackend(_Planted):
    """Many texts per request; never fails."""

    def answer(self, texts):
        return [vector_of(t) for t in texts]


class IndexedEmbedBackend(_Planted):
    def text_of(self, body):
        return body["input"]

    def answer(self, text):
        return {"data": [{"object": "embedding", "index": 0, "embedding": vector_of(text)}]}


class IndexedEmbedManyBackend(IndexedEmbedBackend):
    """Many texts per request, answered in reverse order under their index."""

    def answer(self, texts):
        data = [{"index": i, "embedding": vector_of(t)} for i, t in enumerate(texts)]
        return {"data": data[::-1]}


class ClassifyBackend(_Planted):
    def answer(self, text):
        return [[{"label": "LABEL_1", "score": score_of(text)},
                 {"label": "LABEL_0", "score": 1 - score_of(text)}]]


class ClassifyManyBackend(_Planted):
    def answer(self, texts):
        return [[{"label": "LABEL_1", "score": score_of(t)},
                 {"label": "LABEL_0", "score": 1 - score_of(t)}] for t in texts]


class ChatBackend(_Planted):
    def text_of(self, body):
        return body["messages"][-1]["content"]

    def answer(self, text):
        return {"choices": [{"index": 0, "message": {
            "role": "assistant", "content": f"{len(text)} characters"}}]}


class MessagesBackend(ChatBackend):
    def answer(self, text):
        return {"content": [{"type": "thinking", "thinking": "..."},
                            {"type": "text", "text": f"{len(text)} characters"}],
                "stop_reason": "end_turn"}


class PatientBackend(EmbedBackend):
    """Answers what ``EmbedBackend`` refuses: the second attempt with other settings."""

    def __call__(self, request, timeout):
        return 200, json.dumps([vector_of(json.loads(request)["inputs"])])


# What the backends answer, in SQL over a ``text`` column.
TEXT_STATUS_SQL = "CASE length(text) % 17 WHEN 5 THEN 429 WHEN 6 THEN 500 END"
TEXT_ERROR_SQL = """CASE length(text) % 17 WHEN 5 THEN 'Too many requests'
  WHEN 6 THEN 'Internal failure' WHEN 7 THEN 'connection reset by peer' WHEN 9 THEN '{missing}' END"""
TEXT_OK_SQL = "length(text) % 17 NOT IN (5, 6, 7, 9)"
COUNT_A_SQL = "length(text) - length(replace(text, 'a', ''))"
COUNT_SPACE_SQL = "length(text) - length(replace(text, ' ', ''))"
