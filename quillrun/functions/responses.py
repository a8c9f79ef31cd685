"""Reading response bodies and batch result lines with Column expressions.

Nothing here raises on bad input: an unreadable body gives NULL, and the callers turn a NULL
into an error row.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillrun.schema import JsonSchema, Node, spark_type

UNKNOWN_ERROR = "Unknown error"
INVALID_RESPONSE = "Invalid response object"
NO_EMBEDDING = "No embedding found in response"
PARSE_ERROR_ID = "__PARSE_ERROR_LINE_"
PARSE_ERROR_MSG = "Failed to parse JSONL line "

_SCORES = "array<struct<label string,score double>>"


def _at(value: Column, path: str, type: str = "string") -> Column:
    return F.try_variant_get(value, path, type)


def _present(value: Column) -> Column:
    """Neither absent nor an explicit JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def _is_string(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def parse_json(text: Column) -> Column:
    """VARIANT of a JSON text, NULL when it is no JSON."""
    return F.try_parse_json(text)


# --- errors ---------------------------------------------------------------------------------

def _body_message(body: Column) -> Column:
    parsed = parse_json(body)
    error = _at(parsed, "$.error", "variant")
    return F.coalesce(
        F.when(_is_string(error), _at(parsed, "$.error")),
        _at(parsed, "$.error.message"),
        _at(parsed, "$.message"),
    )


def api_error(status: Column, body: Column, failure: Column | None = None,
              fallback: str = UNKNOWN_ERROR) -> Column:
    """Error message of a response; NULL for a success.

    ``failure`` is what went wrong where no response came at all.
    """
    from_response = F.when(
        status >= 400,
        F.coalesce(_body_message(body), F.concat(F.lit("HTTP "), status.cast("string"))))
    no_response = F.lit(fallback) if failure is None else F.coalesce(failure, F.lit(fallback))
    return F.when(status.isNull(), no_response).otherwise(from_response)


def response_fields(status: Column, body: Column) -> Column:
    """(status, content, error_msg) of one completion response."""
    return F.struct(
        status.cast("int").alias("status"),
        F.when(status == 200, completion_content(body)).alias("content"),
        F.when(status.isNull(), F.lit(INVALID_RESPONSE))
        .when(status != 200, api_error(status, body)).alias("error_msg"),
    )


# --- bodies ---------------------------------------------------------------------------------

def _whole(vector: Column) -> Column:
    """Has numbers, and no gap among them."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull()), F.lit(False))


def _one_vector(vector: Column) -> Column:
    return F.when(vector.isNotNull(), F.array(vector))


def embedding_vectors(body: Column) -> Column:
    """All vectors of an embedding body: nested lists, ``{"embedding": [...]}`` or one flat list.

    NULL if there is none, or if one is missing, empty or lacks a number.
    """
    found = F.coalesce(
        F.from_json(body, "array<array<double>>"),
        _one_vector(F.from_json(body, "embedding array<double>")["embedding"]),
        _one_vector(F.from_json(body, "array<double>")),
    )
    return F.get(F.filter(F.array(found), lambda vectors: (F.size(vectors) > 0)
                          & F.forall(vectors, _whole)), F.lit(0))


def embedding_vector(body: Column) -> Column:
    """The one vector of a single-text embedding body, NULL if there is none."""
    return F.get(embedding_vectors(body), F.lit(0))


_INDEXED = "array<struct<index int,embedding array<double>>>"


def _all_embedded(items: Column) -> Column:
    return F.when((F.size(items) > 0) & F.forall(items, lambda x: _whole(x["embedding"])), items)


def indexed_embeddings(body: Column) -> Column:
    """``data[]`` of an embeddings body (or the bare list) as (index, embedding) structs."""
    return F.coalesce(_all_embedded(F.from_json(body, f"data {_INDEXED}")["data"]),
                      _all_embedded(F.from_json(body, _INDEXED)))


def indexed_embedding(body: Column) -> Column:
    return F.get(indexed_embeddings(body), F.lit(0))["embedding"]


def indexed_embedding_list(body: Column) -> Column:
    """The vectors of an embeddings body in the order of its texts."""
    ordered = F.array_sort(indexed_embeddings(body))
    return F.transform(ordered, lambda item: item["embedding"])


def _scores_map(entries: Column) -> Column:
    """label -> score; NULL when a label is missing or given twice."""
    labels = F.transform(entries, lambda e: e["label"])
    usable = (F.size(entries) > 0) & ~F.exists(labels, lambda x: x.isNull()) \
        & (F.size(F.array_distinct(labels)) == F.size(labels))
    return F.when(usable, F.map_from_entries(entries))


def classification_scores(body: Column) -> Column:
    """Scores of one text, from ``[[{label,score},...]]`` or ``[{label,score},...]``."""
    entries = F.coalesce(F.flatten(F.from_json(body, f"array<{_SCORES}>")),
                         F.from_json(body, _SCORES))
    return _scores_map(entries)


def classification_scores_multi(body: Column) -> Column:
    """One scores map per item of a many-text body, in order."""
    return F.transform(F.from_json(body, f"array<{_SCORES}>"), _scores_map)


def completion_content(body: Column) -> Column:
    return _at(parse_json(body), "$.choices[0].message.content")


def first_text_block(blocks: Column) -> Column:
    """Text of the first block of type ``text`` in an array of VARIANT blocks."""
    texts = F.filter(blocks, lambda b: _at(b, "$.type") == "text")
    return _at(F.get(texts, F.lit(0)), "$.text")


def message_content(body: Column) -> Column:
    return first_text_block(_at(parse_json(body), "$.content", "array<variant>"))


def token_usage(body: Column) -> Column:
    """Token counts of a response, under either provider's names."""
    parsed = parse_json(body)
    given_in = F.coalesce(_at(parsed, "$.usage.input_tokens", "bigint"),
                          _at(parsed, "$.usage.prompt_tokens", "bigint"))
    given_out = F.coalesce(_at(parsed, "$.usage.output_tokens", "bigint"),
                           _at(parsed, "$.usage.completion_tokens", "bigint"))
    return F.struct(
        given_in.alias("input_tokens"), given_out.alias("output_tokens"),
        F.coalesce(_at(parsed, "$.usage.total_tokens", "bigint"),
                   given_in + given_out).alias("total_tokens"))


# --- batch result lines ---------------------------------------------------------------------

def _line_id(parsed: Column, line_no: Column) -> Column:
    return F.when(parsed.isNull(), F.concat(F.lit(PARSE_ERROR_ID), line_no.cast("string"))) \
        .otherwise(_at(parsed, "$.custom_id"))


def _parse_error(line_no: Column) -> Column:
    return F.concat(F.lit(PARSE_ERROR_MSG), line_no.cast("string"))


def _line_error(parsed: Column, line_no: Column, strict: bool) -> Column:
    """Message of a failed line, NULL for a good one.

    ``strict`` also fails a line whose inner response has an HTTP error status.
    """
    error = _at(parsed, "$.error", "variant")
    message = F.coalesce(_at(parsed, "$.error.message"),
                         F.when(_is_string(error), _at(parsed, "$.error")),
                         F.lit(UNKNOWN_ERROR))
    ladder = F.when(parsed.isNull(), _parse_error(line_no)).when(_present(error), message)
    if strict:
        status = _at(parsed, "$.response.status_code", "int")
        ladder = ladder.when(status >= 400, F.coalesce(
            _at(parsed, "$.response.body.error.message"),
            F.concat(F.lit("HTTP "), status.cast("string"))))
    return ladder


def embedding_line(parsed: Column, line_no: Column, strict: bool = False) -> Column:
    """(custom_id, embedding, error_msg) of one parsed embeddings result line."""
    vector = _at(parsed, "$.response.body.data[0].embedding", "array<double>")
    failed = _line_error(parsed, line_no, strict)
    return F.struct(
        _line_id(parsed, line_no).alias("custom_id"),
        F.when(failed.isNull(), vector).alias("embedding"),
        F.coalesce(failed, F.when(vector.isNull(), F.lit(NO_EMBEDDING))).alias("error_msg"))


def completion_line(parsed: Column, line_no: Column, strict: bool = False) -> Column:
    """A line without content is no error: its content is NULL."""
    content = _at(parsed, "$.response.body.choices[0].message.content")
    failed = _line_error(parsed, line_no, strict)
    return F.struct(
        _line_id(parsed, line_no).alias("custom_id"),
        F.when(failed.isNull(), content).alias("content"),
        failed.alias("error_msg"))


def message_line(parsed: Column, line_no: Column) -> Column:
    """One line of a message batch: succeeded, errored, or a type that names its own failure."""
    kind = _at(parsed, "$.result.type")
    good = kind == "succeeded"
    failed = (
        F.when(parsed.isNull(), _parse_error(line_no))
        .when(kind == "errored", F.coalesce(_at(parsed, "$.result.error.message"),
                                            F.lit(UNKNOWN_ERROR)))
        .when(kind.isNull(), F.lit(UNKNOWN_ERROR))
        .when(~good, kind))
    message = "$.result.message"
    content = first_text_block(_at(parsed, f"{message}.content", "array<variant>"))
    return F.struct(
        _line_id(parsed, line_no).alias("custom_id"),
        F.when(good, content).alias("content"),
        failed.alias("error_msg"),
        F.when(good, _at(parsed, f"{message}.stop_reason")).alias("stop_reason"),
        F.when(good, _at(parsed, f"{message}.usage.input_tokens", "bigint")).alias("input_tokens"),
        F.when(good, _at(parsed, f"{message}.usage.output_tokens", "bigint"))
        .alias("output_tokens"))


# --- structured content ---------------------------------------------------------------------

def structured(content: Column, schema: JsonSchema | Node) -> Column:
    """JSON content read into the schema's Spark type; bad JSON gives NULL."""
    node = schema.schema if isinstance(schema, JsonSchema) else schema
    return F.from_json(content, spark_type(node))


def widen(vector: Column, size: int, prefix: str = "V") -> list[Column]:
    """One column per dimension; all NULL when the vector is missing or of another length."""
    fits = F.size(vector) == size
    return [F.when(fits, F.get(vector, F.lit(i))).alias(f"{prefix}{i + 1}") for i in range(size)]


def label_columns(scores: Column, labels: Sequence[str]) -> list[Column]:
    """One column per known label; a label the response lacks is NULL."""
    return [F.try_element_at(scores, F.lit(label)).alias(label) for label in labels]


def rename_labels(scores: Column, names: dict[str, str]) -> Column:
    """Scores under readable label names (``LABEL_0`` to ``negative``); others keep theirs."""
    if not names:
        return scores
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.transform_keys(scores, lambda k, _: F.coalesce(F.try_element_at(lookup, k), k))


def http_date(text: Column) -> Column:
    """Date of an HTTP date header such as ``Mon, 06 Jan 2025 10:00:00 GMT``."""
    day = F.regexp_extract(
        text, r"^[A-Za-z]{3}, (\d{1,2} [A-Za-z]{3} \d{4}) \d{1,2}:\d{2}:\d{2}", 1)
    return F.try_to_date(day, "d MMM yyyy")


_STATUS = ("id string, processing_status string, status string, request_counts struct<"
           "processing bigint, succeeded bigint, errored bigint, canceled bigint, "
           "expired bigint, total bigint, completed bigint, failed bigint>, "
           "created_at string, ended_at string, results_url string")


def batch_status(body: Column) -> Column:
    """Status object of a provider batch, under either provider's names."""
    read = F.from_json(body, _STATUS)
    counts = read["request_counts"]
    state = F.coalesce(read["processing_status"], read["status"])
    return F.struct(
        read["id"].alias("batch_id"), state.alias("status"),
        state.isin("ended", "completed", "failed", "expired", "cancelled").alias("ended"),
        counts["processing"].alias("processing"),
        F.coalesce(counts["succeeded"], counts["completed"]).alias("succeeded"),
        F.coalesce(counts["errored"], counts["failed"]).alias("errored"),
        counts["canceled"].alias("canceled"), counts["expired"].alias("expired"),
        read["created_at"].alias("created_at"), read["ended_at"].alias("ended_at"),
        read["results_url"].alias("results_url"))


def extract_field(text: Column, field: str) -> Column:
    """Every value under ``field`` at any depth, outermost first, as JSON texts.

    JSON of unknown depth has no column expression, so this is an Arrow-batched helper.
    """
    @F.pandas_udf("array<string>")
    def collect(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def walk(body) -> list:
            found, waiting = [], [body]
            while waiting:  # as deep as the JSON goes, which a recursion might not reach
                value = waiting.pop()
                if isinstance(value, dict):
                    if field in value:
                        found.append(value[field])
                    value = list(value.values())
                if isinstance(value, list):
                    waiting.extend(reversed(value))
            return found

        def values(body):
            try:
                found = walk(json.loads(body))
            except (TypeError, ValueError, RecursionError):  # unreadable, or nested beyond the reader
                return None
            return [json.dumps(v, ensure_ascii=False, separators=(",", ":"))
                    for v in found if v is not None and v != [] and v != {}]

        for batch in batches:
            yield batch.map(values, na_action="ignore")

    return collect(text)
