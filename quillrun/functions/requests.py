"""Request bodies and batch-file lines, one Column expression per provider shape."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillrun.functions.payload import NULL, Slot, render, text_slot
from quillrun.schema import JsonSchema, chat_format, messages_format

# Defaults and paths the providers' formats use.
EMBEDDING_MODEL = "text-embedding-3-small"
CHAT_MODEL = "gpt-4.1-nano"
CHAT_BATCH_MODEL = "gpt-4o-mini"
MESSAGES_MODEL = "claude-haiku-4-5"
EMBEDDING_PATH = "/v1/embeddings"
CHAT_PATH = "/v1/chat/completions"
ENCODING_FORMAT = "float"
EMBED_PARAMETERS = {"truncate": True}
CHAT_TEMPERATURES = (0, 2)
MESSAGES_TEMPERATURES = (0, 1)

Schema = JsonSchema | dict[str, Any] | None


def classify_parameters(max_length: int = 512) -> dict[str, Any]:
    return {"return_all_scores": True, "truncation": True, "max_length": max_length}


def safe_max_length(model_limit: int, share: float = 0.9) -> int:
    """A length limit with a margin below what the model takes."""
    return int(model_limit * share)


def _check(model: str, temperature: float, max_tokens: int, allowed: tuple[float, float],
           system_prompt: str | None) -> None:
    low, high = allowed
    if not isinstance(model, str) or not model:
        raise ValueError("model: a non-empty str is needed")
    if isinstance(temperature, bool) or not isinstance(temperature, (int, float)) \
            or not low <= temperature <= high:
        raise ValueError(f"temperature: a number from {low} to {high} is needed, got {temperature!r}")
    if not isinstance(max_tokens, (int, float)) or max_tokens <= 0:
        raise ValueError(f"max_tokens: a number above 0 is needed, got {max_tokens!r}")
    if system_prompt is not None and not isinstance(system_prompt, str):
        raise TypeError("system_prompt: a str or None is needed")


def is_valid_text(text: Column) -> Column:
    return F.coalesce(F.length(text) > 0, F.lit(False))


def _only_valid(text: Column, request: Column) -> Column:
    """No request is made from a missing or empty text."""
    return F.when(is_valid_text(text), request)


def inference_request(text: Column, parameters: Mapping[str, Any] | None = None) -> Column:
    body = {"inputs": text_slot(text), "parameters": dict(parameters) if parameters else []}
    return _only_valid(text, render(body))


def _inputs_json(texts: Column) -> Slot:
    return Slot(F.to_json(texts))


def inference_request_multi(texts: Column, parameters: Mapping[str, Any] | None = None) -> Column:
    """One request for an array of texts, answered in the same order."""
    return render({"inputs": _inputs_json(texts),
                   "parameters": dict(parameters) if parameters else []})


def _embedding_body(inputs: Slot, model: str, dimensions: int | None, keep_null: bool) -> dict:
    missing = NULL if keep_null else None
    return {"input": inputs, "model": model,
            "dimensions": missing if dimensions is None else dimensions,
            "encoding_format": ENCODING_FORMAT}


def embedding_constants(model: str = EMBEDDING_MODEL,
                        dimensions: int | None = None) -> dict[str, Any]:
    """What an embedding request holds beside its texts."""
    return {"model": model, "dimensions": dimensions, "encoding_format": ENCODING_FORMAT}


def embedding_request(text: Column, model: str = EMBEDDING_MODEL,
                      dimensions: int | None = None) -> Column:
    return _only_valid(text, render(_embedding_body(text_slot(text), model, dimensions, True)))


def embedding_request_multi(texts: Column, model: str = EMBEDDING_MODEL,
                            dimensions: int | None = None) -> Column:
    return render(_embedding_body(_inputs_json(texts), model, dimensions, True))


def _chat_messages(text: Column, system_prompt: str | None) -> list[dict]:
    user = [{"role": "user", "content": text_slot(text)}]
    if system_prompt is None:
        return user
    return [{"role": "system", "content": system_prompt}, *user]


def _chat_body(text: Column, model: str, system_prompt: str | None, temperature: float,
               max_tokens: int, schema: Schema) -> dict:
    _check(model, temperature, max_tokens, CHAT_TEMPERATURES, system_prompt)
    return {"model": model, "messages": _chat_messages(text, system_prompt),
            "temperature": temperature, "max_tokens": max_tokens,
            "response_format": chat_format(schema)}


def chat_request(text: Column, model: str = CHAT_MODEL, system_prompt: str | None = None,
                 temperature: float = 0, max_tokens: int = 500, schema: Schema = None) -> Column:
    return _only_valid(text, render(
        _chat_body(text, model, system_prompt, temperature, max_tokens, schema)))


def messages_request(text: Column, model: str = MESSAGES_MODEL, system_prompt: str | None = None,
                     temperature: float = 0, max_tokens: int = 500,
                     schema: Schema = None) -> Column:
    """The system prompt is a cacheable text block here, not a message."""
    _check(model, temperature, max_tokens, MESSAGES_TEMPERATURES, system_prompt)
    system = None if system_prompt is None else [
        {"type": "text", "text": system_prompt, "cache_control": {"type": "ephemeral"}}]
    return _only_valid(text, render({
        "model": model, "messages": _chat_messages(text, None), "max_tokens": int(max_tokens),
        "temperature": temperature, "system": system,
        "output_config": messages_format(schema)}))


def embedding_batch_line(id: Column, text: Column, model: str = EMBEDDING_MODEL,
                         dimensions: int | None = None, method: str = "POST",
                         endpoint: str = EMBEDDING_PATH) -> Column:
    return render({"custom_id": text_slot(id), "method": method, "url": endpoint,
                   "body": _embedding_body(text_slot(text), model, dimensions, False)})


def chat_batch_line(id: Column, text: Column, model: str = CHAT_BATCH_MODEL,
                    system_prompt: str | None = None, temperature: float = 0,
                    max_tokens: int = 500, schema: Schema = None, method: str = "POST",
                    endpoint: str = CHAT_PATH) -> Column:
    return render({"custom_id": text_slot(id), "method": method, "url": endpoint,
                   "body": _chat_body(text, model, system_prompt, temperature, max_tokens,
                                      schema)})


def messages_batch_entry(id: Column, text: Column, model: str = MESSAGES_MODEL,
                         system_prompt: str | None = None, temperature: float = 0,
                         max_tokens: int = 1024, schema: Schema = None) -> Column:
    """Unlike a direct request, ``system`` is a string and the cache mark sits on the params."""
    _check(model, temperature, max_tokens, MESSAGES_TEMPERATURES, system_prompt)
    return render({"custom_id": text_slot(id), "params": {
        "model": model, "max_tokens": int(max_tokens), "temperature": temperature,
        "messages": _chat_messages(text, None), "system": system_prompt,
        "cache_control": None if system_prompt is None else {"type": "ephemeral"},
        "output_config": messages_format(schema)}})
