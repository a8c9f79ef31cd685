"""A table of texts to provider batch files, with the providers' rules applied."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun.functions import requests as rq
from quillrun.operators.batching import (BATCH_FILE_BYTES, CHAT_BATCH_ROWS, MESSAGES_BATCH_ROWS,
                                         with_batches)
from quillrun.operators.ids import enforce_ids, notice_size
from quillrun.operators.tables import require_columns

ROW_CAPS = {"embeddings": CHAT_BATCH_ROWS, "completions": CHAT_BATCH_ROWS,
            "messages": MESSAGES_BATCH_ROWS}


def batch_line(kind: str, id: Column, text: Column, **settings: Any) -> Column:
    """One line of a batch file: an embeddings, completions or messages request."""
    build = {"embeddings": rq.embedding_batch_line, "completions": rq.chat_batch_line,
             "messages": rq.messages_batch_entry}
    if kind not in build:
        raise ValueError(f"kind must be one of {', '.join(build)}")
    return build[kind](id, text, **settings)


def prepare_batches(df: DataFrame, text: str, id: str, kind: str, *, max_rows: int | None = None,
                    max_bytes: int = BATCH_FILE_BYTES, check_ids: bool = True,
                    **settings: Any) -> DataFrame:
    """(id, line, batch): request lines in batches that keep the provider's caps.

    Ids must be unique, and well formed for messages; the schema in ``settings`` is serialised
    once. Batches follow the stored order, or that of the id for rows that don't come from files.
    More than 10,000 requests give a `LargeRun` warning; an empty table gives an empty one. Write the result with ``sources.jsonl.write_batches``.
    """
    require_columns(df, id, text)
    rows = df.select(id, text)
    if check_ids:
        enforce_ids(rows, id, messages_rules=kind == "messages")
    notice_size(rows.count())
    line = batch_line(kind, F.col(id), F.col(text), **settings)
    placed = with_batches(rows, line, None, max_rows or ROW_CAPS[kind], max_bytes, fallback=id)
    return placed.select(id, line.alias("line"), "batch")
