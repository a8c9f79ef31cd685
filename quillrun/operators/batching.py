"""Chunks, provider batches and multi-text requests."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun.operators.filling import filled, with_batch
from quillrun.operators.positions import (ROWS_PER_BUCKET, arrangement, stored_totals, with_position,
                                          with_stored_position)
from quillrun.session import materialise

# What the providers accept in one batch.
CHAT_BATCH_ROWS = 50_000
MESSAGES_BATCH_ROWS = 100_000
BATCH_FILE_BYTES = 200_000_000

OrderBy = str | Sequence[str] | None


def _positive(name: str, value: int) -> None:
    if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
        raise ValueError(f"{name} must be a positive integer")


def piece_number(position: Column, size: int) -> Column:
    """1-based number of the ``size``-row piece a 1-based position falls in."""
    return F.floor((position - 1) / F.lit(size)) + 1


def settled(df: DataFrame, order_by: OrderBy, fallback: OrderBy) -> tuple[DataFrame, OrderBy]:
    """The rows and the columns that they are numbered by, None for the order they are stored in.

    Without ``order_by`` a plain read of files keeps its stored order, however many files it has, and a
    table that was sorted keeps that order: it is written once, which fixes it. Rows in no such order go
    by ``fallback``, and are refused without one.
    """
    if order_by is not None:
        return df, order_by
    how = arrangement(df)
    if how == "sorted":
        return materialise(df, "sorted"), None
    if how == "other":
        if fallback is None:
            raise ValueError("these rows have no stored order: name the columns to order by")
        return df, fallback
    return df, None


def _placed(df: DataFrame, order_by: OrderBy, position: str, fallback: OrderBy,
            rows_per_bucket: int) -> DataFrame:
    df, order_by = settled(df, order_by, fallback)
    if order_by is None:
        return with_stored_position(df, position)
    return with_position(df, order_by, position, rows_per_bucket=rows_per_bucket)


def with_chunk(df: DataFrame, chunk_size: int, order_by: OrderBy = None, chunk: str = "chunk",
               index: str | None = None, rows_per_bucket: int = ROWS_PER_BUCKET,
               fallback: OrderBy = None) -> DataFrame:
    """Number rows into consecutive chunks of at most ``chunk_size``; ``index`` keeps the position.

    Without ``order_by`` rows are numbered as they are stored, which moves nothing, or as they were
    sorted; see `settled`.
    """
    _positive("chunk_size", chunk_size)
    kept = index or "__position"
    placed = _placed(df, order_by, kept, fallback, rows_per_bucket).withColumn(
        chunk, piece_number(F.col(kept), chunk_size).cast("int"))
    return placed if index else placed.drop(kept)


def with_row_batches(df: DataFrame, order_by: OrderBy = None, max_rows: int = CHAT_BATCH_ROWS,
                     batch: str = "batch", on_excess: str = "split",
                     rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Provider batches of at most ``max_rows``. ``on_excess='fail'`` refuses to split."""
    _positive("max_rows", max_rows)
    if on_excess not in ("split", "fail"):
        raise ValueError("on_excess must be 'split' or 'fail'")
    if on_excess == "fail":
        n = df.count()
        if n > max_rows:
            raise ValueError(f"a batch takes at most {max_rows} requests, got {n}; "
                             "split the data into multiple batches")
    placed = _placed(df, order_by, "__position", None, rows_per_bucket)
    return placed.withColumn(batch, piece_number(F.col("__position"), max_rows).cast("bigint")) \
        .drop("__position")


def with_batches(df: DataFrame, line: str | Column, order_by: OrderBy = None,
                 max_rows: int | None = None, max_bytes: int = BATCH_FILE_BYTES,
                 batch: str = "batch", rows_per_bucket: int = ROWS_PER_BUCKET,
                 fallback: OrderBy = None) -> DataFrame:
    """Provider batches whose files hold at most ``max_bytes`` (and ``max_rows``).

    ``line`` may be an expression over ``df``: then only its length is used here and the line
    itself is best built afterwards, so that a shuffle moves texts and not whole requests.

    Batches are filled in order: a row starts a new one only if it doesn't fit the one before. A line
    that is longer than ``max_bytes`` by itself is refused.
    """
    _positive("max_bytes", max_bytes)
    if max_rows is not None:
        _positive("max_rows", max_rows)
    size = F.octet_length(F.col(line) if isinstance(line, str) else line) + 1
    refuse = F.raise_error(F.concat(F.lit("a line of "), size.cast("string"),
                                    F.lit(f" bytes does not fit a {max_bytes}-byte batch file")))
    checked = F.coalesce(F.when(size > max_bytes, refuse.cast("int")).otherwise(size), F.lit(1))
    df, order_by = settled(df, order_by, fallback)
    if order_by is None:
        totals = stored_totals(df, checked)
        placed = with_stored_position(df, "__position")
    else:  # written, since rows with equal keys may come in another order each time
        placed = materialise(with_position(df, order_by, "__position", {"__before": checked},
                                           rows_per_bucket=rows_per_bucket), "placed")
        totals = placed.select(F.col("__position").alias("position"), checked.cast("bigint").alias("size"),
                               F.col("__before").alias("before"))
        placed = placed.drop("__before")
    return with_batch(placed, "__position", filled(totals, max_bytes, max_rows), batch).drop("__position")


def multi_text_requests(df: DataFrame, text: str, build: Callable[[Column], Column],
                        batch: str = "batch", index: str = "index",
                        carry: Sequence[str] = ()) -> DataFrame:
    """One request per batch holding its texts in order.

    ``build`` turns the array of texts into the request. ``items`` keeps index and ``carry``
    columns so that answers go back to their rows by place. A batch is a handful of texts by
    construction, so the collected list is bounded.
    """
    item = F.struct(F.col(index), *[F.col(c) for c in carry], F.col(text).alias("__text"))
    grouped = df.groupBy(batch).agg(F.array_sort(F.collect_list(item)).alias("__items"))
    texts = F.transform("__items", lambda x: x["__text"])
    return grouped.select(
        batch,
        F.size("__items").alias("n_texts"),
        F.aggregate(F.transform(texts, F.length), F.lit(0).cast("bigint"),
                    lambda s, n: s + n).alias("total_chars"),
        F.transform("__items", lambda x: x.dropFields("__text")).alias("items"),
        build(texts).alias("request"))
