"""Batches filled in order, each as full as it gets: greedy, yet without a task that sees all rows.

Where a batch that starts at a row ends is found by binary search in the running total, so every row
has a pointer to the start of the next batch. The starts that count are those reached from the first
row. Rows are cut into chunks of a few batches; a chunk also gets the rows that a batch begun in it can
reach. Each chunk follows the pointers from every row where its first batch may start to the first start
beyond it, which gives a step function of few steps, since chains that start apart soon meet. One pass
over these functions, a row per chunk and not per row, finds where each chunk is really entered, and the
chunks then list their own starts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrun.session import materialise

CHUNK_BATCHES = 16      # batches in a chunk, about
BLOCK_ROWS = 1 << 16    # rows that look their batch up in one list of changes


def _chunk(before, position, max_bytes: int, max_rows: int | None):
    """A chunk number that never falls: it grows with bytes and, where rows are capped, with rows."""
    chunk = F.floor(before / F.lit(CHUNK_BATCHES * max_bytes))
    if max_rows is not None:
        chunk = chunk + F.floor((position - 1) / F.lit(CHUNK_BATCHES * max_rows))
    return chunk.cast("bigint")


def _pointers(before: np.ndarray, size: np.ndarray, max_bytes: int, max_rows: int | None) -> np.ndarray:
    """For each row, the place of the first row that no longer fits a batch begun there."""
    ends = before + size
    found = np.searchsorted(ends, before + max_bytes, "right")
    if max_rows is not None:
        found = np.minimum(found, np.arange(len(ends)) + max_rows)
    return found


def _ordered(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    rows = rows.sort_values("position")
    return tuple(rows[c].to_numpy() for c in ("position", "size", "before", "own"))


def _steps(max_bytes: int, max_rows: int | None):
    def steps(rows: pd.DataFrame) -> pd.DataFrame:
        position, size, before, own = _ordered(rows)
        n = int(own.sum())  # a chunk's own rows come first
        if not n:
            return pd.DataFrame(columns=["chunk", "first", "last", "enters", "leaves", "starts"], dtype=object)
        jump = _pointers(before, size, max_bytes, max_rows)[:n]
        starts = np.ones(n, dtype=np.int64)
        while True:  # twice as far each round, until every chain has left
            inside = np.flatnonzero(jump < n)
            if not len(inside):
                break
            starts[inside] += starts[jump[inside]]
            jump[inside] = jump[jump[inside]]
        # a chunk is entered no later than where a batch begun before its first row ends
        doors = int(_pointers(before, size, max_bytes, max_rows)[0]) + 1
        jump, starts = jump[:doors], starts[:doors]
        new = np.flatnonzero(np.r_[True, (np.diff(jump) != 0) | (np.diff(starts) != 0)])
        return pd.DataFrame({
            "chunk": [int(rows["chunk"].iloc[0])], "first": [int(position[0])], "last": [int(position[n - 1])],
            "enters": [position[new]], "leaves": [jump[new] + position[0]], "starts": [starts[new]]})

    return steps


def _walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks in order, as (chunk, the first start in or after it, batches begun before it)."""
    at, batches = 1, 0
    for frame in frames:
        found = []
        for row in frame.itertuples():
            found.append((row.chunk, at, batches))
            if at <= row.last:
                step = int(np.searchsorted(row.enters, at, "right")) - 1
                batches += int(row.starts[step])
                at = int(row.leaves[step])
        yield pd.DataFrame(found, columns=["chunk", "at", "batches"])


def _changes(max_bytes: int, max_rows: int | None):
    def changes(rows: pd.DataFrame) -> pd.DataFrame:
        position, size, before, own = _ordered(rows)
        n, at = int(own.sum()), int(rows["at"].iloc[0])
        place, starts = at - int(position[0]) if n else 0, []
        jump = _pointers(before, size, max_bytes, max_rows)
        while place < n:
            starts.append(place)
            place = int(jump[place])
        number = int(rows["batches"].iloc[0]) + np.searchsorted(starts, np.arange(n), "right")
        block = (position[:n] - 1) // BLOCK_ROWS
        new = np.flatnonzero(np.r_[True, (np.diff(number) != 0) | (np.diff(block) != 0)]) if n else []
        return pd.DataFrame({"block": block[new], "since": position[:n][new], "number": number[new]})

    return changes


def filled(rows: DataFrame, max_bytes: int, max_rows: int | None = None) -> DataFrame:
    """``rows``: ``position`` (from 1), ``size`` (positive) and ``before`` of every row. The batches, as
    one row per block of positions: ``block`` and ``changes``, an array of (since, number)."""
    reach = _chunk(F.greatest(F.col("before") - max_bytes, F.lit(0)),
                   F.greatest(F.col("position") - (max_rows or 0), F.lit(1)), max_bytes, max_rows)
    own = _chunk(F.col("before"), F.col("position"), max_bytes, max_rows)
    # a row is its own chunk's and that of at most two before it
    dealt = materialise(rows.select("position", "size", "before", own.alias("home"), F.explode(
        F.sequence(reach, own)).alias("chunk")).withColumn("own", F.col("home") == F.col("chunk")).drop("home"),
        "chunks")
    steps = materialise(dealt.groupBy("chunk").applyInPandas(
        _steps(max_bytes, max_rows), "chunk long, first long, last long, enters array<long>, "
        "leaves array<long>, starts array<long>"), "steps")
    # one row per chunk, of sixteen batches
    entered = steps.repartition(1).sortWithinPartitions("first").mapInPandas(
        _walk, "chunk long, at long, batches long")
    known = materialise(entered, "entered")
    changes = dealt.join(known, "chunk").groupBy("chunk").applyInPandas(
        _changes(max_bytes, max_rows), "block long, since long, number long")
    return materialise(changes.groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("since", "number"))).alias("changes")), "changes")


def with_batch(rows: DataFrame, position: str, changes: DataFrame, batch: str) -> DataFrame:
    """Rows with the number of the batch that their position falls in."""
    passed = F.filter("changes", lambda c: c["since"] <= F.col(position))
    block = F.expr(f"(`{position}` - 1) div {BLOCK_ROWS}")
    return rows.withColumn("block__", block).join(
        changes.withColumnRenamed("block", "block__"), "block__").withColumn(
        batch, F.element_at(passed, -1)["number"].cast("bigint")).drop("block__", "changes")
