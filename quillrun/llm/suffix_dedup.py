"""Removal of long repeated byte strings by column-wise suffix sorting of many short contexts.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else. Inserting one
symbol per document each round into a transform of the whole collection takes as many passes over all
of it as the longest document has bytes, so the sort is applied to what can match at all:

1. *Anchors.* Of the ``GRAM``-byte strings inside a window of ``LENGTH`` bytes the one with the least
   hash (the first of equals) is the window's anchor. Equal windows have the same anchor at the same
   place, so windows only have to be compared between occurrences of an anchor. The windows of one
   occurrence are consecutive; their bytes together are its context, about ``LENGTH`` + 100 bytes.
2. *Intervals.* Anchors that occur once leave. Occurrences with the same context (by hash) repeat
   all its windows. What is left are anchors with several different contexts: the ends of repeats.
3. *Columns.* Those contexts, lined up at their anchor, are sorted column by column from the right: each
   round puts the next symbol of every context before its suffix, a stable sort by symbol carries the
   order over, and the common prefix of neighbours is one more than the least between them before. A
   window is repeated where a neighbour's common prefix reaches ``LENGTH``. Batches of contexts are
   arrays in a task and Spark's shuffles stand for the external files. An anchor with more than
   ``HOT`` contexts is spread by hashes of its single windows instead, with the same result.

Defined cases: texts are UTF-8, null is empty; a text shorter than ``LENGTH`` keeps everything; equal
texts of at least that length lose everything; strings may overlap and lie in one text; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrun.llm import bitmaps, words
from quillrun.session import materialise

LENGTH = 400
GRAM = 200
WINDOW = LENGTH - GRAM + 1
LEFT = WINDOW - 1            # bytes of a context before its anchor, at most
BYTES_AT_ONCE = 1 << 20
PLACE_BITS = 21
CONTEXTS_PER_BATCH = 4096
HOT = 20_000

TEXT = ["d1", "d2"]
ANCHOR = "d1 long, d2 long, hash long, ctx long, at long, s0 long, s1 long"
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLES: dict[int, np.ndarray] = {}


def _powers(base: int, count: int) -> np.ndarray:
    table = _TABLES.get(base, np.ones(1, dtype=np.uint64))
    while len(table) < count:
        table = np.concatenate([table, table * np.uint64(pow(base, len(table), 1 << 64))])
    _TABLES[base] = table
    return table[:count]


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every window, by running minima from both ends of blocks."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1:width - 1 + count])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text number, anchor hash, context hash, anchor place, first and last window start."""
    n = len(data)
    if n < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words.BYTE_VALUE[data] * _powers(_BASE, n), out=sums[1:])
    back = _powers(pow(_BASE, -1, 1 << 64), n)
    grams = words.mix((sums[GRAM:] - sums[:-GRAM]) * back[:n - GRAM + 1])
    mask = np.uint64((1 << PLACE_BITS) - 1)
    least = _sliding_min((grams & ~mask) | np.arange(len(grams), dtype=np.uint64), WINDOW)
    place = (least & mask).astype(np.int64)
    change = np.zeros(len(place) + 1, dtype=np.int64)
    long = np.diff(offsets) >= LENGTH
    change[offsets[:-1][long]] += 1
    change[offsets[1:][long] - LENGTH + 1] -= 1
    valid = np.cumsum(change[:-1]) > 0
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | (place[1:] != place[:-1])
    s0, s1 = np.flatnonzero(first), np.flatnonzero(last)
    at = place[s0]
    context = words.mix((sums[s1 + LENGTH] - sums[s0]) * back[s0]
                        + (s1 - s0).astype(np.uint64) * words.PLACE_VALUE[50]
                        + (at - s0).astype(np.uint64) * words.PLACE_VALUE[51])
    text = np.searchsorted(offsets, s0, "right") - 1
    begin = offsets[text]
    return (text, grams[at].view(np.int64), context.view(np.int64), at - begin, s0 - begin, s1 - begin)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[tuple[int, int]] = set()
    names = [c.split()[0] for c in ANCHOR.split(", ")]
    for batch in batches:
        one, two = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        fresh = []
        for i, key in enumerate(zip(one.tolist(), two.tolist())):
            if key not in seen:  # equal texts of a task are sent once
                seen.add(key)
                fresh.append(i)
        one, two = one[fresh], two[fresh]
        data, offsets = words.text_bytes(batch.column(2).take(pa.array(fresh, pa.int64())))
        for a, b in words.cut(offsets, BYTES_AT_ONCE):
            begin, end = int(offsets[a]), int(offsets[b])
            # a very long text is read in stretches, each with the bytes that its last windows need
            for start in range(begin, max(begin + 1, end - LENGTH + 1), BYTES_AT_ONCE):
                stop = min(end, start + BYTES_AT_ONCE + LENGTH - 1) if b == a + 1 else end
                inner = offsets[a:b + 1] - start if b > a + 1 else np.array([0, stop - start])
                text, gram, context, at, s0, s1 = anchors(data[start:stop], inner)
                if len(text):
                    text = text + a
                    shift = (start - begin) if b == a + 1 else 0
                    columns = [one[text], two[text], gram, context, at + shift, s0 + shift, s1 + shift]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)
                if b > a + 1:
                    break


def repeated_starts(groups: np.ndarray, lefts: np.ndarray, contexts: list[bytes]) -> np.ndarray:
    """For contexts lined up at their anchor (``lefts`` bytes before it), which windows are repeated
    in their group: a table of contexts x window starts, from LEFT bytes before the anchor."""
    count, width = len(contexts), LEFT + LENGTH
    order = np.argsort(groups, kind="stable")
    group_at = np.unique(groups[order], return_inverse=True)[1].astype(np.int64) * 512
    symbols = np.zeros((count, width), dtype=np.int16)
    for i, (left, context) in enumerate(zip(lefts, contexts)):
        symbols[i, LEFT - left:LEFT - left + len(context)] = np.frombuffer(context, np.uint8).astype(np.int16) + 1
    symbols = np.ascontiguousarray(symbols.T)
    found = np.zeros((count, WINDOW), dtype=bool)
    common = np.zeros(count + 1, dtype=np.int32)  # of a suffix and the one before it
    for column in range(width - 1, -1, -1):
        own = symbols[column][order]
        key = group_at + own
        moved = np.argsort(key, kind="stable")
        key = key[moved]
        same = (key[1:] == key[:-1]) & (key[1:] % 512 > 0)
        longer = np.zeros(count + 1, dtype=np.int32)
        if same.any():
            ends = np.stack([moved[:-1][same] + 1, moved[1:][same] + 1], axis=1).ravel()
            longer[1:-1][same] = np.minimum.reduceat(common, ends)[::2] + 1
        order, common = order[moved], longer
        if column < WINDOW:
            found[order[np.maximum(common[:-1], common[1:]) >= LENGTH], column] = True
    return found


def _batch_marks(frame: pd.DataFrame) -> pd.DataFrame:
    found = repeated_starts(frame["hash"].to_numpy(), frame["left"].to_numpy(), list(frame["bytes"]))
    edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, lo = np.nonzero(edge == 1)
    hi = np.nonzero(edge == -1)[1] - 1
    return pd.DataFrame({"hash": frame["hash"].to_numpy()[row], "ctx": frame["ctx"].to_numpy()[row],
                         "lo": lo - LEFT, "hi": hi - LEFT})


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts asked for; one row per context."""
    for batch in batches:
        rows = []
        for text, asked in zip(batch.column("text").to_pylist(), batch.column("asked").to_pylist()):
            data = text.encode()
            rows += [(r["hash"], r["ctx"], r["at"] - r["s0"], data[r["s0"]:r["s1"] + LENGTH], r["n"]) for r in asked]
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         names=["hash", "ctx", "left", "bytes", "n"])


def _hot_marks(contexts: DataFrame) -> DataFrame:
    """Repeated windows of anchors with very many contexts, window by window."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for gram, context, left, data, _ in zip(*[c.to_pylist() for c in batch.columns]):
                rows += [(gram, context, start - left,
                          hashlib.blake2b(data[start:start + LENGTH], digest_size=16).digest())
                         for start in range(len(data) - LENGTH + 1)]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.int64(), pa.binary()])],
                names=["hash", "ctx", "lo", "window"])

    single = materialise(contexts.mapInArrow(windows, "hash long, ctx long, lo long, window binary"), "windows")
    key = ["hash", "lo", "window"]
    again = materialise(single.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").drop("n"), "again")
    return single.join(again, key).select("hash", "ctx", "lo", F.col("lo").alias("hi"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.lit(1), text).alias("d1"),
                       F.xxhash64(F.lit(2), text).alias("d2"), text.alias("text"))


def removed_stretches(docs: DataFrame) -> DataFrame:
    """``d1``, ``d2`` (a text's name) and ``stretches`` to remove, as (from, to) in bytes, unmerged."""
    texts = docs.where(F.octet_length("text") >= LENGTH)
    names = materialise(texts.groupBy(*TEXT).agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("least"),
        F.min(F.octet_length("text")).alias("n_bytes")), "names")
    marks = materialise(texts.select(*TEXT, "text").mapInArrow(_anchor_rows, ANCHOR), "anchors")
    often = materialise(marks.groupBy("hash").agg(F.count("*").alias("n"), F.min("ctx").alias("low"),
                                                  F.max("ctx").alias("high")).where("n > 1"), "often")
    met = materialise(marks.join(often.select("hash", (F.col("low") != F.col("high")).alias("mixed")), "hash"),
                      "met")
    contexts = materialise(met.groupBy("hash", "ctx").agg(
        F.count("*").alias("n"), F.max("mixed").alias("mixed"),
        F.min(F.struct(*TEXT, "at", "s0", "s1")).alias("one")), "contexts")
    whole = contexts.where("n > 1").select("hash", "ctx", F.lit(None).cast("long").alias("lo"),
                                           F.lit(None).cast("long").alias("hi"))
    mixed = contexts.where("mixed")
    # written, so that the join deals both sides out anew and can split an anchor with many contexts
    sizes = materialise(mixed.groupBy("hash").agg(F.count("*").alias("n")), "sizes")
    asked = materialise(
        mixed.select("hash", "ctx", "one.*").join(sizes, "hash").groupBy(*TEXT)
        .agg(F.collect_list(F.struct("hash", "ctx", "at", "s0", "s1", "n")).alias("asked"))
        .join(names.select(*TEXT, "least"), TEXT), "asked")
    test, cells = bitmaps.filter_of(asked, "d1", asked.count(), "asked-filter")
    near = bitmaps.with_test(texts, F.col("d1"), test, cells, "maybe").where("maybe")
    cut = near.select(*TEXT, "doc_id", "text").join(
        asked, (near.d1 == asked.d1) & (near.d2 == asked.d2) & near.doc_id.eqNullSafe(asked.least)).select("text", "asked")
    cut = materialise(cut.mapInArrow(_cut_contexts, "hash long, ctx long, left int, bytes binary, n long")
                      .dropDuplicates(["hash", "ctx"]), "cut")
    batches = max(1, cut.count() // CONTEXTS_PER_BATCH)
    sorted_ = (cut.where(f"n <= {HOT}").withColumn("batch", F.pmod(F.xxhash64("hash"), F.lit(batches)))
               .groupBy("batch").applyInPandas(_batch_marks, "hash long, ctx long, lo long, hi long"))
    partial = sorted_.unionByName(_hot_marks(cut.where(f"n > {HOT}"))).join(
        whole.select("hash", "ctx"), ["hash", "ctx"], "left_anti")
    found = materialise(whole.unionByName(partial), "found")
    covered = met.join(found, ["hash", "ctx"]).select(
        *TEXT, F.coalesce(F.col("at") + F.col("lo"), "s0").alias("from"),
        (F.coalesce(F.col("at") + F.col("hi"), "s1") + LENGTH).alias("to"))
    copies = names.where("copies > 1").select(*TEXT, F.lit(0).cast("long").alias("from"),
                                              F.col("n_bytes").cast("long").alias("to"))
    return (covered.unionByName(copies).groupBy(*TEXT)
            .agg(F.collect_list(F.struct("from", "to")).alias("stretches")))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, stretches in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "stretches")]):
            data, kept, at, spans = text.encode(), [], 0, 0
            for lo, hi in sorted((s["from"], s["to"]) for s in stretches or []):
                if lo > at or not spans:
                    kept.append(data[at:lo])
                    spans += 1
                at = max(at, hi)
            kept = b"".join([*kept, data[at:]])
            rows.append((doc_id, len(data), len(data) - len(kept), spans, kept))
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the
    bytes that are left (not always valid UTF-8). Texts that lose nothing don't shuffle."""
    keyed = _keyed(docs, id_col, text_col)
    stretches = materialise(removed_stretches(keyed), "stretches")
    test, cells = bitmaps.filter_of(stretches, "d1", stretches.count(), "stretches-filter")
    tested = bitmaps.with_test(keyed, F.col("d1"), test, cells, "maybe")
    none = F.lit(0).cast("long")
    same = tested.where("NOT maybe").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), none.alias("n_removed"),
        none.alias("n_spans"), F.col("text").cast("binary").alias("kept"))
    cut = (tested.where("maybe").join(stretches, TEXT, "left").select("doc_id", "text", "stretches")
           .mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))
    return same.unionByName(cut)
