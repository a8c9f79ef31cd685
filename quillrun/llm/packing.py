"""Cost-balanced packing of tokenised documents into sequences of fixed capacity.

Attention over a document of n tokens costs ``linear * n + quadratic * n * n``. A document's whole
blocks of ``capacity`` tokens are sequences of their own. What is left of each document is packed:
in descending length, into the sequence of lowest cost so far that has room for it. There are as
many sequences as the tokens need; what fits no sequence whole is cut over those with room, lowest
cost first. So every window of ``window`` documents leaves less than one sequence of padding.

Windows follow the rows of a partition. Nothing shuffles, no key matters, and a task holds the token
ids of one window (plus one document) whatever the size of the table.

Defined cases: a null text is empty and has the closing id alone; a null id stays null; equal rows
are packed each for itself; an empty table gives no piece.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CAPACITY = 2048
WINDOW_DOCUMENTS = 4096
WINDOW_TOKENS = 1 << 23

PIECE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType())])


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes.

    With a file of merge ranks of the same vocabulary, texts go through the faster reader of such
    files; a text that holds a special token's string always goes through ``tokenizers`` itself, and
    so does one that the faster reader fails on (it panics on a million blanks in a row).
    """

    def __init__(self, path: str, ranks: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges,
                                           special_tokens={})

    def __call__(self, text: str) -> bytes:
        if self.plain is not None and not any(s in text for s in self.special):
            try:
                return array("I", self.plain.encode_ordinary(text)).tobytes()
            except BaseException as error:  # a panic is no Exception, and its class has no name to import
                if type(error).__name__ != "PanicException":
                    raise
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(*files: str | None) -> Encoder:
    """Built once per Python worker."""
    if files not in _ENCODERS:
        _ENCODERS[files] = Encoder(*files)
    return _ENCODERS[files]


def assign(lengths: np.ndarray, capacity: int, linear: float, quadratic: float
           ) -> list[tuple[int, int, int, int, int]]:
    """Pieces (item, from, length, sequence, offset) of items shorter than ``capacity``."""
    total = int(lengths.sum())
    count = -(-total // capacity)
    room = np.full(count, capacity, dtype=np.int64)
    cost = np.zeros(count)
    pieces = []
    for item in np.argsort(-lengths, kind="stable"):
        length = int(lengths[item])
        fits = room >= length
        if fits.any():
            into = int(np.where(fits, cost, np.inf).argmin())
            cuts = [(0, length, into)]
        else:
            cuts, done = [], 0
            while done < length:
                into = int(np.where(room > 0, cost, np.inf).argmin())
                take = min(int(room[into]), length - done)
                cuts.append((done, take, into))
                room[into] -= take
                done += take
            for _, take, into in cuts:
                room[into] += take
        for start, take, into in cuts:
            pieces.append((int(item), start, take, into, capacity - int(room[into])))
            room[into] -= take
            cost[into] += linear * take + quadratic * take * take
    return pieces


def _window(docs: list[tuple[int | None, bytes]], first: int, capacity: int, linear: float,
            quadratic: float, with_ids: bool) -> tuple[pa.RecordBatch, int]:
    columns: list[list] = [[] for _ in range(8)]

    def piece(doc: int, start: int, length: int, sequence: int, offset: int) -> None:
        doc_id, ids = docs[doc]
        part = ids[4 * start:4 * (start + length)]
        for column, value in zip(columns, (doc_id, start, length, zlib.crc32(part), len(ids) // 4,
                                           sequence, offset, part)):
            column.append(value)

    tails, items = [], []
    for doc, (_, ids) in enumerate(docs):
        tokens = len(ids) // 4
        for start in range(0, tokens - capacity + 1, capacity):
            piece(doc, start, capacity, first, 0)
            first += 1
        if tokens % capacity:
            items.append(doc)
            tails.append(tokens % capacity)
    lengths = np.array(tails, dtype=np.int64)
    for item, start, length, sequence, offset in assign(lengths, capacity, linear, quadratic):
        doc = items[item]
        piece(doc, len(docs[doc][1]) // 4 // capacity * capacity + start, length, first + sequence, offset)
    first += -(-int(lengths.sum()) // capacity)
    arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
    names = [f.name for f in PIECE.fields]
    if with_ids:
        values = np.frombuffer(b"".join(columns[7]), dtype="<u4").astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(columns[2], dtype=np.int64)]).astype(np.int32)
        arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values)))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names=names), first


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
                   linear: float = 1.0, quadratic: float = 1.0 / CAPACITY,
                   window: int = WINDOW_DOCUMENTS, with_ids: bool = False,
                   ranks: str | None = None, pattern: str | None = None,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece; ``with_ids`` adds its token ids. ``tokenizer`` is a file's path that every
    executor has; ``ranks`` (with the ``pattern`` that splits words) may name a file of the same
    vocabulary as merge ranks, which is read faster."""
    closing = array("I", [end_id]).tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, ranks, pattern)
        sequence = TaskContext.get().partitionId() << 32
        waiting, tokens = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + closing
                waiting.append((doc_id, ids))
                tokens += len(ids) // 4
                if len(waiting) >= window or tokens >= WINDOW_TOKENS:
                    out, sequence = _window(waiting, sequence, capacity, linear, quadratic, with_ids)
                    waiting, tokens = [], 0
                    yield out
        if waiting:
            yield _window(waiting, sequence, capacity, linear, quadratic, with_ids)[0]

    schema = T.StructType(PIECE.fields + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(pack, schema)
