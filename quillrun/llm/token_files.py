"""Token ids of documents as Parquet files that can be read in part.

A row is a document: its ids as one list column, and what is known of it (id, place, number of ids, the
other columns as the struct ``meta``). Rows ascend by id, over files and inside them. Parquet keeps a
list column apart from the others, so a reader that wants no ids reads none; row groups and pages are
small and their least and greatest ids stand in the page index, so a reader of a few documents or of a
stretch of the token stream reads the pages that hold them. Ids are written as places in a dictionary
(one vocabulary fits one dictionary page) or as deltas packed to the width of each block.

Documents shuffle once, as texts, by ranges of (id, digest of the text, stored place); the place cuts
one id or text that holds a large share of the rows. Each task encodes its range in order and writes one
file, with the ids before each document inside that file; a table of one row per file has the ids before
each file. Both together are a document's place in the whole stream, and no text is encoded twice.

Defined cases: a null text is empty and has the closing id alone; null ids come first; rows of one id
follow each other by the digest of their texts, and rows alike in both in any order; texts are cut
nowhere; extra columns lie in ``meta``, whatever their names; an empty table gives files without rows.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillrun.llm import words as word_bytes
from quillrun.llm.arrow_batches import batches_of

ROWS_AT_ONCE = 64           # texts in an Arrow batch
CHARS_AT_ONCE = 1 << 20     # characters encoded at once and handed on as a batch, unless one text has more
WORD_CHARS = 64             # longer words are not kept
WORDS_KEPT = 1 << 19
# How the vocabulary cuts words (here for characters below U+0100), and the letters that
# stand for bytes in its merges: printable ones for themselves, the others from U+0100 on.
BLANK, LETTER, DIGIT, MARK = range(4)
KINDS = np.array([BLANK if chr(c) in "\t\n\v\f\r \x85\xa0" else {"L": LETTER, "N": DIGIT}.get(
    unicodedata.category(chr(c))[0], MARK) for c in range(256)], dtype=np.uint8)
PIECE_BEGINS = re.compile("[0-9\t-\r \x85\xa0]")  # no piece goes across the place before one of these
BYTE_LETTER = {b: 256 + n for n, b in enumerate(
    b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}
ENCODINGS = {
    "dictionary": {"parquet.enable.dictionary": "true", "parquet.writer.version": "PARQUET_1_0"},
    "delta": {"parquet.enable.dictionary": "true", "parquet.enable.dictionary#ids.list.element": "false",
              "parquet.writer.version": "PARQUET_2_0"},
}


class Kept(dict):
    """What ``find`` gives for a string, as little-endian unsigned 32-bit bytes; short strings that come
    again are looked up. The last ``WORDS_KEPT`` strings stay until as many new ones have come."""

    def __init__(self, find: Callable[[str], list[int]]):
        super().__init__()
        self.find, self.before = find, {}

    def __missing__(self, word: str) -> bytes:
        found = self.before.get(word)
        if found is None:
            found = array("I", self.find(word)).tobytes()
        if len(word) <= WORD_CHARS:
            if len(self) >= WORDS_KEPT:
                self.before = dict(self)
                self.clear()
            self[word] = found
        return found


class WordIds:
    """Ids of texts, piece by piece.

    The vocabulary's rules put a text in lower case and cut it into runs of letters, digits and marks,
    each of which is merged for itself; they never look past a blank. Texts (or else words) of Latin
    letters are cut here as the rules say, many at once, and each of their different pieces is looked up
    once; any other word goes through the tokenizer as a whole, and so does a text that holds a special
    token's string.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces, self.words = Kept(self._merged), Kept(self._encoded)

    def _merged(self, piece: str) -> list[int]:
        if not (piece.isascii() and piece.isprintable()):
            piece = piece.encode().decode("latin-1").translate(BYTE_LETTER)
        return [t.id for t in self.merge(piece)]

    def _encoded(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _latin(self, runs: list[str]) -> list[bytes]:
        data = np.frombuffer("\n".join(runs).lower().encode("latin-1"), dtype=np.uint8)
        places, pieces = cut_pieces(data)
        coded = pieces.dictionary_encode()
        codes = coded.indices.to_numpy()
        _, bounds, letters = coded.dictionary.buffers()
        letters = letters.to_pybytes().decode("latin-1") if letters else ""
        bounds = np.frombuffer(bounds, dtype=np.int32)[:len(coded.dictionary) + 1].tolist()
        found = [self.pieces[letters[a:b]] for a, b in zip(bounds, bounds[1:])]
        ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4)])
        count = np.diff(ends)[codes]
        before = np.concatenate([[0], np.cumsum(count)])
        ids = np.frombuffer(b"".join(found), dtype="<u4")[
            np.arange(before[-1]) + np.repeat(ends[codes] - before[:-1], count)]
        first = before[np.searchsorted(places, np.cumsum([0] + [len(run) + 1 for run in runs]))]
        return [ids[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]

    def of_texts(self, texts: list[str]) -> list[bytes]:
        runs, parts = [], [[] for _ in texts]  # a text's parts: numbers of its Latin runs, or ids
        for own, text in zip(parts, texts):
            if any(special in text for special in self.special):
                own.append(array("I", self._encoded(text)).tobytes())
                continue
            for latin, words in [(True, [text])] if _is_latin(text) else groupby(
                    text.replace("\n", " ").split(" "), _is_latin):
                if not latin:
                    own += [self.words[word] for word in words]
                    continue
                for run in _stretches(" ".join(words)):
                    own.append(len(runs))
                    runs.append(run)
        offsets = np.cumsum([0] + [len(run) for run in runs])
        found = [ids for a, b in word_bytes.cut(offsets, CHARS_AT_ONCE) for ids in self._latin(runs[a:b])]
        return [b"".join([found[part] if isinstance(part, int) else part for part in own]) for own in parts]

    def of_text(self, text: str) -> bytes:
        return self.of_texts([text])[0]


def _stretches(run: str) -> Iterator[str]:
    """A very long text in parts that no piece goes across."""
    at = 0
    while at + CHARS_AT_ONCE < len(run) and (begin := PIECE_BEGINS.search(run, at + CHARS_AT_ONCE)):
        yield run[at:begin.start()]
        at = begin.start()
    yield run[at:]


def cut_pieces(data: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Pieces of a lower-case Latin-1 text, and where they start: runs of letters, an apostrophe that begins
    a run of marks with s, t, m, d, re, ve or ll after it, single digits, runs of marks."""
    kind = KINDS[data]
    start = kind != BLANK
    start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    quote = np.flatnonzero(start & (data == ord("'")))
    one, two = (np.concatenate([data, np.full(2, ord("\n"), np.uint8)])[quote + n] for n in (1, 2))
    short = np.isin(one, list(b"stmd"))
    long = np.zeros(len(quote), dtype=bool)
    for a, b in (b"re", b"ve", b"ll"):
        long |= (one == a) & (two == b)
    start[quote[short | long] + 1] = False
    rest = np.concatenate([quote[short] + 2, quote[long] + 3])
    rest = rest[rest < len(data)]
    start[rest[kind[rest] != BLANK]] = True
    full = kind != BLANK
    bounds = np.append(np.flatnonzero(start[full]), np.count_nonzero(full)).astype(np.int32)
    return np.flatnonzero(start), pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data[full])])


def _is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


_WORDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """Built once per Python worker."""
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def _lists(parts: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(p) // 4 for p in parts]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), dtype="<i4")))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches together, so that a piece is looked up once in many texts."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(b.nbytes for b in held) + batch.nbytes > CHARS_AT_ONCE:
            yield pa.concat_batches(held)
            held = []
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def _encode(tokenizer: str, end_id: int):
    closing = np.array([end_id], dtype="<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shard, place, before = word_ids(tokenizer), TaskContext.get().partitionId(), 0, 0
        for batch in _joined(batches):
            first, texts, held = 0, [], 0
            for row, text in enumerate(batch.column(2)):
                texts.append(text.as_py() or "")
                held += len(texts[-1])
                if held < CHARS_AT_ONCE and row + 1 < batch.num_rows:
                    continue
                parts = [ids + closing for ids in words.of_texts(texts)]
                count = np.array([len(p) // 4 for p in parts], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(parts)), batch.column(1).slice(first, len(parts)),
                    pa.array(np.full(len(parts), shard, dtype=np.int32)),
                    pa.array(np.arange(place, place + len(parts), dtype=np.int64)),
                    pa.array(before + np.cumsum(count) - count), pa.array(count), _lists(parts),
                ], names=["doc_id", "meta", "shard", "place", "before", "n_tokens", "ids"])
                place, before = place + len(parts), before + int(count.sum())
                first, texts, held = row + 1, [], 0

    return encode


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, encoding: str = "dictionary",
                      row_group_bytes: int = 16 << 20, page_bytes: int = 64 << 10, page_rows: int = 1024,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``path/tokens`` (the documents) and ``path/shards`` (a row per file). ``tokenizer`` is a
    file's path that every executor has."""
    spark = docs.sparkSession
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    meta = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), meta.alias("meta"),
                       F.col(text_col).alias("text"), F.xxhash64(text_col).alias("digest"),
                       F.monotonically_increasing_id().alias("row"))
    key = [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("row")]
    ordered = rows.repartitionByRange(*key).sortWithinPartitions(*key).drop("digest", "row")
    schema = T.StructType([rows.schema["doc_id"], rows.schema["meta"], T.StructField("shard", T.IntegerType()),
                           T.StructField("place", T.LongType()), T.StructField("before", T.LongType()),
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])
    options = {"parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes,
               "parquet.page.row.count.limit": page_rows, "parquet.dictionary.page.size": 1 << 20,
               **ENCODINGS[encoding]}
    with batches_of(spark, ROWS_AT_ONCE):
        ordered.mapInArrow(_encode(tokenizer, end_id), schema).write.options(
            **{k: str(v) for k, v in options.items()}).parquet(f"{path}/tokens")
    shards = read_metadata(spark, path, placed=False).groupBy("shard").agg(
        F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"),
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    (shards.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
     .withColumn("first_doc", F.coalesce(F.sum("n_docs").over(before), F.lit(0)))
     .write.parquet(f"{path}/shards"))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/shards")


def read_tokens(spark: SparkSession, path: str, first_id: int | None = None,
                last_id: int | None = None) -> DataFrame:
    """Documents with ``start``, the number of ids before each; of ``first_id`` to ``last_id`` if given,
    which the scan finds by row group and page."""
    rows = spark.read.parquet(f"{path}/tokens")
    if first_id is not None:
        rows = rows.where(F.col("doc_id") >= first_id)
    if last_id is not None:
        rows = rows.where(F.col("doc_id") <= last_id)
    return _with_start(rows, read_shards(spark, path))


def _with_start(rows: DataFrame, shards: DataFrame) -> DataFrame:
    kept = [c for c in rows.columns if c not in ("before", "place")]
    return rows.join(shards.select("shard", "first_token", "first_doc"), "shard").select(
        *kept, (F.col("first_token") + F.col("before")).alias("start"),
        (F.col("first_doc") + F.col("place")).alias("position"))


def read_metadata(spark: SparkSession, path: str, placed: bool = True) -> DataFrame:
    """All but the ids, whose column is not read."""
    rows = spark.read.parquet(f"{path}/tokens").drop("ids")
    return _with_start(rows, read_shards(spark, path)) if placed else rows


def read_stretch(spark: SparkSession, path: str, first: int, length: int) -> DataFrame:
    """Ids ``first`` to ``first + length`` of the whole stream, as the pieces that its documents hold:
    ``doc_id``, ``start`` (of the piece, in the stream) and ``ids``. Files outside are not opened and
    pages outside not read."""
    shards = read_shards(spark, path).where(
        (F.col("first_token") < first + length) & (F.col("first_token") + F.col("n_tokens") > first))
    ends = shards.agg(F.min_by("shard", "first_token"), F.max_by("shard", "first_token"),
                      F.min("first_token"), F.max("first_token")).first()
    rows = spark.read.parquet(f"{path}/tokens").where(F.col("shard").between(ends[0], ends[1]))
    if ends[0] is not None and ends[0] == ends[1]:  # one file: its own places are known
        rows = rows.where((F.col("before") < first + length - ends[2]) &
                          (F.col("before") + F.col("n_tokens") > first - ends[2]))
    begin = F.greatest(F.lit(first), F.col("start"))
    end = F.least(F.lit(first + length), F.col("start") + F.col("n_tokens"))
    return (_with_start(rows, read_shards(spark, path)).where(end > begin)
            .select("doc_id", begin.alias("start"), F.slice(
                "ids", (begin - F.col("start") + 1).cast("int"), (end - begin).cast("int")).alias("ids")))


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(3)
        values = ids.values.to_numpy(zero_copy_only=False)
        ends = ids.offsets.to_numpy()
        sums = [zlib.crc32(values[a:b].astype("<u4").tobytes()) for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())],
                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])


def checksums(tokens: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of documents as `read_tokens` gives them."""
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        _checked, "doc_id long, start long, n_tokens long, ids_crc32 long")
