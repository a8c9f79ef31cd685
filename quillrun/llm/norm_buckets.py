"""Exact ranked lexical search over buckets of impact vectors ordered by length.

A document's score for an item is a sum over the item's terms of an impact, a whole number that depends
on the document and the term alone. So a document is a vector of impacts, an item a vector of ones, and
the best documents are the largest inner products. As in LEMP (Teflioudi, Gemulla and Mykytiuk 2015):

* vectors are ordered by length and cut into buckets; by the Cauchy-Schwarz inequality an item with t
  terms scores at most sqrt(t) times a bucket's greatest length, so buckets of short vectors are left out
  for the items whose k-th best score so far is higher;
* inside a bucket the few terms of an item that weigh most are added up first; what the others can add
  is bounded by the length that is left of the vector, and most vectors are given up there;
* survivors are scored anew in 64-bit integers, so the result doesn't depend on any bound.

One pass over the texts keeps, for each document, its number of terms and the counts of those terms that
some item asks for. Vectors go by ranges of length (and place, so that no length fills a bucket alone)
into a written table. The first bucket gives each item a k-th best score; the others are then searched
in parallel, where the scan leaves out all that is too short for every item. Items come in blocks, which
bounds what the driver and each task hold of them, whatever the size of their table.

Defined cases: a null text has no terms and a null item no results; an item's terms count once each;
rows of one id are ranked each for itself, and so are items of one id; null document ids come last among
equal scores; items with null ids keep them; an empty table on either side gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillrun.llm.arrow_batches import batches_of
from quillrun.llm.words import cut, text_bytes, word_hashes
from quillrun.session import materialise

TOP = 10
TERMS_IN_BLOCK = 1 << 19    # terms of the items that are searched for together
BUCKET = 1024               # vectors that are looked at together, within a task's range of lengths
FOCUS = 8                   # an item's terms that are added up first
ROWS_AT_ONCE = 64
BYTES_AT_ONCE = 4 << 20
SLACK = 1 + 1e-9            # bounds are doubles

# a term is a run of ASCII letters, digits and whatever is not ASCII; the rest stands as a blank
_TERM_BYTE = np.arange(256, dtype=np.uint8)
_TERM_BYTE[:128][[not chr(c).isalnum() for c in range(128)]] = 32


def text_terms(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts: the first's number, hashes of all their terms in order, and where each text's
    terms start (one more than texts)."""
    data, offsets = text_bytes(texts)
    for first, last in cut(offsets, BYTES_AT_ONCE):
        part = _TERM_BYTE[data[offsets[first]:offsets[last]]]
        yield first, *word_hashes(part, offsets[first:last + 1] - offsets[first])


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for _, hashes, starts in text_terms(batch.column(2)):
            found += [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(starts[:-1], starts[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([f.tolist() for f in found], pa.list_(pa.int64()))],
            names=["item", "item_id", "terms"])


def _counted(vocabulary: np.ndarray):
    """Of each text the number of terms, and place and count of those in the (sorted) vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, starts in text_terms(batch.column(1)):
                texts = len(starts) - 1
                at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                asked = vocabulary[at] == hashes
                text = np.repeat(np.arange(texts), np.diff(starts))
                pairs, tf = np.unique(text[asked] * len(vocabulary) + at[asked], return_counts=True)
                owner, term = np.divmod(pairs, len(vocabulary))
                ends = pa.array(np.searchsorted(owner, np.arange(texts + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, texts), pa.array(np.diff(starts)),
                     pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int64)))],
                    names=["doc_id", "n", "terms", "tf"])

    return count


def _document_counts(size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, dtype=np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(df).astype(np.int32)), pa.array(df[df > 0])],
                                         names=["term", "df"])

    return count


def _impacts(weights: np.ndarray, documents: int, terms: int):
    """Vectors: what a document's terms add to a score, and the vector's length."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends = lists.offsets.to_numpy()
            term = lists.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
            tf = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy(zero_copy_only=False)
            m = np.repeat(10 + 90 * n * documents // max(terms, 1), np.diff(ends))
            impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            squares = np.concatenate([[0.0], np.cumsum(impact.astype(np.float64) ** 2)])
            # a difference of running sums may be a little off, a length must not be too short
            length = np.sqrt(np.maximum(squares[ends[1:] - ends[0]] - squares[ends[:-1] - ends[0]], 0)
                             + squares[-1] * 1e-12)
            offsets = pa.array((ends - ends[0]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(length), pa.ListArray.from_arrays(offsets, pa.array(term)),
                 pa.ListArray.from_arrays(offsets, pa.array(impact))],
                names=["doc_id", "length", "terms", "impacts"])

    return weigh


class Best:
    """The best scores of one item so far: score descending, then id, null ids last."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, floor
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)
        self.no_id = np.zeros(0, bool)

    def add(self, score: np.ndarray, doc: np.ndarray, no_id: np.ndarray) -> None:
        good = score >= max(self.floor, 1)
        score, doc, no_id = (np.concatenate([a, b[good]]) for a, b in zip(
            (self.score, self.doc, self.no_id), (score, doc, no_id)))
        order = np.lexsort((doc, no_id, -score))[:self.k]
        self.score, self.doc, self.no_id = score[order], doc[order], no_id[order]
        if len(order) == self.k:
            self.floor = int(self.score[-1])


def _postings(ends: np.ndarray, term: np.ndarray, impact: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Postings of a bucket by term: sorted terms, the vectors that hold them, their impacts."""
    order = np.argsort(term, kind="stable")
    return term[order], np.repeat(np.arange(len(ends) - 1), np.diff(ends))[order], impact[order]


def _search_bucket(best: Best, terms: np.ndarray, focus: np.ndarray, length: np.ndarray, postings,
                   doc: np.ndarray, no_id: np.ndarray) -> None:
    """``terms``: the item's, ``focus``: those of most weight. ``length``: of the vectors, descending."""
    at, vector, impact = postings
    # lengths fall, so the vectors that Cauchy-Schwarz leaves are the first ones
    left = int(np.searchsorted(-length, -best.floor / (np.sqrt(len(terms)) * SLACK), "right")) \
        if best.floor > 0 else len(length)
    if not left:
        return
    low, high = np.searchsorted(at, focus, "left"), np.searchsorted(at, focus, "right")
    known, used = np.zeros(len(length)), np.zeros(len(length))
    for a, b in zip(low, high):
        known[vector[a:b]] += impact[a:b]
        used[vector[a:b]] += impact[a:b].astype(np.float64) ** 2
    rest = np.sqrt(np.maximum(length * length - used, 0) * (len(terms) - len(focus)))
    alive = np.flatnonzero((known[:left] + rest[:left]) * SLACK >= max(best.floor, 1))
    if not len(alive):
        return
    score = np.zeros(len(length), dtype=np.int64)
    low, high = np.searchsorted(at, terms, "left"), np.searchsorted(at, terms, "right")
    keep = np.zeros(len(length), dtype=bool)
    keep[alive] = True
    for a, b in zip(low, high):
        own = keep[vector[a:b]]
        score[vector[a:b][own]] += impact[a:b][own]  # a vector has a term once
    best.add(score[alive], doc[alive], no_id[alive])


def _search(items: list[tuple[int, np.ndarray]], weights: np.ndarray, floors: list[int], k: int):
    """Search the buckets of a task for ``items`` (number, places of terms in the vocabulary)."""
    focus = [t[np.argsort(-weights[t], kind="stable")[:FOCUS]] for _, t in items]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k, floor) for floor in floors]
        for batch in batches:
            lists = batch.column(2)
            length = batch.column(1).to_numpy(zero_copy_only=False)
            order = np.argsort(-length, kind="stable")
            ids = batch.column(0)
            doc = ids.fill_null(0).to_numpy(zero_copy_only=False)[order]
            no_id = ids.is_null().to_numpy(zero_copy_only=False)[order]
            taken = lists.take(pa.array(order))
            ends = taken.offsets.to_numpy()
            postings = _postings(ends, taken.flatten().to_numpy(zero_copy_only=False),
                                 batch.column(3).take(pa.array(order)).flatten().to_numpy(zero_copy_only=False))
            for own, (_, terms), heavy in zip(best, items, focus):
                _search_bucket(own, terms, heavy, length[order], postings, doc, no_id)
        found = [(number, int(s), None if none else int(d)) for own, (number, _) in zip(best, items)
                 for s, d, none in zip(own.score, own.doc, own.no_id)]
        if found:
            columns = list(zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=["item", "score", "doc_id"])

    return search


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = TaskContext.get().partitionId()
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(batch.num_rows, shard, dtype=np.int32))],
            names=[*batch.schema.names, "shard"])


def _search_block(vectors: DataFrame, found: list, vocabulary: np.ndarray, k: int) -> DataFrame:
    """``found``: rows item, terms. The best of each shard: item, score, doc_id."""
    spark = vectors.sparkSession
    shape = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    documents, terms = shape[0], shape[1] or 0
    counted = (vectors.select("terms").mapInArrow(_document_counts(len(vocabulary)), "term int, df long")
               .groupBy("term").agg(F.sum("df").alias("df")).toArrow())  # as many rows as the vocabulary
    weights = np.zeros(len(vocabulary), dtype=np.int64)
    weights[counted["term"].to_numpy()] = np.floor(
        1000 * np.log((2.0 * documents + 2) / (2.0 * counted["df"].to_numpy() + 1))).astype(np.int64)
    items = [(r["item"], np.searchsorted(vocabulary, np.array(r["terms"], dtype=np.int64).view(np.uint64)))
             for r in found]
    # terms that no document or every document holds add nothing
    items = [(number, at[weights[at] > 0]) for number, at in items]
    items = [(number, at) for number, at in items if len(at)]
    weighed = vectors.where(F.size("terms") > 0).mapInArrow(
        _impacts(weights, documents, terms), "doc_id long, length double, terms array<int>, impacts array<long>")
    key = [F.col("length").desc(), F.monotonically_increasing_id()]
    ordered = weighed.repartitionByRange(*key).sortWithinPartitions(F.col("length").desc())
    with batches_of(spark, BUCKET):
        buckets = materialise(ordered.mapInArrow(
            _shards, "doc_id long, length double, terms array<int>, impacts array<long>, shard int"), "buckets")
    if not items:
        return spark.createDataFrame([], "item long, score long, doc_id long")
    columns = ["doc_id", "length", "terms", "impacts"]
    first = buckets.agg(F.min("shard")).first()[0]
    schema, none = "item long, score long, doc_id long", [0] * len(items)
    with batches_of(spark, BUCKET):
        seen = materialise(buckets.where(F.col("shard") == first).select(*columns).mapInArrow(
            _search(items, weights, none, k), schema), "first-bucket")
        # at most k rows an item of the block
        kth = {r["item"]: r["floor"] for r in seen.groupBy("item").agg(
            F.count("*").alias("n"), F.sort_array(F.collect_list("score"), asc=False).alias("scores"))
            .where(F.col("n") >= k).select("item", F.get("scores", F.lit(k - 1)).alias("floor")).collect()}
        floors = [kth.get(number, 0) for number, _ in items]
        shortest = min(f / (np.sqrt(len(t)) * SLACK) for f, (_, t) in zip(floors, items))
        rest = buckets.where((F.col("shard") != first) & (F.col("length") >= float(shortest)))
        others = materialise(rest.select(*columns).mapInArrow(
            _search(items, weights, floors, k), schema), "other-buckets")
    return seen.unionByName(others)


def ranked_search(items: DataFrame, docs: DataFrame, k: int = TOP, item_id: str = "item_id",
                  item_text: str = "text", id_col: str = "doc_id", text_col: str = "text",
                  terms_in_block: int = TERMS_IN_BLOCK) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` of the ``k`` best documents of each item."""
    spark = docs.sparkSession
    numbered = items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"),
                            F.col(item_text).alias("text"))
    asked = materialise(numbered.mapInArrow(_item_terms, "item long, item_id " + numbered.schema[
        "item_id"].dataType.simpleString() + ", terms array<long>"), "items")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // terms_in_block)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    results = []
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", "terms").collect()
        known = [np.array(r["terms"], dtype=np.int64).view(np.uint64) for r in own if r["terms"]]
        if not known:
            continue
        vocabulary = np.unique(np.concatenate(known))
        with batches_of(spark, ROWS_AT_ONCE):
            vectors = materialise(texts.mapInArrow(
                _counted(vocabulary), "doc_id long, n long, terms array<int>, tf array<long>"), "vectors")
        with batches_of(spark, BUCKET):
            results.append(_search_block(vectors, own, vocabulary, k))
    if not results:
        return asked.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
                            F.lit(0).cast("long").alias("score")).where("false")
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
