"""Cosine top-k of a query set against a corpus of vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillrun.functions.vectors import as_doubles, finite
from quillrun.session import materialise

# A block of query vectors is broadcast; a larger query set is cut into blocks of this size.
QUERY_BLOCK_BYTES = 16_000_000
QUERY_OVERHEAD = 64
SCORES_AT_ONCE = 4_000_000
SCORE_DIGITS = 9
SLICE_ROWS = 16_384


def matrix(vectors: pa.Array, size: int) -> np.ndarray:
    """Rows of a list array, all ``size`` long, as a dense matrix."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), size)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, lengths, out=np.zeros_like(rows), where=lengths > 0)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the lowest id."""
    if len(scores) > k:
        floor = np.partition(scores, -k)[-k]
        places = np.flatnonzero(scores >= floor)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def _search_block(corpus: DataFrame, queries: list, size: int, k: int, id: str, vector: str,
                  query_field: T.StructField) -> DataFrame:
    context = corpus.sparkSession.sparkContext
    wanted = unit_rows(np.array([q[1] for q in queries], dtype=float).reshape(-1, size))
    shared = context.broadcast((np.array([q[0] for q in queries]), wanted))
    schema = T.StructType([
        T.StructField("query_no", T.IntegerType()), corpus.schema[id],
        T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, targets = shared.value
        step = max(1, SCORES_AT_ONCE // len(names))
        kept: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(names)
        floor = np.full(len(names), -np.inf)  # the k-th best score so far
        for batch in batches:
            ids = batch.column(id).to_numpy(zero_copy_only=False)
            rows = matrix(batch.column(vector), size)
            # a zero vector has no direction: it is near nothing
            usable = np.flatnonzero(np.linalg.norm(rows, axis=1) > 0)
            ids, rows = ids[usable], unit_rows(rows[usable])
            for at in range(0, len(ids), step):
                some = ids[at:at + step]
                scores = np.round(rows[at:at + step] @ targets.T, SCORE_DIGITS)
                for q in np.flatnonzero((scores >= floor).any(axis=0)):
                    places = np.flatnonzero(scores[:, q] >= floor[q])
                    found_ids, found = some[places], scores[places, q]
                    if kept[q] is not None:
                        found_ids = np.concatenate([kept[q][0], found_ids])
                        found = np.concatenate([kept[q][1], found])
                    top = best(found, found_ids, k)
                    kept[q] = found_ids[top], found[top]
                    if len(top) == k:
                        floor[q] = found[top[-1]]
        for q, best_of in enumerate(kept):
            if best_of is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best_of[0]), q, np.int32)), pa.array(best_of[0]),
                     pa.array(best_of[1])], ["query_no", id, "score"])

    found = corpus.select(id, as_doubles(F.col(vector)).alias(vector)).mapInArrow(run, schema)
    ranked = Window.partitionBy("query_no").orderBy(F.desc("score"), id)
    numbers = corpus.sparkSession.createDataFrame(
        [(i, q[0]) for i, q in enumerate(queries)],
        T.StructType([T.StructField("query_no", T.IntegerType()), query_field]))
    query_id = query_field.name
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k) \
        .join(F.broadcast(numbers), "query_no").drop("query_no") \
        .select(query_id, "rank", id, "score")


def odd_vectors(corpus: DataFrame, size: int, id: str = "vec_id", vector: str = "embedding"
                ) -> DataFrame:
    """(id, reason) of rows whose vector can't be compared with vectors of ``size`` numbers."""
    numbers = as_doubles(F.col(vector))
    reason = F.when(numbers.isNull(), "missing") \
        .when(F.size(numbers) != size, F.concat(F.lit("size "), F.size(numbers).cast("string"))) \
        .when(~finite(numbers), "not finite")
    return corpus.select(id, reason.alias("reason")).where("reason IS NOT NULL")


def _comparable(corpus: DataFrame, size: int, id: str, vector: str, on_odd: str) -> DataFrame:
    """Rows with a vector; odd ones raise when they are read, or are left out."""
    numbers = as_doubles(F.col(vector))
    fits = finite(numbers) & (F.size(numbers) == size)
    if on_odd == "leave_out":
        return corpus.where(numbers.isNotNull() & fits)
    refuse = F.raise_error(F.concat(F.lit("the vector of "), F.col(id).cast("string"),
                                    F.lit(f" is not {size} finite numbers")))
    return corpus.where(F.col(vector).isNotNull()).select(
        id, F.when(fits, numbers).otherwise(refuse.cast("array<double>")).alias(vector))


def semantic_search(queries: DataFrame, corpus: DataFrame, k: int = 5, id: str = "vec_id",
                    vector: str = "embedding", query_id: str = "query_id",
                    query_vector: str = "embedding", block_bytes: int = QUERY_BLOCK_BYTES,
                    on_odd: str = "fail") -> DataFrame:
    """The ``k`` corpus vectors nearest to each query by cosine, ties to the lowest id.

    The corpus is read in place, scored a batch at a time against a block of query vectors, and
    each task passes on only its own best ``k`` per query. Query sets above ``block_bytes`` meet the
    corpus, which is still read once, in cells of a block of them and a slice of it. A corpus row without a vector is left
    out; one of another size, or with a NULL, NaN or infinite part, raises, or is left out with
    ``on_odd="leave_out"`` (``odd_vectors`` lists them). Such a query always raises.
    """
    if k < 1:
        raise ValueError("k must be a positive integer")
    if on_odd not in ("fail", "leave_out"):
        raise ValueError("on_odd must be 'fail' or 'leave_out'")
    vectors = queries.select(query_id, as_doubles(F.col(query_vector)).alias("__q")) \
        .where(F.col("__q").isNotNull())
    shape = vectors.agg(F.count(F.lit(1)), F.min(F.size("__q")), F.max(F.size("__q")),
                        F.count_if(~finite(F.col("__q")))).first()
    total, size = shape[0], shape[2] or 0
    query_field = queries.schema[query_id]
    spark = corpus.sparkSession
    if not total:
        return spark.createDataFrame([], T.StructType([
            query_field, T.StructField("rank", T.IntegerType()), corpus.schema[id],
            T.StructField("score", T.DoubleType())]))
    if shape[1] != size or shape[3]:
        raise ValueError("every query needs a vector of finite numbers, all of one size")
    corpus = _comparable(corpus, size, id, vector, on_odd)
    blocks = math.ceil(total * (size * 8 + QUERY_OVERHEAD) / block_bytes)
    if blocks <= 1:
        return _search_block(corpus, vectors.collect(), size, k, id, vector, query_field)
    return _search_cells(corpus, vectors, size, k, id, vector, query_field, blocks)


def _search_cells(corpus: DataFrame, vectors: DataFrame, size: int, k: int, id: str, vector: str,
                  query_field: T.StructField, blocks: int) -> DataFrame:
    """Many queries: the corpus is read once and cut into slices, the queries into blocks; both are
    packed, one row each, and every block goes to every slice. A slice keeps ``k`` rows a query."""
    query_id, spark = query_field.name, corpus.sparkSession
    # a block has nothing to do with the id, so that repeated ids spread too
    numbered = materialise(vectors.withColumn("query_no", F.monotonically_increasing_id()), "queries")
    rows = corpus.select(id, as_doubles(F.col(vector)).alias(vector))
    slices = max(1, -(-corpus.count() // SLICE_ROWS))

    def pack(frame: pd.DataFrame, group: str, names: list[str], numbers: str) -> pd.DataFrame:
        units = unit_rows(np.array(frame[numbers].tolist(), dtype=float).reshape(-1, size))
        return pd.DataFrame([{group: frame[group].iloc[0], **{f"{n}s": frame[n].tolist() for n in names},
                              f"{group}_units": units.tobytes()}])

    id_type, query_type = (x.simpleString() for x in (corpus.schema[id].dataType, query_field.dataType))
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64(id, vector), F.lit(slices))).groupBy("slice") \
        .applyInPandas(lambda f: pack(f, "slice", [id], vector),
                       f"slice long, `{id}s` array<{id_type}>, slice_units binary")
    packed = numbered.withColumn("block", F.pmod(F.xxhash64("query_no"), F.lit(blocks))).groupBy("block") \
        .applyInPandas(lambda f: pack(f, "block", ["query_no", query_id], "__q"),
                       f"block long, query_nos array<long>, `{query_id}s` array<{query_type}>, "
                       "block_units binary")
    every = packed.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"),
                                                            F.lit(slices - 1).cast("long"))))

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        cell = frame.iloc[0]
        ids = np.array(cell[f"{id}s"])
        units = np.frombuffer(cell["slice_units"]).reshape(-1, size)
        targets = np.frombuffer(cell["block_units"]).reshape(-1, size)
        usable = np.linalg.norm(units, axis=1) > 0  # a zero vector is near nothing
        ids, units = ids[usable], units[usable]
        found = []
        for number, name, target in zip(cell["query_nos"], cell[f"{query_id}s"], targets):
            scores = np.round(units @ target, SCORE_DIGITS)
            top = best(scores, ids, k)
            found.append(pd.DataFrame({"query_no": number, query_id: name, id: ids[top], "score": scores[top]}))
        return pd.concat(found)

    cells = sliced.hint("merge").join(every, "slice").groupBy("slice", "block").applyInPandas(
        search, f"query_no long, `{query_id}` {query_type}, `{id}` {id_type}, score double")
    ranked = Window.partitionBy("query_no").orderBy(F.desc("score"), id)
    return cells.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k) \
        .select(query_id, "rank", id, "score")
