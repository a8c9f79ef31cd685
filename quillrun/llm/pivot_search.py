"""Exact top-k inner products by pivot-table elimination.

Every vector's distances to ``PIVOTS`` pivots are computed once. For a query q and a candidate x the
triangle inequality gives |q - x| >= max over pivots |d(q, p) - d(x, p)|, and since the inner product
is (|q|^2 + |x|^2 - |q - x|^2) / 2, that greatest lower bound is an upper bound on the score. A query
looks at candidates in the order of their bounds and stops when no bound left reaches its k-th score.

Candidates are cut by hash into slices of about ``SLICE`` vectors and queries into blocks; each is one
row of packed numbers, so the only thing copied is a block of queries, once per slice. A slice keeps k
rows a query; ranks over those (limited to k before the shuffle too) give the answer. Pivots are
rows of the table with the least hashes (at most ``PIVOTS`` vectors on the driver), filled up with
random vectors where a length has too few: any point is a valid pivot.

Defined cases: a vector that is null or holds a null, NaN or infinity takes no part, nor does a row
with a null id; rows that share an id, or an id and a vector, are candidates and queries of their own
each, and no query meets rows of its own id; vectors
are compared with those of their length only; ties go to the smaller id. A score beyond 64 bits is an
error. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrun.session import materialise

PIVOTS = 32
SLICE = 8192
QUERY_BLOCK = 2048
ROUNDS = (64, 1024)  # candidates looked at before the bounds are tested again

BLOCK = ("size int, block long, n int, ids binary, hashes binary, ints binary, squares binary, "
         "distances binary")
FOUND = "query_id long, query_hash long, vec_id long, score long"


def _pivot_points(rows: list[list[float]], size: int, scale: float) -> np.ndarray:
    points = [np.floor(np.asarray(r, dtype=np.float64) * scale) for r in rows if len(r) == size][:PIVOTS]
    spare = np.random.Generator(np.random.PCG64(size)).normal(size=(PIVOTS - len(points), size))
    norms = np.sqrt((spare * spare).sum(axis=1, keepdims=True))
    return np.array(points + list(scale * spare / np.maximum(norms, 1e-12))).reshape(PIVOTS, size)


def _blocks(rows: DataFrame, count: int, pivots: list[list[float]], scale: float) -> DataFrame:
    """Rows packed by (length, hash): ids ascending, integers, squared norms and pivot distances."""
    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id", kind="stable")
        size = int(key[0])
        ints = np.floor(np.array([np.asarray(v, dtype=np.float64) for v in frame["vector"]])
                        .reshape(len(frame), size) * scale)
        points = _pivot_points(pivots, size, scale)
        distances = np.stack([np.sqrt(((ints - p) ** 2).sum(axis=1)) for p in points])
        return pd.DataFrame([{
            "size": size, "block": key[1], "n": len(frame),
            "ids": frame["vec_id"].to_numpy(np.int64).tobytes(),
            "hashes": frame["hash"].to_numpy(np.int64).tobytes(), "ints": ints.tobytes(),
            "squares": (ints * ints).sum(axis=1).tobytes(),
            "distances": distances.astype(np.float32).tobytes()}])

    return (rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "hash"), F.lit(count)))
            .groupBy("size", "block").applyInPandas(build, BLOCK))


def _unpack(row: pd.Series, side: str) -> tuple[np.ndarray, ...]:
    n, size = int(row[f"{side}n"]), int(row["size"])
    read = lambda name, kind: np.frombuffer(row[f"{side}{name}"], dtype=kind)
    return (read("ids", np.int64), read("hashes", np.int64), read("ints", np.float64).reshape(n, size),
            read("squares", np.float64), read("distances", np.float32).reshape(PIVOTS, n))


def _scores(candidates: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    if query.dtype == object:
        exact = candidates @ query
        if len(exact) and max(abs(int(v)) for v in exact) >= 1 << 63:
            raise OverflowError("an inner product does not fit 64 bits")
        return exact.astype(np.int64)
    return (candidates @ query).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = np.flatnonzero(scores >= least)
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((ids[kept], -scores[kept]))][:k]


def search_slice(queries: tuple, candidates: tuple, k: int) -> pd.DataFrame:
    q_ids, q_hashes, q_ints, q_squares, q_distances = queries
    ids, _, ints, squares, distances = candidates
    reach = float(np.abs(ints).max(initial=0)) * float(np.abs(q_ints).max(initial=0)) * max(1, ints.shape[1])
    exact = reach < 2.0 ** 53
    if reach < 2.0 ** 24:
        ints, q_ints = ints.astype(np.float32), q_ints.astype(np.float32)
    elif not exact:
        whole = np.frompyfunc(int, 1, 1)
        ints, q_ints = whole(ints), whole(q_ints)
    out = []
    for i in range(len(q_ids)):
        if exact:
            mine = q_distances[:, i:i + 1]
            slack = 1e-5 * (distances.max(axis=0) + float(mine.max(initial=0)))  # of 32-bit distances
            far = np.maximum(np.abs(distances - mine).max(axis=0) - slack, 0).astype(np.float64)
            bound = np.floor((squares + q_squares[i] - far * far) / 2) + 1
        else:
            bound = np.full(len(ids), np.inf)
        bound[ids == q_ids[i]] = -np.inf
        open_ = np.flatnonzero(bound > -np.inf)
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for step in (*ROUNDS, len(ids)):
            if len(scores) >= k:
                reached = np.partition(scores, len(scores) - k)[len(scores) - k]
                open_ = open_[bound[open_] >= reached]
            if not len(open_):
                break
            if len(open_) > step:
                order = np.argpartition(-bound[open_], step)
                now, open_ = open_[order[:step]], open_[order[step:]]
            else:
                now, open_ = open_, open_[:0]
            found = np.append(found, now)
            few = 4 * len(now) < len(ids)  # else one product over the whole slice is faster
            scores = np.append(scores, _scores(ints[now], q_ints[i]) if few else _scores(ints, q_ints[i])[now])
        top = _best(scores, ids[found], k)
        out.append((np.full(len(top), q_ids[i]), np.full(len(top), q_hashes[i]), ids[found[top]], scores[top]))
    columns = [np.concatenate([o[c] for o in out]) if out else np.zeros(0, np.int64) for c in range(4)]
    return pd.DataFrame(dict(zip(("query_id", "query_hash", "vec_id", "score"), columns)))


def pivot_search(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0,
                 id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k greatest integer inner products of
    floor(scale * x) for every row of which ``is_query`` (over ``vec_id``) holds."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = materialise(
        vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                       F.col(vector_col).cast("array<double>").alias("vector"))
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite)
        .withColumn("hash", F.xxhash64("vector", F.monotonically_increasing_id()))  # each row's own
        .withColumn("size", F.size("vector")), "vectors")
    total = rows.count()
    asked = rows.where(is_query)
    pivots = [r[0] for r in rows.orderBy(F.xxhash64(F.lit(5), "vec_id", "hash"), "vec_id").limit(PIVOTS)
              .select("vector").collect()]
    slices = max(1, -(-total // SLICE))
    candidates = _blocks(rows, slices, pivots, scale)
    blocks = _blocks(asked, max(1, -(-asked.count() // QUERY_BLOCK)), pivots, scale)
    names = ["n", "ids", "hashes", "ints", "squares", "distances"]
    every = blocks.select("size", F.col("block").alias("q_block"), *[F.col(c).alias(f"q_{c}") for c in names],
                          F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("block"))
    cells = candidates.hint("shuffle_hash").join(every, ["size", "block"])

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([search_slice(_unpack(r, "q_"), _unpack(r, ""), k) for _, r in frame.iterrows()])

    found = cells.groupBy("size", "block", "q_block").applyInPandas(search, FOUND)
    best = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(f"rank <= {k}")
            .select("query_id", "rank", "vec_id", "score"))
