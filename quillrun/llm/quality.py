"""Naive Bayes support vectors: a linear hinge-loss model over scaled n-gram indicators.

A text's indicators are its byte 3-grams (hashed to ``GRAM_CELLS``) and 3-grams of word shapes:
length class, capitals, digits, signs, and whether the word repeats the one before. Each indicator is
scaled by the log ratio of its smoothed counts in the two classes; on the scaled, length-normalised
rows a hinge-loss model is fitted by dual coordinate descent, with the rarer class weighted up, and a
logistic curve over cross-validated margins turns a margin into a score between 0 and 1.

The model is fitted in one task on a bounded sample of labelled rows: about ``sample`` rows, chosen by
a hash of their id, and at most ``FEATURE_BUDGET`` indicators. Scoring is a map over all whole texts;
the model is a fixed 1.5 MB.

Defined cases: a null text is scored as the empty text; rows with a null label are not learnt from;
with no labelled rows, or one class only, every score is the smoothed share of label 1; of rows that
repeat an id one is learnt from; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillrun.llm import words

GRAM_CELLS = 1 << 17
SHAPE_CELLS = 1 << 16
CELLS = GRAM_CELLS + SHAPE_CELLS
SAMPLE_ROWS = 8000
FEATURE_BUDGET = 1 << 25
ROUNDS = 12
FOLDS = 4
BYTES_AT_ONCE = 1 << 18

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[48:58] = 1   # digits
_KIND[65:91] = 2   # capitals
_KIND[33:48] = 4   # signs
_KIND[58:65] = 4
_KIND[91:97] = 4
_KIND[123:127] = 4


def _shapes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """3-grams of word shapes, and where each text's start."""
    hashes, first = words.word_hashes(data, offsets)
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~words.IS_SPACE[data]
    begins = inside.copy()
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(begins)
    letters = np.cumsum(inside)[starts] - 1
    kinds = _KIND[data[inside]]
    lengths = np.diff(np.append(letters, len(kinds)))
    shape = np.minimum(lengths, 15) // 3
    for bit, kind in ((8, 1), (16, 2), (48, 4)):
        count = np.add.reduceat((kinds == kind).astype(np.int64), letters)
        shape = shape + (bit if kind != 4 else 0) * (count > 0)
        if kind == 2:
            shape = shape + 32 * (count > 1)
        if kind == 4:
            shape = shape + 64 * np.minimum(count, 3)
    again = np.zeros(len(hashes), dtype=np.int64)
    again[1:] = hashes[1:] == hashes[:-1]
    again[first[:-1][first[:-1] < len(hashes)]] = 0
    shape = (shape + 256 * again).astype(np.uint64)
    grams = shape * words.PLACE_VALUE[0]
    grams[1:] += shape[:-1] * words.PLACE_VALUE[1]
    grams[2:] += shape[:-2] * words.PLACE_VALUE[2]
    return (words.mix(grams) >> np.uint64(48)).astype(np.int64) + GRAM_CELLS, first


def indicators(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text the sorted cells of its n-grams."""
    data, offsets = words.text_bytes(column)
    seen = np.zeros(CELLS, dtype=bool)
    for a, b in words.cut(offsets, BYTES_AT_ONCE):
        part, at = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        wide = part.astype(np.uint32)
        grams = np.zeros(max(0, len(part) - 2), dtype=np.uint32)
        if len(grams):
            grams = (((wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:])
                     * np.uint32(2654435761)) >> np.uint32(15)
        shapes, first = _shapes(part, at)
        for i in range(b - a):
            own = grams[at[i]:max(at[i], at[i + 1] - 2)]
            seen[own] = True
            lo, hi = first[i] + 2, first[i + 1]  # whole 3-grams of this text's own words
            if hi > lo:
                seen[shapes[lo:hi]] = True
            cells = np.flatnonzero(seen).astype(np.int32)
            seen[cells] = False
            yield cells


def _descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Dual coordinate descent for the L1 hinge loss (Hsieh et al. 2008); last weight is the bias."""
    weights = np.zeros(CELLS + 1)
    alpha = np.zeros(len(rows))
    scaled = [ratio[r] / max(1e-9, float(np.sqrt((ratio[r] ** 2).sum()))) for r in rows]
    size = np.array([float((s * s).sum()) + 1.0 for s in scaled])
    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(ROUNDS):
        for i in order.permutation(len(rows)):
            gradient = y[i] * (weights[rows[i]] @ scaled[i] + weights[-1]) - 1.0
            new = min(max(alpha[i] - gradient / size[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                weights[rows[i]] += step * scaled[i]
                weights[-1] += step
                alpha[i] = new
    return weights


def _ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    ratio = np.zeros(CELLS)
    for label, sign in ((1.0, 1.0), (-1.0, -1.0)):
        counts = np.ones(CELLS)
        for r, own in zip(rows, y):
            if own == label:
                counts[r] += 1.0
        ratio += sign * np.log(counts / counts.sum())
    return ratio


def _margin(cells: np.ndarray, ratio: np.ndarray, weights: np.ndarray) -> float:
    own = ratio[cells]
    return float(weights[cells] @ own / max(1e-9, float(np.sqrt(own @ own))) + weights[-1])


def _curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve through margins (Platt's smoothed targets)."""
    up, down = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (up + 1.0) / (up + 2.0), 1.0 / (down + 2.0))
    x = np.stack([margins, np.ones(len(y))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        beta = beta - np.linalg.solve(hessian, x.T @ (p - target) + 1e-6 * beta)
    return float(beta[0]), float(beta[1])


def fit_rows(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0) -> dict:
    """The model: ``weights`` per cell, ``bias``, ``slope``, ``intercept`` and ``prior``."""
    prior = float((labels == 1).sum() + 1) / (len(labels) + 2)
    if len(set(labels.tolist())) < 2:
        return {"prior": prior, "weights": b"", "ratio": b"", "bias": 0.0, "slope": 0.0, "intercept": 0.0}
    y = np.where(labels == 1, 1.0, -1.0)
    share = (y > 0).mean()
    costs = np.where(y > 0, cost * min(1.0, (1 - share) / share), cost * min(1.0, share / (1 - share)))
    margins = np.zeros(len(y))
    fold = np.arange(len(y)) % FOLDS
    for k in range(FOLDS):
        there = np.flatnonzero(fold != k)
        if len(set(y[there].tolist())) < 2:
            continue
        ratio = _ratio([rows[i] for i in there], y[there])
        weights = _descend([rows[i] for i in there], y[there], ratio, costs[there])
        for i in np.flatnonzero(fold == k):
            margins[i] = _margin(rows[i], ratio, weights)
    slope, intercept = _curve(margins, y)
    ratio = _ratio(rows, y)
    weights = _descend(rows, y, ratio, costs)
    return {"prior": prior, "weights": weights[:-1].astype("<f4").tobytes(),
            "ratio": ratio.astype("<f4").tobytes(), "bias": float(weights[-1]),
            "slope": slope, "intercept": intercept}


MODEL = T.StructType([
    T.StructField("prior", T.DoubleType()), T.StructField("weights", T.BinaryType()),
    T.StructField("ratio", T.BinaryType()), T.StructField("bias", T.DoubleType()),
    T.StructField("slope", T.DoubleType()), T.StructField("intercept", T.DoubleType())])


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS, id_col: str = "doc_id",
                text_col: str = "text", label_col: str = "quality", budget: int = FEATURE_BUDGET) -> dict:
    """Fit on a bounded sample of the rows of ``docs`` whose id ``labels`` marks 0 or 1.

    The sample is about ``sample`` ids with at most ``budget`` indicators in all, both drawn by a hash
    of the id. Of rows that share an id, that of the least text digest (then label) is learnt, so a
    table gives one model however it is laid out.
    """
    marked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
              .where("id IS NOT NULL AND label IN (0, 1)"))
    count = marked.count()
    scale = 1 << 24
    share = int(scale * min(1.0, sample / max(1, count)))
    chosen = marked.where(F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(scale)) < share)
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), "id"))  # about `sample` rows of an id and a label
    first = F.struct(F.sha2(F.coalesce("text", F.lit("")), 256), "label")
    texts = rows.groupBy("id").agg(F.min_by(F.struct("text", "label"), first).alias("one")).select("id", "one.*")

    def cells(batches):
        for batch in batches:
            kept = [c.tobytes() for c in indicators(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.int64()), batch.column("label").cast(pa.int32()),
                 pa.array(kept, pa.binary())], names=["id", "label", "cells"])

    found = texts.mapInArrow(cells, "id long, label int, cells binary")

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        drawn = words.mix(frame["id"].to_numpy().astype(np.int64).view(np.uint64))
        frame = frame.iloc[np.argsort(drawn, kind="stable")]
        frame = frame[frame["cells"].map(len).cumsum() // 4 <= budget].sort_values("id", kind="stable")
        rows = [np.frombuffer(c, dtype=np.int32) for c in frame["cells"]]
        return pd.DataFrame([fit_rows(rows, frame["label"].to_numpy())])

    fitted = found.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fit, MODEL).collect()
    return fitted[0].asDict() if fitted else fit_rows([], np.zeros(0))


def scorer(model: dict) -> Callable[[pa.Array], np.ndarray]:
    weights = np.frombuffer(model["weights"], dtype="<f4").astype(np.float64)
    ratio = np.frombuffer(model["ratio"], dtype="<f4").astype(np.float64)
    whole = np.append(weights, model["bias"]) if len(weights) else weights

    def score(column: pa.Array) -> np.ndarray:
        if not len(weights):
            return np.full(len(column), model["prior"])
        margins = np.array([_margin(c, ratio, whole) for c in indicators(column)])
        return 1.0 / (1.0 + np.exp(-np.clip(model["slope"] * margins + model["intercept"], -30, 30)))

    return score


def score_quality(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``score`` and ``predicted`` (1 if the score is at least 0.5) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = scorer(shared.value)
        for batch in batches:
            scores = score(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.int64()), pa.array(scores, pa.float64()),
                 pa.array((scores >= 0.5).astype(np.int32))], names=["id", "score", "predicted"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "id long, score double, predicted int"))


def keep_good(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        score = scorer(shared.value)
        for batch in batches:
            yield batch.filter(pa.array(score(batch.column(at)) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
