"""Duplicates and clusters among embeddings."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun.functions.vectors import as_doubles, finite, norm
from quillrun.operators.search import matrix, unit_rows
from quillrun.session import materialise

MOST_PIVOTS = 4_096
PIVOT_BYTES = 16_000_000     # what a task holds of pivots
BLOCK_ROWS = 16_384
BLOCK_BYTES = 32_000_000     # what a task holds of candidates
LOW_BLOCKS = 16              # blocks of lowest ids that every vector is compared with first
RINGS = 32
PROBES = 256                 # sampled rows that the cost of a cover is counted on
COPY_COST = 1_000            # a row shuffled, in comparisons
SCORES_AT_ONCE = 4_000_000
ROWS_AT_ONCE = 512
SLACK = 1e-7                 # above the rounding of a distance


def cluster(df: DataFrame, k: int, vector: str = "embedding", seed: int = 42,
            max_iter: int = 20, tol: float = 1e-4) -> DataFrame:
    """Rows with their k-means cluster. The model labels each row in place, so nothing is joined.

    A row without a usable vector (NULL, empty, with a NULL, NaN or infinite part, or not as long as
    most) stays, with a NULL cluster.
    """
    usable = finite(as_doubles(F.col(vector)))
    lengths = df.where(usable).groupBy(F.size(vector).alias("size")).count()
    most = lengths.orderBy(F.desc("count"), "size").first()
    if most is None:
        return df.withColumn("cluster", F.lit(None).cast("int"))
    whole = usable & (F.size(vector) == most["size"])
    features = df.where(whole).withColumn("__x", array_to_vector(as_doubles(F.col(vector))))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, tol=tol, featuresCol="__x",
                   predictionCol="cluster").fit(features)
    rest = df.where(~F.coalesce(whole, F.lit(False))).withColumn("cluster", F.lit(None).cast("int"))
    return model.transform(features).drop("__x").unionByName(rest)


def _unit(vector: Column) -> Column:
    length = norm(vector)
    return F.when(length > 0, F.transform(vector, lambda x: x / length))


def exact_copies(df: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vector, first id, copies) of each distinct vector; copies combine before the shuffle."""
    return df.where(F.col(vector).isNotNull()).groupBy(vector).agg(
        F.min(id).alias(id), F.count(F.lit(1)).alias("copies"))


def _squares(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Squared distances of unit rows to unit pivots."""
    return np.maximum(0.0, 2 - 2 * rows @ pivots.T)


def _open(rows: np.ndarray, pivots: np.ndarray, radii: np.ndarray, reach: float
          ) -> tuple[np.ndarray, np.ndarray]:
    """Distances of rows to pivots, and which cells can hold a vector within ``reach`` of each row.

    A cell is closed to a row that is farther from its pivot than the cell's radius and the reach, and
    to one that is farther than the reach from the plane between the cell's pivot and the row's own.
    """
    square = _squares(rows, pivots)
    home = square.argmin(axis=1)
    far, reach = np.sqrt(square), reach + SLACK
    apart = np.sqrt(_squares(pivots[home], pivots))
    beyond = square - square[np.arange(len(rows)), home][:, None]
    return far, (far <= radii + reach) & ((beyond <= 2 * reach * apart) | (apart < 1e-3))


def _nearest(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest pivot and the distance to it; no more than ``ROWS_AT_ONCE`` rows of distances exist."""
    home, near = np.zeros(len(rows), np.int32), np.zeros(len(rows))
    for at in range(0, len(rows), ROWS_AT_ONCE):
        square = _squares(rows[at:at + ROWS_AT_ONCE], pivots)
        home[at:at + ROWS_AT_ONCE] = square.argmin(axis=1)
        near[at:at + ROWS_AT_ONCE] = np.sqrt(square.min(axis=1))
    return home, near


def _home(pivots: np.ndarray):
    """The cell of a unit vector, which is that of its nearest pivot, and the distance to it."""
    @F.arrow_udf("struct<home:int,near:double>")
    def place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            home, near = _nearest(matrix(batch, pivots.shape[1]), pivots)
            yield pa.StructArray.from_arrays([pa.array(home), pa.array(near)], ["home", "near"])

    return place


def _reached(pivots: np.ndarray, radii: np.ndarray, reach: float):
    """The cells that can hold a vector within ``reach``, each with the distance to its pivot."""
    @F.arrow_udf("array<struct<cell:int,far:double>>")
    def place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = matrix(batch, pivots.shape[1])
            counts, cells, distances = [np.zeros(1, np.int64)], [], []
            for at in range(0, len(rows), ROWS_AT_ONCE):
                far, open_ = _open(rows[at:at + ROWS_AT_ONCE], pivots, radii, reach)
                counts.append(open_.sum(axis=1))
                cells.append(np.nonzero(open_)[1].astype(np.int32))
                distances.append(far[open_])
            met = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(cells or [np.zeros(0, np.int32)])),
                 pa.array(np.concatenate(distances or [np.zeros(0)]))], ["cell", "far"])
            yield pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(counts)).astype(np.int32)), met)

    return place


def _spread(pool: np.ndarray, most: int, apart: float) -> np.ndarray:
    """Rows of ``pool``, each the farthest from those before it, until the next is within ``apart`` of one."""
    order, near = [0], _squares(pool, pool[:1])[:, 0]
    while len(order) < most and near.max() > apart * apart:
        order.append(int(near.argmax()))
        near = np.minimum(near, _squares(pool, pool[order[-1:]])[:, 0])
    return pool[order]


def cover(pool: np.ndarray, total: int, reach: float, block_rows: int, most: int) -> np.ndarray:
    """Pivots out of ``pool``, a sample of the unit vectors: as many as make the work least.

    More pivots leave fewer candidates to compare and copy a probe to more cells. Both are counted on the
    sample, for ever larger sets of pivots, so vectors in groups get a cover that grows with the table, and
    vectors without any, on which bounds hardly tell cells apart, get few. It steers work, never the result.
    """
    probes = pool[-PROBES:]
    centres = _spread(pool, max(1, min(most, len(pool) // 4)), reach)
    least, chosen, wanted = math.inf, centres[:1], 1
    while wanted < 4 * len(centres):
        pivots = centres[:wanted]
        count = len(pivots)
        home, near = _nearest(pool, pivots)
        radii = np.zeros(count)
        np.maximum.at(radii, home, near)
        rows = np.bincount(home, minlength=count) * (total / len(pool))
        open_ = _open(probes, pivots, radii, reach)[1]
        cost = (open_ @ (rows + COPY_COST * np.ceil(rows / block_rows))).mean() + 3 * count
        if cost < least:
            least, chosen = cost, pivots
        wanted *= 4
    return chosen


def _first_match(id: str, threshold: float):
    """Streams sorted (block, candidates then probes) rows; keeps one block of candidates."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, ids, rows = None, [], []
        matrix = names = None
        for frame in frames:
            for key, part in frame.groupby(["cell", "slice", "lane"], sort=False):
                if key != block:
                    block, ids, rows, matrix = key, [], [], None
                candidates = part[~part["probe"]]
                if len(candidates):
                    ids.append(candidates[id].to_numpy())
                    rows.append(np.stack(candidates["u"].to_numpy()))
                    matrix = None
                probes = part[part["probe"]]
                if not len(probes) or not ids:
                    continue
                if matrix is None:
                    names, matrix = np.concatenate(ids), np.concatenate(rows)
                    order = np.argsort(names, kind="stable")
                    names, matrix = names[order], matrix[order]
                step = max(1, SCORES_AT_ONCE // len(names))
                for at in range(0, len(probes), step):
                    some = probes.iloc[at:at + step]
                    probe_ids = some[id].to_numpy()
                    scores = np.stack(some["u"].to_numpy()) @ matrix.T
                    hit = (scores >= threshold) & (names[None, :] < probe_ids[:, None])
                    found = hit.any(axis=1)
                    if found.any():
                        first = hit.argmax(axis=1)[found]
                        yield pd.DataFrame({id: probe_ids[found], "duplicate_of": names[first]})
    return run


def _low_cut(distinct: DataFrame, id: str, wanted: int, total: int):
    """An id with about ``wanted`` ids at or below it. It steers work, never the result."""
    sample = 1_000
    share = min(1.0, sample / total)
    ids = distinct.select(id) if share == 1.0 else distinct.select(id).sample(share, 17)
    drawn = [r[0] for r in ids.orderBy(id).collect()]  # about `sample` of them
    if not drawn:
        drawn = [distinct.agg(F.min(id)).first()[0]]
    return drawn[min(len(drawn) - 1, len(drawn) * wanted // total)]


def _meetings(candidates: DataFrame, probes: DataFrame, id: str, reach: float, block_rows: int) -> DataFrame:
    """Candidates and probes in the blocks where they meet: ``cell``, ``slice`` and ``lane``.

    A cell's candidates are cut into rings by their distance to the pivot, of about ``block_rows`` each
    (at most ``RINGS``, and these by hash into parts); a probe goes to the rings that its own distance to
    the pivot leaves open. Probes are cut into lanes, and candidates go to every lane of their slice.
    """
    tried = probes.select(id, "u", F.explode("cells").alias("at")).select(id, "u", "at.cell", "at.far")
    rings = F.greatest(F.lit(1), F.least(F.lit(RINGS), F.ceil(F.col("c") / block_rows))).cast("int")
    cut = F.percentile_approx("near", F.array(*[F.lit(i / RINGS) for i in range(1, RINGS)]), 1_000)
    held = candidates.groupBy(F.col("home").alias("cell")).agg(F.count(F.lit(1)).alias("c"), cut.alias("cut"))
    sized = held.join(tried.groupBy("cell").agg(F.count(F.lit(1)).alias("p")), "cell") \
        .withColumn("rings", rings).select(
            "cell", "rings",
            F.filter("cut", lambda _, i: F.floor((i + 1) * F.col("rings") / RINGS)
                     > F.floor(i * F.col("rings") / RINGS)).alias("cuts"),  # rings - 1 of them
            F.greatest(F.lit(1), F.ceil(F.col("c") / (F.col("rings") * block_rows))).cast("int").alias("parts"),
            F.greatest(F.lit(1), F.ceil(F.col("p") / (16 * block_rows))).cast("int").alias("lanes"))
    sized = F.broadcast(materialise(sized, "cells"))  # one row per pivot, at most RINGS numbers each

    def ring(distance: Column) -> Column:
        return F.size(F.filter("cuts", lambda c: c < distance))

    def some(n: str) -> Column:
        return F.pmod(F.xxhash64(id), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def slice_of(ring: Column, part: Column) -> Column:
        return ring * F.col("parts") + part

    stay = candidates.withColumnRenamed("home", "cell").join(sized, "cell").select(
        "cell", slice_of(ring(F.col("near")), some("parts")).alias("slice"), every("lanes").alias("lane"),
        F.lit(False).alias("probe"), id, "u")
    span = F.sequence(ring(F.col("far") - (reach + SLACK)) * F.col("parts"),
                      (ring(F.col("far") + (reach + SLACK)) + 1) * F.col("parts") - 1)
    go = tried.join(sized, "cell").select(
        "cell", F.explode(span).alias("slice"), some("lanes").alias("lane"),
        F.lit(True).alias("probe"), id, "u")
    return stay.unionAll(go)


def _lowest_match(candidates: DataFrame, probes: DataFrame, id: str, threshold: float,
                  reach: float, block_rows: int) -> DataFrame:
    """For each probe, the lowest candidate id that is below its own and similar enough.

    A task holds one slice of a cell's candidates and streams a lane of probes past it.
    """
    id_type = candidates.schema[id].dataType.simpleString()
    return _meetings(candidates, probes, id, reach, block_rows).repartition("cell", "slice", "lane") \
        .sortWithinPartitions("cell", "slice", "lane", "probe") \
        .mapInPandas(_first_match(id, threshold), f"`{id}` {id_type}, duplicate_of {id_type}") \
        .groupBy(id).agg(F.min("duplicate_of").alias("duplicate_of"))


def near_duplicates(df: DataFrame, threshold: float = 0.95, id: str = "vec_id",
                    vector: str = "embedding", pivots: int | None = None,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, duplicate_of): each vector that has an earlier one with cosine >= ``threshold``.

    ``duplicate_of`` is the lowest such id, so there is at most one row per vector however many
    copies a group holds, and no pair is ever emitted. Exact, in four steps:

    * identical vectors collapse to their first id (partial aggregation, no hot group),
    * distinct vectors go to the cell of their nearest pivot and are compared only with cells, and
      rings within cells, that their bounds leave open. ``cover`` chooses the pivots (``pivots`` sets
      their number),
    * all are compared with the lowest ids first. A vector matched there is done, because every
      other candidate has a higher id; so the members of a large group of near copies leave here,
    * the rest are compared with the remaining candidates.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    # vectors are alike only with vectors as long as they are; unusable ones are alike with none
    rows = df.select(id, as_doubles(F.col(vector)).alias("v")).where(finite(F.col("v")))
    first = materialise(exact_copies(rows, id, "v").withColumn("u", _unit(F.col("v"))), "distinct")
    directions = first.where("u is not null")
    counts = {r["size"]: r["n"] for r in directions.groupBy(F.size("u").alias("size"))
              .agg(F.count(F.lit(1)).alias("n")).orderBy("size").collect()}
    n_rows = first.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    lowest = None  # without any direction only identical vectors are left to find
    for size, total in counts.items():  # a table holds vectors of few models, each of one length
        found = _matches(directions.where(F.size("u") == size).select(id, "u"), total, threshold, id, pivots,
                         block_rows)
        lowest = found if lowest is None else lowest.unionAll(found)
    return _with_copies(rows, first, lowest, n_rows, id)


def _sample(distinct: DataFrame, id: str, total: int, wanted: int) -> np.ndarray:
    """About ``wanted`` unit vectors (never more), the same ones whatever the layout."""
    parts = 1 << 30
    share = min(1.0, wanted / total)
    mark = F.pmod(F.xxhash64(id, F.lit("pivot")), F.lit(parts))
    rows = distinct.where(mark < F.lit(math.ceil(share * parts))).select(mark.alias("mark"), "u").collect()
    if not rows:
        rows = distinct.select(mark.alias("mark"), "u").limit(1).collect()
    rows.sort(key=lambda r: (r["mark"], r["u"]))
    return unit_rows(np.array([r["u"] for r in rows[:wanted]]))


def _matches(distinct: DataFrame, total: int, threshold: float, id: str, pivots: int | None,
             block_rows: int) -> DataFrame:
    """The lowest similar id of each distinct vector that has one."""
    size = distinct.select(F.size("u")).first()[0]
    threshold -= 1e-12
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    block_rows = min(block_rows, max(1, BLOCK_BYTES // (8 * size)))
    most = min(pivots or MOST_PIVOTS, max(1, PIVOT_BYTES // (8 * size)))
    if pivots is None:
        centres = cover(_sample(distinct, id, total, 4 * most), total, reach, block_rows, most)
    else:
        centres = _sample(distinct, id, total, most)
    homes = materialise(distinct.withColumn("at", _home(centres)("u")).select(
        id, "u", "at.home", "at.near"), "homes")
    radii = np.zeros(len(centres))
    for row in homes.groupBy("home").agg(F.max("near").alias("radius")).collect():  # one row per pivot
        radii[row["home"]] = row["radius"]
    placed = materialise(homes.withColumn("cells", _reached(centres, radii, reach)("u")), "open")

    low_rows = LOW_BLOCKS * block_rows
    if total <= low_rows:
        return materialise(_lowest_match(homes, placed, id, threshold, reach, block_rows), "lowest")
    cut = _low_cut(distinct, id, low_rows, total)
    low, high = homes.where(F.col(id) <= F.lit(cut)), homes.where(F.col(id) > F.lit(cut))
    early = materialise(_lowest_match(low, placed, id, threshold, reach, block_rows), "early")
    late = _lowest_match(high, placed.join(early.select(id), id, "left_anti"), id, threshold, reach, block_rows)
    return materialise(early.unionAll(late), "lowest")


def _with_copies(rows: DataFrame, first: DataFrame, lowest: DataFrame | None, n_rows: int,
                 id: str) -> DataFrame:
    """Matches for every row: a copy has its group's match, or else the group's first vector."""
    groups = first.select(F.col(id).alias("__first"), "v", "copies")
    if lowest is None:
        groups = groups.withColumn("duplicate_of", F.lit(None).cast(first.schema[id].dataType))
    else:
        groups = groups.join(lowest.withColumnRenamed(id, "__first"), "__first", "left")
    lone = groups.where("copies = 1 and duplicate_of is not null").select(
        F.col("__first").alias(id), "duplicate_of")
    repeated = groups.where("copies > 1")
    # at most 1000 vectors can each hold over a thousandth of the rows: small enough to broadcast
    hot_copies = F.lit(n_rows // 1000)
    hot = F.broadcast(repeated.where(F.col("copies") > hot_copies))
    cold = repeated.where(F.col("copies") <= hot_copies)
    members = rows.join(hot, "v").unionByName(
        rows.join(hot.select("v"), "v", "left_anti").join(cold, "v"))
    copied = members.select(
        id, F.coalesce("duplicate_of", F.when(F.col(id) != F.col("__first"), F.col("__first")))
        .alias("duplicate_of")).where("duplicate_of is not null")
    return lone.unionAll(copied)
