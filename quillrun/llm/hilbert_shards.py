"""Shards along a Hilbert curve through metadata (DataFrame functions only).

Each dimension is quantised to ``BITS`` bits, rows are ordered by the index of their cell on the
Hilbert curve, and the order is cut into shards whose row counts differ by one at most. Rows that are
alike in several dimensions lie together, so a file's minima and maxima let a reader skip most files
whichever dimension it filters on.

Positions need no task that sees all rows: rows are counted per cell, a cell is cut into buckets of
equal texts' order, and a prefix sum over the counts of buckets (at most ``MAX_BUCKETS`` and the
cells, hence broadcast) plus the place inside a bucket is the position.

Defined cases: a null text counts as empty; a null dimension has code 0; equal texts of a cell lie
next to each other, and a bucket with far too many rows is cut by id; rows alike in everything follow
each other in any order; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrun.session import materialise

BITS = 6
ROWS_PER_BUCKET = 512
MAX_BUCKETS = 65536


def by_name(column: str) -> Column:
    """Code of a name: the same name has the same code everywhere; null has 0."""
    return F.when(F.col(column).isNull(), 0).otherwise(
        1 + F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit((1 << BITS) - 1))).cast("int")


def by_size(column: Column) -> Column:
    """Code of a count on a scale of four steps a doubling; null has 0."""
    step = F.floor(4 * F.log2(1 + F.greatest(column, F.lit(0)).cast("double")))
    return F.coalesce(F.least(step, F.lit((1 << BITS) - 1)), F.lit(0)).cast("int")


def hilbert_index(axes: list[str], bits: int = BITS) -> Column:
    """Index on the Hilbert curve of the point with these integer coordinates.

    The published transform (Skilling 2004): undo the curve's excess rotations from the highest bit
    down, Gray-code, then interleave the bits. Coordinates are an array that `aggregate` folds over.
    """
    n = len(axes)
    swap = ("transform(x, (v, j) -> CASE WHEN s.i = 0 THEN IF(j = 0 AND (x[0] & s.q) <> 0, v ^ (s.q - 1), v) "
            "WHEN (x[s.i] & s.q) <> 0 THEN IF(j = 0, v ^ (s.q - 1), v) "
            "WHEN j = 0 OR j = s.i THEN v ^ ((x[0] ^ x[s.i]) & (s.q - 1)) ELSE v END)")
    steps = ", ".join(f"named_struct('q', {1 << b}, 'i', {i})" for b in range(bits - 1, 0, -1) for i in range(n))
    point = f"array({', '.join(axes)})"
    undone = f"aggregate(array({steps}), {point}, (x, s) -> {swap})"
    gray = (f"aggregate(sequence(1, {n - 1}), {undone}, "
            "(x, i) -> transform(x, (v, j) -> IF(j = i, v ^ x[i - 1], v)))")
    masks = ", ".join(str(1 << b) for b in range(bits - 1, 0, -1))
    turned = (f"transform(array({gray}), x -> transform(array(aggregate(array({masks}), 0, "
              f"(t, q) -> IF((x[{n - 1}] & q) <> 0, t ^ (q - 1), t))), t -> transform(x, v -> v ^ t))[0])[0]")
    places = ", ".join(f"named_struct('b', {b}, 'i', {i})" for b in range(bits - 1, -1, -1) for i in range(n))
    return F.expr(f"transform(array({turned}), x -> aggregate(array({places}), cast(0 AS bigint), "
                  "(h, p) -> h * 2 + (shiftright(x[p.i], p.b) & 1)))[0]")


def hilbert_shards(docs: DataFrame, shards: int, dims: dict[str, Column],
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``id``, ``size``, ``text_crc32``, ``curve_index``, ``shard``, ``slot``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    axes = [f"axis{i}" for i in range(len(dims))]
    rows = materialise(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("crc"), F.xxhash64(F.col(id_col)).alias("salt"),
        *[c.alias(a) for a, c in zip(axes, dims.values())]), "shards")
    total = rows.count()
    room = max(ROWS_PER_BUCKET, total // MAX_BUCKETS)
    cells = (rows.groupBy(*axes).agg(F.count("*").alias("n"))
             .select(*axes, hilbert_index(axes).alias("curve_index"),
                     F.ceil(F.col("n") / room).alias("slices")))
    # at most 2^(BITS * dimensions) rows
    placed = rows.join(F.broadcast(materialise(cells, "cells")), axes).withColumn(
        "slice", F.floor(F.col("crc") * F.col("slices") / float(1 << 32)))
    heavy = (placed.groupBy("curve_index", "slice").agg(F.count("*").alias("n"))
             .where(F.col("n") > 2 * room)
             .select("curve_index", "slice", F.ceil(F.col("n") / room).alias("ways")))
    placed = (placed.join(F.broadcast(materialise(heavy, "heavy")), ["curve_index", "slice"], "left")
              .withColumn("way", F.pmod("salt", F.coalesce("ways", F.lit(1)))))
    key = ["curve_index", "slice", "way"]
    before = Window.orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(
        placed.groupBy(*key).agg(F.count("*").alias("n"))
        .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))), "starts")
    inside = Window.partitionBy(*key).orderBy("crc", "id")
    place = F.col("start") + F.row_number().over(inside) - 1
    return (placed.join(F.broadcast(starts.drop("n")), key).withColumn("place", place)
            .withColumn("shard", F.expr(f"cast(place * {shards} div {max(total, 1)} AS int)"))
            .select("id", "size", F.col("crc").alias("text_crc32"), "curve_index", "shard",
                    (F.col("place") - F.ceil(F.col("shard").cast("long") * F.lit(total) / shards))
                    .cast("long").alias("slot")))


def shard_ranges(sharded: DataFrame, axes: list[str]) -> DataFrame:
    """Least and greatest value of each column per shard: what a reader prunes files by."""
    bounds = reduce(lambda a, b: a + b, [[F.min(a).alias(f"min_{a}"), F.max(a).alias(f"max_{a}")] for a in axes])
    return sharded.groupBy("shard").agg(F.count("*").alias("n_rows"), *bounds)
