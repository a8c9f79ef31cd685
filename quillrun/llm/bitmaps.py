"""Bloom filters as tables of bitmaps, built and tested with DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun.session import materialise

CELLS_PER_KEY = 16
MAX_CELLS = 1 << 30     # a 128 MB table at most, which bounds the broadcast
PART_CELLS = 32768      # cells in one row of the table
SEEDS = (1, 2)


def cells_for(keys: int) -> int:
    cells = PART_CELLS
    while cells < min(MAX_CELLS, CELLS_PER_KEY * keys):
        cells *= 2
    return cells


def cell(key: Column, seed: int, cells: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(cells))


def key_cells(key: Column, cells: int) -> Column:
    """Both cells of a key, as rows ``cell``."""
    return F.explode(F.array(*[cell(key, seed, cells) for seed in SEEDS])).alias("cell")


def bitmap_table(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` has ``cell``; the written table has ``part`` and ``bits``, one bit a cell."""
    return materialise(rows.groupBy((F.col("cell") / PART_CELLS).cast("long").alias("part"))
                       .agg(F.expr(f"bitmap_construct_agg(cell % {PART_CELLS})").alias("bits")), label)


def filter_of(keys: DataFrame, key: str, count: int, label: str) -> tuple[DataFrame, int]:
    """A filter of the values of ``key`` and its number of cells."""
    cells = cells_for(count)
    return bitmap_table(keys.select(key_cells(F.col(key), cells)).distinct(), label), cells


def with_test(rows: DataFrame, key: Column, bitmaps: DataFrame, cells: int, name: str) -> DataFrame:
    """``rows`` (none of whose columns is named like those here) with ``name``: false if the filter
    certainly lacks ``key``."""
    columns, found = rows.columns, F.lit(True)
    for seed in SEEDS:
        at, part, bits = f"bitmap_cell{seed}", f"bitmap_part{seed}", f"bitmap_bits{seed}"
        rows = rows.withColumn(at, cell(key, seed, cells)).withColumn(
            part, (F.col(at) / PART_CELLS).cast("long"))
        rows = rows.join(F.broadcast(bitmaps.select(F.col("part").alias(part), F.col("bits").alias(bits))),
                         part, "left")
        byte = F.conv(F.hex(F.expr(f"substring({bits}, cast({at} % {PART_CELLS} div 8 as int) + 1, 1)")),
                      16, 10).cast("int")
        bit = F.expr(f"cast({at} % 8 as int)")
        found = found & F.coalesce((F.floor(byte / F.pow(F.lit(2), bit)) % 2) == 1, F.lit(False))
    return rows.withColumn(name, found).select(*[F.col(f"`{c}`") for c in columns], name)
