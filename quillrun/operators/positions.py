"""Global row positions and running totals without a one-task window.

*Stored order.* Rows read from files stand in an order: file, split, row. Counting rows per split (no
data column is read for it) gives each split's start, and a row's position is that start plus its
number within the split. Nothing shuffles; see ``stored_rows``.

*Order of a key.* A plain ``row_number()`` over an unpartitioned window sorts the whole table in one task. Here
the key range is cut into buckets at sampled quantiles; the cuts become literals in the plan, so
a row's bucket depends on its key alone and not on how tasks are scheduled or re-run. Then

* one key-only pass counts rows (and sums measures) per bucket,
* a prefix sum over that small table gives each bucket's start,
* one shuffle by bucket numbers the rows inside their bucket.

The rows cross the network once and nothing has to be checkpointed.
"""

from __future__ import annotations

import contextlib
import io
import math
import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillrun.session import materialise

# The bucket table is broadcast and its prefix sum runs in one task: this is its size bound.
MAX_BUCKETS = 65_536
SAMPLES_PER_BUCKET = 8
ROWS_PER_BUCKET = 250_000
MIN_ROWS_PER_BUCKET = 1_000
TREE_LEAVES = 64

_BUCKET, _TIE = "__bucket", "__tie"


def _bucket_count(df: DataFrame, total: int, rows_per_bucket: int) -> int:
    by_size = math.ceil(total / rows_per_bucket)
    by_cores = min(df.sparkSession.sparkContext.defaultParallelism,
                   math.ceil(total / MIN_ROWS_PER_BUCKET))
    return max(1, min(MAX_BUCKETS, max(by_size, by_cores)))


def _sampled_cuts(df: DataFrame, order_by: Sequence[str], buckets: int, total: int) -> list[str]:
    """Up to ``buckets - 1`` ascending keys as JSON. They only steer balance, never results."""
    wanted = buckets * SAMPLES_PER_BUCKET
    keys = df.select(*order_by)
    if wanted < total:
        keys = keys.sample(fraction=min(1.0, wanted / total), seed=17)
    ordered = [r[0] for r in keys.orderBy(*order_by)
               .select(F.to_json(F.struct(*order_by), {"ignoreNullFields": "false"})).collect()]
    return [ordered[len(ordered) * i // buckets] for i in range(1, buckets)] if ordered else []


def _tie_break(df: DataFrame) -> Column:
    """A hash of the row and its place: an order among rows with equal keys. The place, 4,096 stretches
    of the stored order, keeps rows that are alike in everything from sharing a bucket."""
    hashable = [f"`{f.name}`" for f in df.schema.fields
                if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*hashable, F.pmod(F.monotonically_increasing_id(), F.lit(4096)))


def _literals(cuts: list[str], shape: str, schema: T.StructType) -> Column:
    """Cuts (JSON keys, or lists of them) as one constant the optimizer folds."""
    return F.from_json(F.lit("[" + ",".join(cuts) + "]"), shape.format(schema.simpleString()))


def _reaches(key: list[Column], cut: Column, names: Sequence[str]) -> Column:
    """Is the key at or above the cut, column by column, nulls first."""
    last = len(names) - 1

    def compare(i: int) -> Column:
        ours, theirs = key[i], cut[names[i]]
        above = F.coalesce(ours > theirs, theirs.isNull() & ours.isNotNull())
        rest = F.lit(True) if i == last else compare(i + 1)
        return above | (ours.eqNullSafe(theirs) & rest)

    return compare(0)


def _bucket_of(df: DataFrame, order_by: Sequence[str], cuts: list[str]) -> Column:
    """How many cuts are at or below the row's key.

    A few dozen cuts are a compiled decision tree. More are found in two further levels: the
    tree picks a group, and short arrays of the group's cuts are counted.
    """
    if not cuts:
        return F.lit(0)
    schema = T.StructType([df.schema[c] for c in order_by])
    key = [F.col(c) for c in order_by]
    size = math.ceil((len(cuts) + 1) / TREE_LEAVES)
    groups = [cuts[i:i + size] for i in range(0, len(cuts), size)]
    heads = _literals([g[0] for g in groups[1:]] if size > 1 else cuts, "array<{}>", schema)

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        here = F.get(heads, F.lit(middle))
        return F.when(_reaches(key, here, order_by), tree(middle + 1, high)) \
            .otherwise(tree(low, middle))

    if size == 1:
        return tree(0, len(cuts))
    step = max(1, math.isqrt(size))
    parts = [[g[i:i + step] for i in range(0, len(g), step)] for g in groups]

    def listed(items: list[str]) -> str:
        return "[" + ",".join(items) + "]"

    part_heads = _literals([listed([p[0] for p in g[1:]]) for g in parts],
                           "array<array<{}>>", schema)
    members = _literals([listed([listed(p) for p in g]) for g in parts],
                        "array<array<array<{}>>>", schema)

    def reached(bounds: Column) -> Column:
        return F.size(F.filter(bounds, lambda b: _reaches(key, b, order_by)))

    place = F.struct(tree(0, len(groups) - 1).alias("group"))

    def within(at: Column) -> Column:
        part = reached(F.get(part_heads, at["group"]))
        return F.struct(at["group"].alias("group"), part.alias("part"))

    def count(at: Column) -> Column:
        cell = F.get(F.get(members, at["group"]), at["part"])
        return at["group"] * size + at["part"] * step + reached(cell)

    found = F.transform(F.transform(F.array(place), within), count)
    return F.get(found, F.lit(0))


def with_position(df: DataFrame, order_by: str | Sequence[str], position: str = "position",
                  running: Mapping[str, Column] | None = None,
                  highest: Mapping[str, Column] | None = None,
                  rows_per_bucket: int = ROWS_PER_BUCKET,
                  between: tuple[int, int] | None = None) -> DataFrame:
    """Add the 1-based position of each row in the order of ``order_by``.

    ``order_by`` should tell rows apart (add the id); rows with equal keys follow each other in an
    order of no meaning, and a key that fills more than a bucket is split. ``running`` names long expressions: each
    becomes the running total *before* the row. ``highest`` names expressions whose maximum over
    the table goes on every row; it comes from the same pass as the bucket sizes. ``between`` keeps
    only rows of buckets that reach into those positions. ``df`` should be a stored table: its keys are read for the count and a sample, the measured columns for
    the bucket sizes, and all of it for the result.
    """
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    running, highest = dict(running or {}), dict(highest or {})
    total = df.select(*order_by).count()
    buckets = _bucket_count(df, total, rows_per_bucket)
    cuts = _sampled_cuts(df, order_by, buckets, total) if buckets > 1 else []
    measured = df.withColumns({f"__m_{n}": e.cast("bigint") for n, e in running.items()}) \
        if running else df
    if len(set(cuts)) < len(cuts):  # one key fills more than a bucket: split it by row content
        measured = measured.withColumn(_TIE, _tie_break(df))
        order_by = [*order_by, _TIE]
        cuts = list(dict.fromkeys(_sampled_cuts(measured, order_by, buckets, total)))
    bucketed = measured.withColumn(_BUCKET, _bucket_of(measured, order_by, cuts))
    sizes = bucketed.groupBy(_BUCKET).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.sum(f"__m_{n}").alias(f"__sum_{n}") for n in running],
        *[F.max(e).alias(f"__max_{n}") for n, e in highest.items()])
    before = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        _BUCKET, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"),
        *[F.coalesce(F.sum(f"__sum_{n}").over(before), F.lit(0)).alias(f"__start_{n}")
          for n in running],
        *[F.max(f"__max_{n}").over(Window.orderBy(_BUCKET).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias(n) for n in highest])

    if between is not None and cuts:
        low, high = between
        reached = starts.join(sizes.select(_BUCKET, "__rows"), _BUCKET).where(
            (F.col("__start") < high) & (F.col("__start") + F.col("__rows") >= low))
        bucketed = bucketed.join(F.broadcast(reached.select(_BUCKET)), _BUCKET, "left_semi")
    inside = Window.partitionBy(_BUCKET).orderBy(*order_by)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    # one bucket per task, so the shuffle is as even as the quantiles and files come out in order
    placed = bucketed.repartitionById(buckets, F.col(_BUCKET))
    numbered = placed.withColumns({
        "__rank": F.row_number().over(inside),
        **{f"__run_{n}": F.coalesce(F.sum(f"__m_{n}").over(earlier), F.lit(0)) for n in running}})
    if cuts:
        joined = numbered.join(F.broadcast(starts), _BUCKET)
    else:  # a single small bucket starts at zero
        joined = numbered.withColumns({
            "__start": F.lit(0), **{f"__start_{n}": F.lit(0) for n in running},
            **{n: F.max(e).over(Window.partitionBy(_BUCKET)) for n, e in highest.items()}})
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("__start") + F.col("__rank")).cast("bigint").alias(position),
        *[(F.col(f"__start_{n}") + F.col(f"__run_{n}")).alias(n) for n in running], *highest)


# --- stored order ------------------------------------------------------------------------------

FILE, SPLIT, SEQUENCE = "__file", "__split", "__sequence"
# Up to so many splits, of 40 bytes a row, their prefix sum is one task's and their table is broadcast;
# beyond, both are dealt out and give the same numbers.
MAX_SPLITS = 1 << 18

_PASSED = ("Project", "Filter", "SubqueryAlias", "View")


def arrangement(df: DataFrame) -> str:
    """``stored``: a plain read of files, perhaps filtered; ``sorted``: the last thing that arranged the
    rows is a sort of the whole table; ``other``: rows in no order that could be read off."""
    told = io.StringIO()
    with contextlib.redirect_stdout(told):
        df.explain(mode="extended")
    analysed = told.getvalue().split("== Analyzed Logical Plan ==", 1)[-1].split("== Optimized", 1)[0]
    for line in analysed.splitlines()[2:]:  # the first two are the title's end and the schema
        node = re.match(r"\s*(?:\+- )?(\w+)(.*)", line)
        if node is None or node[1] in _PASSED:
            continue
        if node[1] == "Sort":
            return "sorted" if node[2].rstrip().endswith("true") else "other"
        if node[1] != "Relation":
            return "other"
        try:
            df.select("_metadata.file_path").schema  # resolves the plan
        except AnalysisException:
            return "other"
        return "stored"
    return "other"


def _split_starts(splits: DataFrame, totals: Sequence[str]) -> DataFrame:
    """Splits in order with, for each of ``totals``, its sum over the splits before."""
    kept = [FILE, SPLIT, "__first"]
    if splits.count() <= MAX_SPLITS:
        before = Window.orderBy("__path", SPLIT).rowsBetween(Window.unboundedPreceding, -1)
        return F.broadcast(splits.select(
            *kept, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in totals]))
    summed = with_position(splits, ["__path", SPLIT], "__at", {f"__b{n}": F.col(n) for n in totals})
    return materialise(summed.select(*kept, *[F.col(f"__b{n}").alias(n) for n in totals]), "starts")


def stored_rows(df: DataFrame, measures: Mapping[str, Column] | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """Rows (of a table that is `arrangement` ``stored``) with the file, split and sequence they are
    read at, and a table of splits: ``__first`` (its least sequence), ``__rows`` (rows before it) and
    each measure's total before it."""
    measures = dict(measures or {})
    read = df.select("*", F.xxhash64("_metadata.file_path").alias(FILE),
                     F.col("_metadata.file_path").alias("__path"),
                     F.col("_metadata.file_block_start").alias(SPLIT)) \
        .withColumn(SEQUENCE, F.monotonically_increasing_id())
    # grouped by the path too: a least string can't be hashed up, and would sort all rows of a split
    splits = materialise(read.groupBy(FILE, SPLIT, "__path").agg(
        F.min(SEQUENCE).alias("__first"), F.count(F.lit(1)).alias("__rows"),
        *[F.sum(e).alias(n) for n, e in measures.items()]), "splits")
    return read.drop("__path"), _split_starts(splits, ["__rows", *measures])


def with_stored_position(df: DataFrame, position: str = "position") -> DataFrame:
    """Add the 1-based position of each row in stored order, which moves no row (with very many splits,
    rows meet their split's start in a join by split)."""
    rows, starts = stored_rows(df)
    at = F.col("__rows") + F.col(SEQUENCE) - F.col("__first") + 1
    return rows.join(starts, [FILE, SPLIT]).select(
        *[F.col(f"`{c}`") for c in df.columns], at.cast("bigint").alias(position))


def stored_totals(df: DataFrame, measure: Column) -> DataFrame:
    """``position``, ``size`` (the measure) and ``before`` (its total over the rows before) of each row
    in stored order. Only measures shuffle, by split."""
    rows, starts = stored_rows(df, {"__before": measure})
    inside = Window.partitionBy(FILE, SPLIT).orderBy(SEQUENCE).rowsBetween(
        Window.unboundedPreceding, -1)
    running = rows.select(FILE, SPLIT, SEQUENCE, measure.cast("bigint").alias("size")).withColumn(
        "__run", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return running.join(starts, [FILE, SPLIT]).select(
        (F.col("__rows") + F.col(SEQUENCE) - F.col("__first") + 1).cast("bigint").alias("position"),
        "size", (F.col("__before") + F.col("__run")).alias("before"))
