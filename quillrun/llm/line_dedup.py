"""Repeated runs of lines by prefix doubling over line ids; later copies are deleted.

A run is judged if it has ``min_lines`` lines or ``min_words`` words (runs of bytes outside
``[\\x20\\x09-\\x0D]``). Of the places where such a run begins, the first (by id, then line) keeps it and
the lines of the others are deleted, so a maximal repeated run goes as a whole whatever its length.

Every line gets an id (a 64-bit hash) and a position. Round by round the rank of a position, which
names the suffixes that agree with it in their first m lines, is combined with the rank m lines on:
the pair names agreement over 2m lines. A rank is the least position of its longest-common-prefix
interval; positions alone in their interval have no copy and leave. Any run of ``min_lines`` lines is
judged, and a shorter one from the length at which it has ``min_words`` words; so intervals of a common
prefix of 1 to ``min_lines`` lines hold all that is to be deleted: a longer run is the chain of the windows
in it. A length that is no power of two is named by two ranks that overlap, and only among positions
where a run of that length is judged.

Rounds work on narrow tables of positions that are still repeated, each written, so a lost executor
repeats one round. Intervals are found by aggregates that combine before the shuffle; a line that a
third of all texts holds is only ever a key of those and of joins that can be split. Both sides of
these joins grow with the table, so neither is broadcast.

Defined cases: lines end at ``\\n``; a null or empty text is one empty line; runs never cross texts;
runs are judged on the input, so copies that overlap within a run of equal lines leave what comes
before the second one; a null id comes last, rows that share an id are in any order among themselves;
an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun.llm import bitmaps
from quillrun.session import materialise

MIN_LINES = 3
MIN_WORDS = 50


def _ranked(pairs: DataFrame, key: list[str], label: str) -> DataFrame:
    """Positions whose ``key`` another position has too, with the least of them as ``rank``.

    Most positions are alone in their interval; a Bloom filter of the others' keys lets few of them
    into the join.
    """
    intervals = materialise(pairs.groupBy(*key).agg(F.min("at").alias("rank"), F.count("*").alias("n"))
                            .where("n > 1").drop("n").withColumn("name", F.xxhash64(*key)), label)
    test, cells = bitmaps.filter_of(intervals, "name", intervals.count(), label)
    maybe = bitmaps.with_test(pairs, F.xxhash64(*key), test, cells, "maybe").where("maybe").drop("maybe")
    return materialise(maybe.hint("merge").join(intervals.drop("name"), key).drop(*key), label)


def _extended(level: DataFrame, judged: DataFrame, step: int, label: str) -> DataFrame:
    """Positions of ``judged`` over ``step`` more lines: their rank with that of ``level`` ``step`` lines on."""
    ahead = level.select((F.col("at") - step).alias("at"), F.col("row").alias("row_"), F.col("rank").alias("next"))
    pairs = materialise(judged.hint("merge").join(ahead, "at").where("row = row_").drop("row_")
                        .withColumnRenamed("rank", "this"), "pairs")
    return _ranked(pairs, ["this", "next"], label)


def repeated_windows(lines: DataFrame, min_lines: int) -> DataFrame:
    """``size``, ``row``, ``place``, ``rank`` of the repeated runs of ``size`` lines, 1 to ``min_lines``, that
    are judged: those of at least ``need`` lines, a column of ``lines``."""
    level = _ranked(lines.select("at", "row", "place", "need", "line"), ["line"], "level")
    reach, found = 1, []
    for size in range(1, min_lines + 1):
        judged = level.where(F.col("need") <= size)
        if size == 2 * reach:
            level, reach = _extended(level, level, reach, "level"), size
            judged = level.where(F.col("need") <= size)
        elif size > reach:
            judged = _extended(level, judged, size - reach, "windows")
        found.append(judged.select(F.lit(size).alias("size"), "row", "place", "rank"))
    return reduce(DataFrame.unionByName, found)


def _need(min_lines: int, min_words: int) -> Column:
    """Per line of the array ``lines``: the least number of lines from there on that are judged as a run."""
    words = "transform(lines, l -> regexp_count(l, '[^\\\\x20\\\\x09-\\\\x0D]+'))"
    reached = " ".join(
        f"WHEN aggregate(slice(w, i + 1, {m}), 0, (a, x) -> a + x) >= {min_words} THEN {m}"
        for m in range(1, min_lines))
    least = f"CASE {reached} ELSE {min_lines} END" if reached else f"{min_lines}"
    return F.expr(f"transform(array({words}), w -> transform(w, (x, i) -> {least}))[0]")


def deleted_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS,
                  id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The stored rows (``row``, ``id``, ``text``) and the lines to delete (``row``, ``line_no``)."""
    rows = materialise(docs.select(F.monotonically_increasing_id().alias("row"),
                                   F.col(id_col).alias("id"),
                                   F.coalesce(F.col(text_col), F.lit("")).alias("text")), "rows")
    # positions follow each other within a text, as its lines do within a task
    lines = materialise(
        rows.select("row", F.struct(F.col("id").isNull().alias("no_id"), "id").alias("place"),
                    F.split("text", "\n").alias("lines"))
        .select("row", "place", F.posexplode(F.arrays_zip("lines", _need(min_lines, min_words).alias("need")))
                .alias("line_no", "line"))
        .select("row", F.struct("place.no_id", "place.id", "row", "line_no").alias("place"),
                F.col("line.need").alias("need"), F.xxhash64("line.lines").alias("line"),
                F.monotonically_increasing_id().alias("at")), "lines")
    windows = repeated_windows(lines, min_lines)
    firsts = materialise(windows.groupBy("size", "rank").agg(F.min("place").alias("first")), "firsts")
    later = windows.hint("merge").join(firsts, ["size", "rank"]).where("place <> first")
    covered = later.select("row", F.explode(F.expr(
        "sequence(place.line_no, place.line_no + size - 1)")).alias("line_no")).distinct()
    return rows, materialise(covered, "covered")


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``text`` without later copies, ``n_lines``, ``n_removed``,
    ``n_runs`` (maximal deleted runs). Texts that nothing is deleted from don't shuffle."""
    rows, covered = deleted_lines(docs, min_lines, min_words, id_col, text_col)
    touched = covered.select("row").distinct()
    test, cells = bitmaps.filter_of(touched, "row", touched.count(), "touched")
    tested = bitmaps.with_test(rows, F.col("row"), test, cells, "maybe")
    whole = tested.where("NOT maybe").select(
        "id", "text", F.size(F.split("text", "\n")).alias("n_lines"), F.lit(0).alias("n_removed"),
        F.lit(0).alias("n_runs"))
    lines = (tested.where("maybe").select("row", "id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
             .hint("merge").join(covered.withColumn("gone", F.lit(True)), ["row", "line_no"], "left"))
    cut = lines.groupBy("row", "id").agg(
        F.sort_array(F.collect_list(F.struct("line_no", "line", F.coalesce("gone", F.lit(False)).alias("gone"))))
        .alias("lines"))
    kept = F.expr("transform(filter(lines, l -> NOT l.gone), l -> l.line)")
    runs = F.expr("size(filter(lines, (l, i) -> l.gone AND (i = 0 OR NOT lines[i - 1].gone)))")
    return whole.unionByName(cut.select(
        "id", F.array_join(kept, "\n").alias("text"), F.size("lines").alias("n_lines"),
        F.size(F.expr("filter(lines, l -> l.gone)")).alias("n_removed"), runs.alias("n_runs")))
