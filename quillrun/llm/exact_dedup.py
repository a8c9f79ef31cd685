"""Exact duplicates by two-pass Bloom filtering (DataFrame functions only).

Pass one sets, for every text digest, two cells of a filter; a cell that is set a second time goes
into a second filter. Pass two tests each digest against the second filter: a text whose two cells
were not both set again cannot have a copy, so its row passes straight through. Only the others
shuffle, by their full digest, which settles false positives exactly.

The second filter has 16 cells a text up to a 128 MB bitmap, which bounds the broadcast. With more
texts than it can tell apart it lets more rows through to the exact step; no result changes.

Defined cases: a null text equals the empty text; texts equal after deleting the characters
``[\\x20\\x09-\\x0D]`` are copies; of copies, the row with the most code points in its original text
stays, then the smallest id (a null id last), and of rows alike in all of that exactly one. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun.llm import bitmaps
from quillrun.session import materialise

SPACES = "\t\n\x0b\x0c\r "


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def with_possible_copies(keys: DataFrame, digest: str, count: int,
                         source: DataFrame | None = None) -> DataFrame:
    """``keys`` with ``maybe``: false only where no other row has the same digest.

    ``source`` holds the digests of the same rows, if reading those from it is cheaper.
    """
    cells = bitmaps.cells_for(count)
    once = (source if source is not None else keys).select(bitmaps.key_cells(F.col(digest), cells))
    again = once.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1").select("cell")
    return bitmaps.with_test(keys, F.col(digest), bitmaps.bitmap_table(again, "bloom"), cells, "maybe")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    keys = materialise(
        docs.select(F.col(id_col).alias("id"),
                    F.coalesce(F.char_length(text_col), F.lit(0)).cast("long").alias("chars"),
                    F.sha2(normalised(F.col(text_col)), 256).alias("text_sha256"),
                    F.monotonically_increasing_id().alias("row")), "digests")
    tested = with_possible_copies(keys, "text_sha256", keys.count())
    alone = tested.where(~F.col("maybe")).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    maybe = tested.where("maybe").select("id", "chars", "text_sha256", "row")
    first = F.min(F.struct((-F.col("chars")).alias("shorter"), F.col("id").isNull().alias("no_id"),
                           F.col("id").alias("id"), F.col("row").alias("row")))
    # written, so that the join deals both sides out anew and a hot digest can be split
    groups = materialise(maybe.groupBy("text_sha256").agg(
        F.count("*").alias("group_size"), first.alias("first")), "groups")
    groups = groups.select("text_sha256", "group_size", F.col("first.id").alias("keep_id"),
                           F.col("first.row").alias("keep_row"))
    joined = maybe.hint("merge").join(groups, "text_sha256").select(
        "id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        "text_sha256")
    return alone.unionByName(joined)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of copies; the row that stays is as in `exact_groups`.

    Whole rows shuffle only where the filter finds a possible copy, and copies combine before it.
    """
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.sha2(normalised(F.col(text_col)), 256).alias("digest"),
        F.struct((-F.coalesce(F.char_length(text_col), F.lit(0))).alias("shorter"),
                 F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id")).alias("place"))
    digests = materialise(packed.select("digest"), "digests")
    tested = with_possible_copies(packed, "digest", digests.count(), digests)
    once = tested.where(~F.col("maybe")).select("row.*")
    first = (tested.where("maybe").groupBy("digest").agg(F.min_by("row", "place").alias("row"))
             .select("row.*"))
    return once.unionByName(first)
