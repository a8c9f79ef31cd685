"""Long texts in pieces, and piece scores put together again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrun.functions import text as tx
from quillrun.operators.exploding import each


def split_text(df: DataFrame, text: str, keep: Sequence[str], max_chars: int = tx.PIECE_CHARS
               ) -> DataFrame:
    """One row per piece, numbered from 1. Pieces joined in order give the text back."""
    return each(df, tx.pieces(F.col(text), max_chars), keep, "piece", "__at") \
        .select(*keep, (F.col("__at") + 1).alias("piece_no"), "piece")


def combine_scores(scored: DataFrame, id: str, scores: str = "scores") -> DataFrame:
    """Mean and highest score per document and label; pieces without scores are left out.

    Scores are summed per label before the shuffle, so a document of any number of pieces is fine.
    """
    return scored.select(id, F.explode(scores).alias("label", "score")).groupBy(id, "label").agg(
        F.avg("score").alias("mean_score"), F.max("score").alias("max_score"),
        F.count(F.lit(1)).alias("n_pieces"))
