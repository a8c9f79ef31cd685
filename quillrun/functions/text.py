"""Text lengths, truncation and splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rule of thumb and the token limit of hosted embedding models.
CHARS_PER_TOKEN = 4
TOKEN_LIMIT = 8192
TRUNCATE_CHARS = 32000
PIECE_CHARS = 2000


def has_text(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def char_count(text: Column) -> Column:
    return F.length(text).cast("bigint")


def approx_tokens(text: Column) -> Column:
    return F.length(text) / F.lit(CHARS_PER_TOKEN)


def too_long(text: Column, limit: int = TOKEN_LIMIT) -> Column:
    return approx_tokens(text) > F.lit(limit)


def truncate(text: Column, max_chars: int = TRUNCATE_CHARS) -> Column:
    return F.substring(text, 1, max_chars)


def pieces(text: Column, max_chars: int = PIECE_CHARS) -> Column:
    """The text cut every ``max_chars`` characters; a short text is its only piece.

    Whole text, no piece empty; NULL or empty text has no pieces. One pass over the text, however
    long (cutting by position would look for each piece from the start).
    """
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{int(max_chars)}}}"), F.lit(0))
    return F.when(F.length(text) > 0, cut)


def lines(text: Column) -> Column:
    """The non-empty lines of a text, in order."""
    return F.filter(F.split(text, "\n"), lambda line: F.length(line) > 0)
