"""Arrays to rows, and expensive columns computed once.

For a plain ``explode`` the optimizer adds a filter that drops empty arrays early, and with it a
second evaluation of the array: of a parse, a validation or a Python function. An outer explode
gets no such filter, and the rows it adds for empty arrays have no position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def each(df: DataFrame, items: Column | str, keep: Sequence[str], item: str = "item",
         at: str = "at") -> DataFrame:
    """The kept columns, and each element with its position from 0; no rows for no elements."""
    return df.select(*keep, F.posexplode_outer(items).alias(at, item)) \
        .where(F.col(at).isNotNull())


def each_object(df: DataFrame, items: Column | str, keep: Sequence[str]) -> DataFrame:
    """The kept columns and the fields of each struct in an array."""
    return each(df, items, keep, "__item", "__at").select(*keep, "__item.*")


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add an expensive column in a step of its own.

    A filter on a plain column moves below the projection that makes it, and then the filter and
    the projection each compute the value. It cannot move below a one-element explode.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))
