"""Input tables of (id, text): checks, invalid-text policy, column order, slices."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrun.functions.text import has_text
from quillrun.operators.positions import with_position

ERROR_COLUMNS = ("error", "error_msg", "status")
INVALID_TEXT = "text must be a non-empty string"


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"the table has no column {', '.join(missing)}")


def scan_text(df: DataFrame, text: str, id: str, require_rows: bool = False) -> DataFrame:
    """The id and text columns; ``require_rows`` starts a job to refuse an empty table."""
    require_columns(df, id, text)
    if require_rows and df.isEmpty():
        raise ValueError("the table is empty")
    return df.select(id, text)


def from_vectors(spark: SparkSession, texts: Sequence[str], ids: Sequence[Any],
                 id: str = "id", text: str = "text") -> DataFrame:
    """A table from two equally long sequences held by the caller."""
    if len(texts) != len(ids):
        raise ValueError(f"{len(texts)} texts do not go with {len(ids)} ids")
    id_type = "bigint" if all(isinstance(i, int) for i in ids) else "string"
    rows = [(i if id_type == "bigint" else str(i), t) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, f"`{id}` {id_type}, `{text}` string")


def apply_invalid_policy(df: DataFrame, text: str, on_invalid: str = "error_row",
                         id: str | None = None) -> DataFrame:
    """What to do with NULL or empty texts.

    ``drop`` filters them, ``fail`` raises when one is read (naming its ``id``), ``error_row``
    keeps them: they get no request and come back as error rows.
    """
    if on_invalid == "drop":
        return df.where(has_text(F.col(text)))
    if on_invalid == "fail":
        which = F.lit("") if id is None else F.concat(F.lit(", row "), F.col(id).cast("string"))
        refuse = F.raise_error(F.concat(
            F.lit(INVALID_TEXT), which, F.lit(" (drop such rows, or keep them as error rows)")))
        checked = F.when(has_text(F.col(text)), F.col(text)).otherwise(refuse.cast("string"))
        return df.withColumn(text, checked)
    if on_invalid == "error_row":
        return df
    raise ValueError("on_invalid must be 'fail', 'error_row' or 'drop'")


def order_columns(df: DataFrame, first: Iterable[str] = (), relocate: int = 2) -> DataFrame:
    """``first`` columns (the text) lead; the error columns go before the ``relocate``-th one."""
    first = list(first)
    errors = [c for c in ERROR_COLUMNS if c in df.columns]
    rest = first + [c for c in df.columns if c not in first and c not in errors]
    at = relocate - 1
    return df.select(*rest[:at], *errors, *rest[at:])


def embedding_columns(df: DataFrame, prefix: str = "V") -> DataFrame:
    """Only the widened embedding columns."""
    return df.select(*[c for c in df.columns
                       if c.startswith(prefix) and c[len(prefix):].isdigit()])


def slice_rows(df: DataFrame, order_by: str | Sequence[str], start: int, stop: int) -> DataFrame:
    """Rows ``start`` to ``stop`` (1-based, both included) of the order, found in parallel."""
    if not 1 <= start <= stop:
        raise ValueError("need 1 <= start <= stop")
    placed = with_position(df, order_by, "__position", between=(start, stop))
    return placed.where(F.col("__position").between(start, stop)).drop("__position")


def sample_rows(df: DataFrame, id: str, n: int, seed: int = 0) -> DataFrame:
    """A repeatable random sample of exactly ``n`` rows (or all, if fewer).

    Rows are ranked by the md5 of ``id:seed``. Only rows under a threshold that almost surely holds
    ``n`` rows are ranked; if it does not, all are. Rows of one id are ranked together.
    """
    total = df.count()
    if n >= total:
        return df
    draw = F.md5(F.concat_ws(":", F.coalesce(F.col(id).cast("string"), F.lit("")), F.lit(str(seed))))
    share = min(1.0, (n + 10 * math.sqrt(n) + 100) / total)
    threshold = format(int(share * (16 ** 12 - 1)), "012x") + "g"  # above all that start with it
    drawn = df.withColumn("__draw", draw)
    likely = drawn.where(F.col("__draw") <= F.lit(threshold))
    if likely.count() < n:
        likely = drawn
    placed = with_position(likely, ["__draw", id], "__position")
    return placed.where(F.col("__position") <= n).drop("__draw", "__position")


def parameter_grid(spark: SparkSession, **choices: Sequence[Any]) -> DataFrame:
    """Every combination of the given short lists."""
    grid = spark.range(1).select()
    for name, values in choices.items():
        grid = grid.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    return grid
