"""Structured content: validate, parse, unnest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrun.functions.responses import structured
from quillrun.functions.validation import violation_texts, violations
from quillrun.operators.exploding import computed_once, each_object
from quillrun.schema import JsonSchema


def validate_content(df: DataFrame, schema: JsonSchema, content: str = "content") -> DataFrame:
    """Add ``violations`` and ``valid``; both NULL where there is no content."""
    return computed_once(df, "violations", violations(F.col(content), schema)) \
        .withColumn("valid", F.size("violations") == 0) \
        .withColumn("valid", F.when(F.col("violations").isNotNull(), F.col("valid")))


def parse_content(df: DataFrame, schema: JsonSchema, content: str = "content",
                  parsed: str = "parsed") -> DataFrame:
    """Add the parsed struct where the content is valid; the raw content stays."""
    checked = validate_content(df, schema, content)
    return checked.withColumn(
        parsed, F.when(F.col("valid"), structured(F.col(content), schema)))


def violation_rows(df: DataFrame, id: str) -> DataFrame:
    """One row per violation of a validated table."""
    return each_object(df, "violations", [id])


def violation_messages(df: DataFrame) -> DataFrame:
    return df.withColumn("violations", violation_texts(F.col("violations")))


def unnest_content(df: DataFrame, schema: JsonSchema, content: str = "content") -> DataFrame:
    """The schema's top-level fields as columns, beside the other columns."""
    rest = [c for c in df.columns if c != content]
    return df.select(*rest, structured(F.col(content), schema).alias("__p")) \
        .select(*rest, "__p.*")


def unnest_objects(df: DataFrame, objects: str, keep_empty: bool = False) -> DataFrame:
    """An array of objects to one row per object; ``keep_empty`` keeps rows without any."""
    rest = [c for c in df.columns if c != objects]
    return df.select(*rest, F.inline_outer(objects)) if keep_empty \
        else each_object(df, objects, rest)
