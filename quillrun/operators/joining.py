"""Results back to their source rows, and what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrun.functions.vectors import max_abs_difference


def attach_results(source: DataFrame, results: DataFrame, id: str, custom_id: str = "custom_id",
                   how: str = "left", suffix: str = "_result") -> DataFrame:
    """Source rows with their results, matched by the id's text.

    A result column named like a source column gets the ``suffix``. An id with several results gives
    a row for each; ``completeness`` finds such ids, ``resume.latest_attempt`` leaves one.

    Both sides are sorted by id: Spark takes parsed lines for far less than they are, and would
    gather all texts on the driver to broadcast them.
    """
    taken = {c.lower() for c in source.columns}
    renamed = {c: c + suffix for c in results.columns if c != custom_id and c.lower() in taken}
    clash = [c for c in renamed.values() if c.lower() in taken or c in results.columns]
    if clash:
        raise ValueError(f"both tables have {', '.join(clash)}: choose another suffix")
    keyed = source.withColumn("__key", F.col(id).cast("string"))
    right = results.withColumnsRenamed({**renamed, custom_id: "__key"})
    return keyed.join(right.hint("merge"), "__key", how).drop("__key")


def completeness(requests: DataFrame, results: DataFrame, id: str,
                 custom_id: str = "custom_id") -> DataFrame:
    """Ids that did not come back exactly once: missing, unknown or repeated.

    Both sides are counted per id in one aggregation, so repeats of one id, however many,
    combine before the shuffle.
    """
    asked = requests.select(F.col(id).cast("string").alias("custom_id"),
                            F.lit(1).alias("asked"), F.lit(0).alias("came"))
    came = results.select(F.col(custom_id).cast("string").alias("custom_id"),
                          F.lit(0).alias("asked"), F.lit(1).alias("came"))
    counted = asked.unionAll(came).groupBy("custom_id").agg(
        F.sum("asked").cast("bigint").alias("n_requests"),
        F.sum("came").cast("bigint").alias("n_results"))
    state = F.when(F.col("n_results") == 0, "missing").when(F.col("n_requests") == 0, "unknown") \
        .otherwise("repeated")
    return counted.where("n_requests <> 1 or n_results <> 1").withColumn("state", state)


def response_counts(requests: DataFrame, results: DataFrame) -> DataFrame:
    """How many requests and how many results there are."""
    asked = requests.select(F.lit(1).alias("a"), F.lit(0).alias("c"))
    came = results.select(F.lit(0).alias("a"), F.lit(1).alias("c"))
    return asked.unionAll(came).agg(
        F.coalesce(F.sum("a"), F.lit(0)).cast("bigint").alias("n_requests"),
        F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("n_results"))


def run_difference(first: DataFrame, second: DataFrame, id: str,
                   vector: str = "embedding") -> DataFrame:
    """Largest per-dimension gap between two embedding runs, per id."""
    return first.select(id, F.col(vector).alias("__a")) \
        .join(second.select(id, F.col(vector).alias("__b")), id) \
        .select(id, max_abs_difference(F.col("__a"), F.col("__b")).alias("max_abs_diff"))


def bind_rows(*tables: DataFrame) -> DataFrame:
    """Rows of all tables; a column some lack is NULL there."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out
