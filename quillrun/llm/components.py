"""Connected components of a table of edges by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrun.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` (the least node reachable) for every node of ``edges`` (``a``, ``b``).

    Each round every node takes its least neighbour's name, edges are renamed and loops and repeats
    dropped, so the table shrinks until it is empty; then the names are followed. A node with very many
    edges is only ever a key of a minimum, which combines before the shuffle, or of a join.
    """
    left = materialise(edges.where("a <> b").select(F.least("a", "b").alias("a"),
                                                    F.greatest("a", "b").alias("b")).distinct(), "edges")
    names: DataFrame | None = None
    while not left.isEmpty():
        step = materialise(
            left.select(F.col("a").alias("node"), F.col("b").alias("near"))
            .unionByName(left.select(F.col("b").alias("node"), F.col("a").alias("near")))
            .groupBy("node").agg(F.min("near").alias("near"))
            .select("node", F.least("node", "near").alias("name")), "names")
        left = materialise(
            left.join(step.select(F.col("node").alias("a"), F.col("name").alias("x")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("name").alias("y")), "b")
            .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(), "edges")
        if names is None:
            names = step.withColumnRenamed("name", "label")
        else:
            names = materialise(
                names.join(step.select(F.col("node").alias("label"), "name"), "label", "left")
                .select("node", F.coalesce("name", "label").alias("label")), "labels")
    if names is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("label")).where(F.lit(False))
    return names
