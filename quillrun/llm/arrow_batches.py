"""How many rows meet in one Arrow batch while an operator writes a table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of at most ``rows`` for what is written inside, so that whole texts, of which some are
    very long, take little memory beside the JVM; the session's setting comes back afterwards."""
    before = spark.conf.get(ROWS)
    spark.conf.set(ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ROWS, before)
