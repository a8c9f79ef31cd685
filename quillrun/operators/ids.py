"""Rules a custom id has to meet before a batch is sent."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun.session import materialise

# \z and not $: in Java a $ also matches before a trailing newline.
MESSAGES_ID = r"^[a-zA-Z0-9_-]{1,64}\z"
EXAMPLES = 3
LARGE_RUN = 10_000  # fixed value: requests from which on a run is said to be large


class LargeRun(UserWarning):
    """A run of many requests."""


def duplicate_ids(df: DataFrame, id: str) -> DataFrame:
    """Ids that occur more than once, with how often. Counts combine before the shuffle."""
    return df.groupBy(id).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def duplicate_report(df: DataFrame, id: str, examples: int = EXAMPLES) -> DataFrame:
    """The first few duplicated ids and, on each row, how many there are in all."""
    found = materialise(duplicate_ids(df, id), "duplicates")  # one scan and count for both
    shown = found.orderBy(id).limit(examples)
    return shown.withColumn("n_duplicates", found.agg(F.count(F.lit(1))).scalar())


def is_messages_id(id: Column) -> Column:
    return F.coalesce(id.cast("string").rlike(MESSAGES_ID), F.lit(False))


def id_violations(df: DataFrame, id: str, messages_rules: bool = False) -> DataFrame:
    """(rule, custom_id, n): missing and duplicated ids, and badly formed ones under the messages
    rules. ``n`` is how many rows have the id. One count per id serves all rules.
    """
    counted = df.groupBy(id).agg(F.count(F.lit(1)).alias("n"))
    here = F.col(id).isNotNull()
    broken = [F.when(~here, F.lit("missing")), F.when(here & (F.col("n") > 1), F.lit("duplicate"))]
    if messages_rules:
        broken.append(F.when(here & ~is_messages_id(F.col(id)), F.lit("format")))
    return counted.select(
        F.explode(F.array_compact(F.array(*broken))).alias("rule"),
        F.col(id).cast("string").alias("custom_id"), "n")


def enforce_ids(df: DataFrame, id: str, messages_rules: bool = False) -> DataFrame:
    """The table unchanged, or an error naming how many ids break a rule and the first three. Ids are
    counted once, and what breaks a rule is stored."""
    broken = materialise(id_violations(df, id, messages_rules), "violations")
    counts = {r["rule"]: r["k"] for r in
              broken.groupBy("rule").agg(F.count(F.lit(1)).alias("k")).collect()}
    for rule, text in (("missing", "kind of row has no id, and every request needs an id"),
                       ("duplicate", "ids are used by more than one request"),
                       ("format", "ids do not match " + MESSAGES_ID)):
        if counts.get(rule):
            shown = [r["custom_id"] for r in broken.where(F.col("rule") == rule)
                     .orderBy("custom_id").limit(EXAMPLES).collect()]
            raise ValueError(f"{counts[rule]} {text}, for example {', '.join(map(str, shown))}")
    return df


def notice_size(n_requests: int) -> bool:
    """Whether so many requests take a provider long, which a warning then says."""
    if n_requests <= LARGE_RUN:
        return False
    warnings.warn(f"{n_requests:,} requests are a lot for one run: a provider may need hours for them",
                  LargeRun, stacklevel=3)
    return True
