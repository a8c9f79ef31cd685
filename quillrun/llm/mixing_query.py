"""The query of the mixing operator, and its SQL, which rakes by window sums in a recursive query."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrun.llm.raking import MAX_SWEEPS, NONE, OTHER, SETTLED, calibrated, text_shape
from quillrun.llm.registry import query, table

BUDGET = 0.5
SEED = 20
TARGETS = {
    "source": {f"src{i}": (0.10 if i == 0 else 0.045) for i in range(20)},
    "lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2},
    "topic": {"prose": 0.85, "list": 0.05, "symbols": 0.05, "shouting": 0.05},
}


def margins():
    return {"source": (F.col("source"), TARGETS["source"]), "lang": (F.col("lang"), TARGETS["lang"]),
            "topic": (text_shape(F.col("text")), TARGETS["topic"])}


def _category_sql(column: str, target: dict[str, float]) -> str:
    names = ", ".join(f"'{c}'" for c in target)
    return (f"CASE WHEN {column} IS NULL THEN '{NONE}' WHEN {column} IN ({names}) THEN {column} "
            f"ELSE '{OTHER}' END")


def _factor_sql(goal: str, cap: str, weight: str, group: str, tie: str) -> tuple[str, str]:
    """Two window sums, and over them the factor at which the group's weights, cut at their caps, sum to
    ``goal``. That sum grows with the factor along a concave curve, the least of the lines in which the
    first k members to fill up are cut; so the factor is the largest at which one of them meets the goal."""
    by = f"{group} ORDER BY {cap} / {weight}, {tie} ROWS BETWEEN"
    sums = (f"coalesce(sum({cap}) OVER ({by} UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_, "
            f"sum({weight}) OVER ({by} CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_")
    return sums, f"max(({goal} - full_) / rest_) OVER ({group})"


def _goals_sql(name: str, target: dict[str, float]) -> str:
    """Tokens to draw from each category of a margin: shares of the budget, none above what is there."""
    cases = " ".join(f"WHEN '{c}' THEN {v!r}" for c, v in target.items())
    unnamed = f"{name} IN ('{OTHER}', '{NONE}')"
    sums, level = _factor_sql("budget", "tokens", "share", "", name)
    return f"""{name}_goals AS (
  SELECT {name}, least(tokens, share * {level}) AS goal_{name}
  FROM (SELECT *, {sums} FROM (
    SELECT *, CASE WHEN {unnamed} THEN tokens ELSE (CASE {name} {cases} END) / {sum(target.values())!r}
              * (sum(tokens) OVER () - coalesce(sum(tokens) FILTER (WHERE {unnamed}) OVER (), 0)) END AS share
    FROM (SELECT {name}, sum(tokens) AS tokens FROM cells GROUP BY {name})), budget))"""


def raking_sql() -> str:
    """Sweeps over the margins as one recursive query, until no cell's tokens change."""
    names, sweep = list(TARGETS), "(SELECT * FROM raked WHERE moved > limit_)"
    for name in names:
        sums, factor = _factor_sql(f"goal_{name}", "tokens", "x", f"PARTITION BY {name}", ", ".join(n for n in names if n != name))
        sweep = (f"(SELECT * REPLACE (greatest(tokens * 1e-100, least(tokens * 1e100, x * {factor})) AS x) "
                 f"FROM (SELECT * EXCLUDE (full_, rest_), {sums} FROM {sweep}))")
    keys, goals = ", ".join(names), ", ".join(f"goal_{n}" for n in names)
    shape = ("CASE WHEN contains(text, ' | ') THEN 'list' WHEN contains(text, '!! ') THEN 'shouting' "
             "WHEN regexp_matches(text, '[#$%&*]{3} ') THEN 'symbols' ELSE 'prose' END")
    return f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, {_category_sql('source', TARGETS['source'])} AS source,
         {_category_sql('lang', TARGETS['lang'])} AS lang, {shape} AS topic,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens,
         CAST(('0x' || substr(md5('{SEED}/' || coalesce(CAST(doc_id AS VARCHAR), '') || '/' ||
              md5(coalesce(text, ''))), 1, 13)) AS BIGINT) / 4503599627370496.0 AS drawn
  FROM documents),
cells AS MATERIALIZED (
  SELECT {keys}, CAST(sum(tokens) AS DOUBLE) AS tokens FROM docs GROUP BY ALL HAVING sum(tokens) > 0),
budget AS MATERIALIZED (SELECT {BUDGET} * sum(tokens) AS budget FROM cells),
{", ".join(_goals_sql(n, t) for n, t in TARGETS.items())},
raked AS (
  SELECT {keys}, tokens, {goals}, tokens AS x, CAST(0 AS DOUBLE) AS taken, CAST('inf' AS DOUBLE) AS moved,
         {SETTLED!r} * budget AS limit_, 0 AS sweep, CAST(0 AS DOUBLE) AS full_, CAST(0 AS DOUBLE) AS rest_
  FROM cells {" ".join(f"JOIN {n}_goals USING ({n})" for n in names)}, budget
  UNION ALL
  SELECT {keys}, tokens, {goals}, x, least(tokens, x), max(abs(least(tokens, x) - taken)) OVER (),
         limit_, sweep + 1, full_, rest_
  FROM {sweep} WHERE sweep < {MAX_SWEEPS}),
chances AS (
  SELECT {keys}, CASE WHEN taken / tokens > 1 - 1e-9 THEN 1.0 ELSE taken / tokens END AS chance
  FROM raked WHERE sweep = (SELECT max(sweep) FROM raked))
SELECT doc_id, {keys}, tokens, CAST(round(probability, 6) AS DOUBLE) AS probability, drawn < probability AS kept
FROM (SELECT *, CASE WHEN tokens > 0 THEN coalesce(chance, 0) ELSE 0 END AS probability
      FROM docs LEFT JOIN chances USING ({keys}))
"""


@query("op5_raked_mixture", raking_sql())
def op5_raked_mixture(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return calibrated(docs, margins(), BUDGET, SEED, whole=True).select(
        "row.doc_id", F.col("margin_source").alias("source"), F.col("margin_lang").alias("lang"),
        F.col("margin_topic").alias("topic"), "tokens", F.round("probability", 6).alias("probability"),
        "kept")
