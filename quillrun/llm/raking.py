"""Mixing sources to target weights by iterative proportional fitting (DataFrame functions only).

Tokens (words) are summed per cell of the margins' categories, cell weights are raked in turn to each
margin's target shares until they settle, and a document is drawn with the probability that gives its
cell the raked share of the token budget. What a document draws is a hash of its id, text and the
seed, so a retried task or another layout of the files draws the same documents.

Categories are those that the targets name, one for all other names and one for null, so the table of
cells has at most the product of the margins' sizes plus two each (checked against ``MAX_CELLS``)
whatever the data; it is broadcast and raked as one row.

The raking is bounded (``whole``, as is unless set otherwise): no cell gets more than its tokens, and what a full cell can't
supply goes to the margin's other cells. Each step multiplies a category's cells by the factor at which
they, cut at their tokens, sum to its goal; steps go on until no cell changes (``MAX_SWEEPS`` at most).
The few cells come to the driver for it. Goals that no weights reach, alone or together, are named in a
warning and in ``margin_report``; what a margin's full categories can't supply goes to its others.

Names that no target lists and nulls keep the share of tokens that they have, and the
named categories share the rest in proportion to their targets; so nothing with words in a named or
unnamed category of positive target has probability zero. ``whole=False`` is plain raking, ``SWEEPS`` times,
for targets that are meant to the letter: other names and nulls get what the targets leave over, a cell
whose share exceeds its tokens is cut, and what it lacks is drawn nowhere.

Defined cases: a category without documents leaves its share to the margin's others; a null text has no
tokens and probability zero; copies with the same id and text are drawn together; an empty table gives an
empty result. A cell whose budget exceeds its tokens is taken whole.
"""

from __future__ import annotations

import json
import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from quillrun.session import materialise

MAX_CELLS = 10_000
SWEEPS = 25
MAX_SWEEPS = 2_000
SETTLED = 1e-9       # of the tokens drawn
REACHED = 1e-4       # as a share
OTHER, NONE = "(other)", "(none)"


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def text_shape(text: Column) -> Column:
    """A coarse topic from the form of a text: lists, shouting, symbols or prose."""
    return (F.when(text.contains(" | "), "list").when(text.contains("!! "), "shouting")
            .when(text.rlike(r"[#$%&*]{3} "), "symbols").otherwise("prose"))


def _category(column: Column, target: dict[str, float]) -> Column:
    name = column.cast("string")
    return F.when(name.isNull(), NONE).when(name.isin(*target), name).otherwise(OTHER)


def _rake(names: list[str], targets: list[dict[str, float]], sweeps: int) -> str:
    """SQL over the arrays ``tokens`` and one array of categories per margin: the raked weights."""
    steps = "w"
    for name, target in zip(names, targets):
        left = max(0.0, 1.0 - sum(target.values()))
        cases = " ".join(f"WHEN '{c}' THEN {float(v)!r}D" for c, v in target.items())
        goal = f"CASE {{c}} {cases} ELSE {left / 2!r}D END"
        # sums by category, bound once, then each cell times goal / sum; the row is normalised after
        sums = (f"map_from_entries(transform(array_distinct({name}), c -> struct(c, "
                f"aggregate(zip_with(w, {name}, (x, y) -> IF(y = c, x, 0D)), 0D, (a, x) -> a + x))))")
        scaled = (f"zip_with(w, {name}, (x, y) -> IF(m[y] > 0, x * ({goal.format(c='y')}) / m[y], 0D))")
        step = f"transform(array({sums}), m -> {scaled})[0]"
        steps = f"transform(array({steps}), w -> {step})[0]"
    total = "aggregate(w, 0D, (a, x) -> a + x)"
    unit = f"transform(array({total}), t -> transform(w, x -> IF(t > 0, x / t, 0D)))[0]"
    return (f"aggregate(sequence(1, {sweeps}), tokens, (w, k) -> "
            f"transform(array({steps}), w -> {unit})[0])")


def _check_size(targets: list[dict[str, float]]) -> None:
    most = math.prod(len({*t, OTHER, NONE}) for t in targets)
    if most > MAX_CELLS:
        raise ValueError(f"the targets span {most} cells, more than {MAX_CELLS}")


def with_unnamed(cells: list[Row], name: str, target: dict[str, float]) -> dict[str, float]:
    """``target`` with the share of tokens that other names and nulls have, the rest scaled to fit."""
    total = sum(c["tokens"] for c in cells)
    own = {k: sum(c["tokens"] for c in cells if c[name] == k) / total if total else 0.0
           for k in (OTHER, NONE)}
    named = sum(target.values())
    scale = (1.0 - sum(own.values())) / named if named else 0.0
    return {**{k: v * scale for k, v in target.items()}, **own}


def _filled(caps: np.ndarray, target: np.ndarray, budget: float) -> np.ndarray:
    """Goals in the ratio of ``target`` that sum to ``budget``, none above its cap."""
    goal, open_ = np.zeros(len(caps)), (target > 0) & (caps > 0)
    left = budget
    while open_.any() and left > 0:
        share = left * target / target[open_].sum()
        full = open_ & (share >= caps)
        if not full.any():
            goal[open_] = share[open_]
            break
        goal[full] = caps[full]
        left -= caps[full].sum()
        open_ &= ~full
    return goal


def _factor(x: np.ndarray, caps: np.ndarray, goal: float) -> float:
    """The factor at which ``min(caps, factor * x)`` sums to ``goal``."""
    at = caps / x
    order = np.argsort(at)
    at, x, caps = at[order], x[order], caps[order]
    full = np.concatenate([[0.0], np.cumsum(caps)])      # by number of cells that are full
    rest = np.concatenate([np.cumsum(x[::-1])[::-1], [0.0]])
    reached = full[:-1] + rest[:-1] * at                 # the sum when the next cell fills up
    k = int(np.searchsorted(reached, goal * (1 - 1e-13)))
    return float(at[-1]) if k == len(x) else (goal - full[k]) / float(rest[k])


def bounded_chances(tokens: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray],
                    budget: float) -> np.ndarray:
    """Probability per cell. ``codes`` hold each margin's category per cell, ``targets`` its shares."""
    live = tokens > 0
    for code, target in zip(codes, targets):
        live &= target[code] > 0
    goals = [_filled(np.bincount(c[live], tokens[live], len(t)), t, budget) for c, t in zip(codes, targets)]
    members = [[np.flatnonzero(live & (code == j)) for j in range(len(goal))] for code, goal in zip(codes, goals)]
    x, drawn = np.where(live, tokens, 0.0), np.zeros(len(tokens))
    for _ in range(MAX_SWEEPS):
        for lists, goal in zip(members, goals):
            for j, cells in enumerate(lists):
                if len(cells):
                    scaled = x[cells] * _factor(x[cells], tokens[cells], goal[j])
                    # kept in range where goals contradict each other
                    x[cells] = np.clip(scaled, tokens[cells] * 1e-100, tokens[cells] * 1e100)
        before, drawn = drawn, np.minimum(tokens, x)
        if np.abs(drawn - before).max(initial=0.0) <= SETTLED * budget:
            break
    chance = np.divide(drawn, tokens, out=np.zeros(len(tokens)), where=live)
    return np.where(chance > 1 - 1e-9, 1.0, chance)


def _bounded(cells: DataFrame, names: list[str], targets: list[dict[str, float]], budget: float
             ) -> tuple[list[Row], np.ndarray, list[tuple[str, str, float, float]]]:
    """Cells, their probabilities, and (margin, category, share wanted, share reached)."""
    _check_size(targets)
    found = sorted(cells.collect(), key=lambda r: tuple(r[n] for n in names))
    tokens = np.array([r["tokens"] or 0 for r in found], dtype=float)
    whole = [with_unnamed(found, n, t) for n, t in zip(names, targets)]
    kinds = [list(t) for t in whole]
    codes = [np.array([k.index(r[n]) for r in found], dtype=np.int64) for n, k in zip(names, kinds)]
    chances = bounded_chances(tokens, codes, [np.array(list(t.values())) for t in whole], budget * tokens.sum())
    drawn = tokens * chances
    total = budget * tokens.sum() or 1.0
    report = [(n, k, share, float(s) / total) for n, c, t in zip(names, codes, whole)
              for (k, share), s in zip(t.items(), np.bincount(c, drawn, len(t)))]
    return found, chances, report


def _missed(report: list[tuple[str, str, float, float]]) -> list[tuple[str, str, float, float]]:
    return [r for r in report if abs(r[2] - r[3]) > REACHED]


def margin_report(docs: DataFrame, margins: dict[str, tuple[Column, dict[str, float]]], budget: float,
                  text_col: str = "text") -> DataFrame:
    """``margin``, ``category``, ``wanted`` and ``expected`` shares of the token budget with ``whole``,
    and ``reached``: false where no weights within the cells' tokens meet all goals."""
    names = [f"margin_{m}" for m in margins]
    targets = [t for _, t in margins.values()]
    cells = docs.select(*[_category(c, t).alias(n) for n, (c, t) in zip(names, margins.values())],
                        token_count(F.col(text_col)).alias("tokens")).groupBy(*names).agg(
        F.sum("tokens").alias("tokens"))
    report = _bounded(cells, names, targets, budget)[2]
    missed = {r[:2] for r in _missed(report)}
    return docs.sparkSession.createDataFrame(
        [(n.removeprefix("margin_"), k, float(w), float(e), (n, k) not in missed) for n, k, w, e in report],
        "margin string, category string, wanted double, expected double, reached boolean")


def _chances(cells: DataFrame, names: list[str], targets: list[dict[str, float]], budget: float) -> DataFrame:
    """The cells' categories and ``chance``, as a constant of the plan."""
    found, chances, report = _bounded(cells, names, targets, budget)
    if found and (missed := [r for r in _missed(report) if r[3] < r[2]]):
        warnings.warn("mixing goals not reached: " + ", ".join(
            f"{n.removeprefix('margin_')} {k} {e:.4f} of {w:.4f}" for n, k, w, e in missed), stacklevel=2)
    rows = json.dumps([{**{n: r[n] for n in names}, "chance": float(p)} for r, p in zip(found, chances)])
    shape = "array<struct<" + ", ".join([*[f"`{n}`: string" for n in names], "chance: double"]) + ">>"
    return cells.sparkSession.range(1, numPartitions=1).select(
        F.explode(F.from_json(F.lit(rows), shape)).alias("c")).select("c.*")


def raked_cells(cells: DataFrame, names: list[str], targets: list[dict[str, float]],
                sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (categories and ``tokens``) with ``share``: the raked share of tokens, summing to 1."""
    _check_size(targets)
    lists = cells.agg(F.sort_array(F.collect_list(F.struct(*names, F.col("tokens").cast("double")
                                                           .alias("tokens")))).alias("cells"))
    arrays = lists.select("cells", *[F.col(f"cells.{n}").alias(n) for n in [*names, "tokens"]])
    shares = arrays.select("cells", F.expr(_rake(names, targets, sweeps)).alias("share"))
    return (shares.select(F.explode(F.arrays_zip("cells", "share")).alias("c"))
            .select(*[F.col(f"c.cells.{n}").alias(n) for n in names],
                    F.col("c.cells.tokens").alias("tokens"), F.col("c.share").alias("share")))


def drawn(id_col: str, text_col: str, seed: int) -> Column:
    """A number from 0 up to 1 that a document's id, text and the seed decide."""
    key = F.concat_ws("/", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                      F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / float(1 << 52)


def calibrated(docs: DataFrame, margins: dict[str, tuple[Column, dict[str, float]]], budget: float,
               seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
               whole: bool = True) -> DataFrame:
    """``row`` (the whole document), its categories, ``tokens``, ``probability``, ``drawn``, ``kept``.

    ``margins`` maps a name to a column and its target shares; ``budget`` is the share of all tokens
    that the sample should hold.
    """
    names = [f"margin_{m}" for m in margins]
    targets = [t for _, t in margins.values()]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        *[_category(c, t).alias(n) for n, (c, t) in zip(names, margins.values())],
        token_count(F.col(text_col)).alias("tokens"), drawn(id_col, text_col, seed).alias("drawn"))
    cells = rows.groupBy(*names).agg(F.sum("tokens").alias("tokens"))
    if whole:
        placed = rows.join(F.broadcast(_chances(cells, names, targets, budget)), names)
        chance = F.col("chance")
    else:
        shares = materialise(raked_cells(cells, names, targets), "raked")
        total = shares.agg(F.sum("tokens")).first()[0] or 0.0
        chance = F.when(F.col("cell_tokens") > 0, F.least(
            F.lit(1.0), F.col("share") * F.lit(budget * total) / F.col("cell_tokens"))).otherwise(0.0)
        placed = rows.join(F.broadcast(shares.withColumnRenamed("tokens", "cell_tokens")), names)
    return (placed.withColumn("probability", F.when(F.col("tokens") > 0, chance).otherwise(0.0))
            .withColumn("kept", F.col("drawn") < F.col("probability"))
            .select("row", *names, "tokens", "probability", "drawn", "kept"))


def mix_sources(docs: DataFrame, margins: dict[str, tuple[Column, dict[str, float]]], budget: float,
                seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
                whole: bool = True) -> DataFrame:
    """The documents drawn, all columns as they were."""
    return calibrated(docs, margins, budget, seed, id_col, text_col, whole).where("kept").select("row.*")
