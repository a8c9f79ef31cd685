"""Merkle manifest of a table: a digest per row, a tree per group, one root, and a proof per row.

A leaf is the SHA-256 of a row's fields. Within a group the leaves ascend by id; every 8 consecutive
nodes become the digest of their hex digests until one is left, and the groups' digests become one
root likewise. A row's proof is the run-mates that it needs at each level, so whoever holds a row, its
proof and the root can tell whether the row is as it was.

Positions come from sampled key ranges (`with_position`), so a group may hold any share of the rows.
512 consecutive nodes are an aligned block, and a block keeps each of its levels as one string of hex
digests: fixed-width substrings hash into the next level, and the substrings that flank a node are its
siblings. The last digests of the blocks are nodes of the next round, a 512th as many, until every
group has one. No task holds more than a block, and what joins back down a round is a 512th of the rows.

Defined cases: a null field is ``-`` and a null group is a group of its own, the first; rows with null
ids come first in their group; rows of one id follow each other by leaf; repeated rows are a leaf each;
a group of one row has that leaf as its digest; an empty table has no root and no proofs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun.operators.positions import with_position
from quillrun.session import materialise

FAN = 8
DIGITS = 64             # of a digest
DEPTH = 3               # levels that a block builds
BLOCK = FAN ** DEPTH
RUN = FAN * DIGITS


def field(value: Column) -> Column:
    """A value as its length and text, so that no two lists of fields read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


@dataclass(frozen=True)
class Manifest:
    """``groups``: group, n_rows, subroot. ``root``: None for an empty table. ``rounds`` and ``above``
    are the tables of blocks, of the groups' trees and of the tree over the groups."""

    groups: DataFrame
    root: str | None
    rounds: list[DataFrame]
    above: list[DataFrame]


def _parents(level: str) -> Column:
    return F.expr(f"array_join(transform(sequence(0, (length({level}) - 1) div {RUN}), "
                  f"i -> sha2(substring({level}, cast(i * {RUN} + 1 AS int), {RUN}), 256)), '')")


def _blocks(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """``nodes``: tree, place (from 0), total, node and what else each carries. One row per block."""
    member = F.struct("place", "node", *carried)
    blocks = (nodes.groupBy("tree", "total", F.expr(f"place div {BLOCK}").alias("block"))
              .agg(F.array_sort(F.collect_list(member)).alias("members"))
              .withColumn("level0", F.array_join(F.transform("members", lambda m: m["node"]), "")))
    steps = F.lit(DEPTH)
    for depth in range(DEPTH - 1, -1, -1):
        steps = F.when(F.col("total") <= FAN ** depth, depth).otherwise(steps)
    blocks = blocks.withColumn("steps", steps).withColumn(
        "members", F.transform("members", lambda m: F.struct(m["place"].alias("place"), *[
            m[c].alias(c) for c in carried])))
    for k in range(1, DEPTH + 1):
        blocks = blocks.withColumn(f"level{k}", F.when(F.col("steps") >= k, _parents(f"level{k - 1}")))
    return blocks.withColumn("top", F.coalesce(*[f"level{k}" for k in range(DEPTH, -1, -1)]))


def _grow(nodes: DataFrame, carried: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of blocks up to one node a tree, and those nodes."""
    rounds = []
    while True:
        rounds.append(materialise(_blocks(nodes, carried), "merkle"))
        carried = []
        nodes = rounds[-1].select("tree", F.col("block").alias("place"),
                                  F.ceil(F.col("total") / BLOCK).cast("long").alias("total"),
                                  F.col("top").alias("node"))
        if not (nodes.agg(F.max("total")).first()[0] or 0) > 1:
            return rounds, nodes


def build_manifest(docs: DataFrame, fields: list[str], group_col: str = "lang", id_col: str = "doc_id",
                   claimed: Column | None = None) -> Manifest:
    """``claimed``: a leaf that each row is to be verified with, where it isn't its own."""
    own = leaf_digest([F.col(f"`{f}`") for f in fields])
    other = F.lit(None).cast("string") if claimed is None else claimed
    leaves = materialise(docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("group"),
                                     own.alias("node"), other.alias("claimed")), "leaves")
    counts = materialise(leaves.groupBy("group").agg(F.count("*").alias("n_rows")), "groups")
    groups = materialise(with_position(counts, "group", "tree", {"first": F.col("n_rows")}), "groups")
    placed = with_position(leaves, ["group", "id", "node", "claimed"])
    # few groups are broadcast by their size on disk, many are joined by shuffle
    placed = (placed.alias("l").join(groups.alias("g"), F.expr("l.group <=> g.group"))
              .select("tree", (F.col("position") - 1 - F.col("first")).alias("place"),
                      F.col("n_rows").alias("total"), "node", "id", "claimed"))
    rounds, tops = _grow(placed, ["id", "claimed"])
    groups = materialise(groups.join(tops, "tree").select(
        "tree", "group", "n_rows", F.col("node").alias("subroot")), "groups")
    n_groups = groups.count()
    above, top = _grow(groups.select(
        F.lit(0).cast("long").alias("tree"), (F.col("tree") - 1).alias("place"),
        F.lit(n_groups).cast("long").alias("total"), F.col("subroot").alias("node")), [])
    root = top.first()
    return Manifest(groups, root["node"] if root else None, rounds, above)


def _segments(blocks: DataFrame) -> Column:
    """What stands before and after a member in its run, level by level."""
    found = []
    for k in range(DEPTH):
        index = F.expr(f"cast(member.place % {BLOCK} AS int) div {FAN ** k}")
        run, level = F.floor(index / FAN) * RUN, F.col(f"level{k}")
        end = (index + 1) * DIGITS
        found.append(F.struct(
            F.substring(level, (run + 1).cast("int"), (index * DIGITS - run).cast("int")).alias("before"),
            F.substring(level, (end + 1).cast("int"), (run + RUN - end).cast("int")).alias("after")))
    return F.slice(F.array(*found), F.lit(1), F.col("steps"))


def _paths(rounds: list[DataFrame], above: DataFrame | None) -> DataFrame:
    """One row per node of the lowest round: tree, what it carries, and ``path``. ``above``: the paths
    of the trees' last nodes, as ``tree`` and ``path``."""
    found = None
    for blocks in reversed(rounds):
        levels = {f"level{k}": F.col(f"level{k}").cast("binary") for k in range(DEPTH)}
        if found is not None:
            blocks = blocks.join(found.select("tree", F.col("place").alias("block"),
                                              F.col("path").alias("rest")), ["tree", "block"])
        elif above is not None:
            blocks = blocks.join(above.select("tree", F.col("path").alias("rest")), "tree")
        else:
            blocks = blocks.withColumn("rest", F.expr("cast(array() AS array<struct<before:binary,after:binary>>)"))
        members = blocks.withColumns(levels).select(
            "tree", "steps", *levels, "rest", F.explode("members").alias("member"))
        found = members.select("tree", "member.*", F.concat(_segments(blocks), F.col("rest")).alias("path"),
                               F.expr(f"substring(level0, cast(member.place % {BLOCK} AS int) * {DIGITS} + 1, "
                                      f"{DIGITS})").cast("string").alias("node"))
    return found


def proofs(manifest: Manifest) -> DataFrame:
    """One row per row: ``id``, ``group``, ``leaf``, ``claimed`` (null: the leaf itself), ``subroot``,
    ``root`` and ``path``, an array of the hex digests ``before`` and ``after``, from leaf to root."""
    over = _paths(manifest.above, None).select((F.col("place") + 1).alias("tree"), "path")
    own = _paths(manifest.rounds, over).join(manifest.groups, "tree")
    return own.select("id", "group", F.col("node").alias("leaf"), "claimed", "subroot",
                      F.lit(manifest.root).cast("string").alias("root"), "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(
        F.concat(s["before"], node.cast("binary"), s["after"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings' digests, level by level and from left to right."""
    return F.sha2(F.aggregate(path, F.lit("").cast("binary"), lambda text, s: F.concat(
        text, s["before"], s["after"])), 256)
