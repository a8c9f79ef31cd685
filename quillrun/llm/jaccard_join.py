"""Exact n-gram Jaccard join with set-relation skipping, as classes of linked documents.

Two documents link when their sets of word shingles have a Jaccard similarity of ``percent`` or more.
The join runs on distinct sets in three steps, none of which drops a possible link.

1. *Census.* Every text's set is built once; half of its shingles (all, if it is small) go, packed per
   task, to the task that owns their hash range, which tells each set how many of them any other set
   has too. A partner shares all but a few of a set's shingles, so a set with too few shared ones has
   no partner. Only the texts of the others are read again, found by a Bloom filter of their ids.
2. *Groups.* On the sets that are left, shingles are ordered from rare to common and only prefixes that
   every pair must share are indexed. Sets that share an index entry are candidates; chains of them
   (each list joined to its least member, so lists never become pairs) are candidate groups.
3. *Cells.* A group is joined in cells of about ``CELL`` sets, in order of size. Index lists hold the
   positions of their sets in that order. Lists are counted whole, and of the counts those of sets too
   small to match are skipped, up to the first position that can match. A set that is much like the one before it doesn't count its overlaps anew: they are the other
   set's, plus the lists of shingles it has more, less the lists of those it has fewer. A cell returns
   a spanning forest of its links. A larger group first has each block joined with itself and with its
   first block; then only sets outside the class that most sets are in meet all blocks of the group.

Shingles are 64-bit hashes, sets are recognised by 128-bit sums.

Defined cases: a text without words, or null, has an empty set, links with nothing and is its own
class; fewer than ``width`` words are one shingle; copies are one set and cost one set's work; a class
is named by its smallest id, null only if no member has one; rows that repeat an id keep a class each
by their text; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrun.llm import bitmaps, words
from quillrun.llm.arrow_batches import batches_of
from quillrun.llm.components import components
from quillrun.session import materialise

WIDTH, PERCENT = 5, 75
BYTES_AT_ONCE = 1 << 18
SETS_PER_PACK = 1 << 15
TOKENS_PER_PACK = 1 << 20
BYTES_PER_RANGE = 16 << 20   # text per hash range of the census
TEXTS_PER_BATCH = 1000
SMALL_SET = 64               # sets up to this size send all their shingles
CELL = 1024

CENSUS = ("kind int, doc_id long, pack long, place int, n int, need int, sum1 long, sum2 long, "
          "hash_range int, hashes binary, places binary")
KEY = ["sum1", "sum2", "n"]
ROW_KEY = "__row_key"


def least_overlap(n: np.ndarray | int, percent: int):
    """What a set of n shares with any partner at least."""
    return -(-n * percent // 100)


def set_sums(shingles: np.ndarray) -> tuple[int, int]:
    """A 128-bit name of a set, whatever its order."""
    one = words.mix(shingles ^ words.PLACE_VALUE[60]).sum(dtype=np.uint64)
    two = words.mix(shingles + words.PLACE_VALUE[61]).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int | None, np.ndarray]]:
    data, offsets = words.text_bytes(batch.column(1))
    ids = batch.column(0).to_pylist()
    for a, b in words.cut(offsets, BYTES_AT_ONCE):
        part = data[offsets[a]:offsets[b]]
        yield from zip(ids[a:b], words.shingle_sets(part, offsets[a:b + 1] - offsets[a], width))


def _census(width: int, percent: int, bits: int):
    """Rows of kind 0 (a document and its set) and of kind 1 (a task's shingles of one hash range)."""
    small = SMALL_SET * percent // 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 24
        count, seen, sent, owners, tokens, rows = 0, {}, [], [], 0, []

        def flush() -> list[pa.RecordBatch]:
            nonlocal count, seen, sent, owners, tokens, rows
            out = [_rows(0, rows)] if rows else []
            if sent:
                flat, place = np.concatenate(sent), np.repeat(np.arange(len(sent), dtype=np.uint16),
                                                              [len(s) for s in sent])
                order = np.argsort(flat)
                flat, place = flat[order], place[order]
                part = (flat >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(flat), np.int64)
                cuts = np.searchsorted(part, np.arange((1 << bits) + 1))
                low = ((flat << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
                out.append(_rows(1, [
                    (None, first + count, None, None, None, None, None, p, low[a:b].tobytes(), place[a:b].tobytes())
                    for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]))
            count, seen, sent, tokens, rows = count + 1, {}, [], 0, []
            return out

        for batch in batches:
            for doc_id, shingles in _sets(batch, width):
                n = len(shingles)
                if not n:
                    rows.append((doc_id, None, None, 0, None, 0, 0, None, None, None))
                    continue
                name = (*set_sums(shingles), n)
                if name not in seen:
                    half = shingles[(shingles & np.uint64(1)) == 0]
                    overlap = least_overlap(n, percent)
                    need = overlap if n <= small else len(half) - (n - overlap)
                    mine = shingles if n <= SMALL_SET else half
                    seen[name] = (len(sent), need)
                    sent.append(mine)
                    tokens += len(mine)
                place, need = seen[name]
                rows.append((doc_id, first + count, place, n, need, name[0], name[1], None, None, None))
                if len(sent) >= SETS_PER_PACK or tokens >= TOKENS_PER_PACK or len(rows) >= 4 * SETS_PER_PACK:
                    yield from flush()
        yield from flush()
        pa.default_memory_pool().release_unused()  # workers stay for the next stages

    return run


def _rows(kind: int, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(),
             pa.binary(), pa.binary()]
    names = [c.split()[0] for c in CENSUS.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(rows), pa.int32()), *[pa.array(c, t) for c, t in zip(columns, kinds)]], names=names)


def _shared_places(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one hash range: how many shingles of each set another set has too, per pack."""
    hashes = [np.frombuffer(h, np.uint32) for h in frame["hashes"]]
    flat = np.concatenate(hashes)
    order = np.argsort(flat, kind="stable")
    ranked = flat[order]
    same = np.zeros(len(flat) + 1, dtype=bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    shared = np.zeros(len(flat), dtype=bool)
    shared[order] = same[1:] | same[:-1]
    out, at = [], 0
    for pack, places, h in zip(frame["pack"], frame["places"], hashes):
        place, count = np.unique(np.frombuffer(places, np.uint16)[shared[at:at + len(h)]], return_counts=True)
        at += len(h)
        if len(place):
            out.append((pack, place.tobytes(), count.astype(np.uint32).tobytes()))
    return pd.DataFrame(out, columns=["pack", "places", "counts"])


def _sum_places(frame: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(1 << 16, dtype=np.int64)
    for places, counts in zip(frame["places"], frame["counts"]):
        total[np.frombuffer(places, np.uint16)] += np.frombuffer(counts, np.uint32)
    place = np.flatnonzero(total)
    return pd.DataFrame({"pack": frame["pack"].iloc[0], "place": place.astype(np.int32), "shared": total[place]})


def _linked_sets(docs: DataFrame, census: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets (key, ``least``, the smallest id), and the sets that may have a partner."""
    members = census.where("kind = 0 AND n > 0")
    counts = (census.where("kind = 1").select("pack", "hash_range", "hashes", "places").groupBy("hash_range")
              .applyInPandas(_shared_places, "pack long, places binary, counts binary")
              .groupBy("pack").applyInPandas(_sum_places, "pack long, place int, shared long"))
    open_ = (members.select("pack", "place", "need", *KEY).distinct()
             .join(counts, ["pack", "place"], "left")
             .where("need <= 0 OR shared >= need").select(*KEY).distinct().withColumn("open", F.lit(True)))
    classes = materialise(
        members.groupBy(*KEY).agg(F.min("doc_id").alias("least")).join(open_, KEY, "left"), "classes")
    wanted = materialise(classes.where("open").select(F.col("least").alias("id")).distinct(), "wanted")
    texts = docs.select(F.col("doc_id"), F.col("text"))
    test, cells = bitmaps.filter_of(wanted, "id", wanted.count(), "wanted-filter")
    found = bitmaps.with_test(texts, F.col("doc_id"), test, cells, "maybe").where("maybe").drop("maybe")
    found = found.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for _, s in _sets(batch, width) if len(s)]
            names = [set_sums(s) for s in sets]
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)]).astype(np.int32)
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([n[0] for n in names], pa.int64()), pa.array([n[1] for n in names], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=[*KEY, "shingles"])
        pa.default_memory_pool().release_unused()

    sets = (found.mapInArrow(build, "sum1 long, sum2 long, n int, shingles array<long>")
            .groupBy(*KEY).agg(F.first("shingles").alias("shingles"))
            .withColumn("sid", F.monotonically_increasing_id()))
    with batches_of(docs.sparkSession, TEXTS_PER_BATCH):
        return classes, materialise(sets, "sets")


def _candidate_groups(sets: DataFrame, percent: int) -> DataFrame:
    """``sid``, ``g``: sets that share an indexed shingle, directly or by a chain, have the same g."""
    entries = sets.select("sid", "n", F.explode("shingles").alias("token"))
    # counts and heads are written, so that joins deal both sides out anew and can split a shingle
    # that a third of all sets has
    counts = materialise(entries.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "counts")
    ranked = (entries.join(counts, "token").groupBy("sid", "n")
              .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens")))
    # shingles that no other set has come first in the order and match nothing
    length = F.expr(f"n - (n * {percent} + 99) div 100 + 1 - (n - size(tokens))").cast("int")
    index = materialise(
        ranked.select("sid", F.explode(F.slice("tokens", F.lit(1), F.greatest(length, F.lit(0)))).alias("t"))
        .select("sid", F.col("t.token").alias("token")), "index")
    heads = materialise(index.groupBy("token").agg(F.min("sid").alias("head"), F.count("*").alias("n"))
                        .where("n > 1").drop("n"), "heads")
    edges = index.join(heads, "token").where("sid <> head").select(
        F.col("sid").alias("a"), F.col("head").alias("b"))
    return components(edges).select(F.col("node").alias("sid"), F.col("label").alias("g"))


def cell_links(sids: np.ndarray, groups: np.ndarray, sets: list[np.ndarray], percent: int
               ) -> list[tuple[int, int]]:
    """A spanning forest of the links among the sets of a cell."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    order = np.lexsort((sids, sizes, groups))
    sids, groups, sizes, sets = sids[order], groups[order], sizes[order], [sets[i] for i in order]
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    by_token = np.argsort(flat, kind="stable")
    tokens, owner_of = flat[by_token], owner[by_token]
    starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    names, ends = tokens[starts], np.append(starts[1:], len(tokens))
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def overlaps(shingles: np.ndarray) -> np.ndarray:
        at = np.searchsorted(names, shingles)
        a, b = starts[at], ends[at]
        length = b - a
        many = length > 1
        a, length = a[many], length[many]
        if not len(a):
            return np.zeros(len(sets), dtype=np.int64)
        places = np.repeat(a - np.cumsum(length) + length, length) + np.arange(int(length.sum()))
        return np.bincount(owner_of[places], minlength=len(sets))

    forest, before, counted = [], None, None
    group_start = np.searchsorted(groups, groups)  # positions of the group's first set
    for i, mine in enumerate(sets):
        if before is not None and groups[i] == groups[i - 1]:
            more, fewer = (np.setdiff1d(mine, before, assume_unique=True),
                           np.setdiff1d(before, mine, assume_unique=True))
            if len(more) + len(fewer) < len(mine):
                counted = counted + overlaps(more) - overlaps(fewer)
            else:
                counted = overlaps(mine)
        else:
            counted = overlaps(mine)
        before = mine
        # skip the positions of sets too small to match, and those not yet reached
        low = int(group_start[i])
        low += int(np.searchsorted(sizes[low:i], least_overlap(int(sizes[i]), percent)))
        common = counted[low:i]
        linked = np.flatnonzero(100 * common >= percent * (sizes[low:i] + sizes[i] - common)) + low
        for j in linked.tolist():
            x, y = find(i), find(j)
            if x != y:
                parent[x] = y
                forest.append((int(sids[i]), int(sids[j])))
    return forest


def _links(percent: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("sid")
        sets = [np.asarray(s, dtype=np.int64) for s in frame["shingles"]]
        found = cell_links(frame["sid"].to_numpy(), frame["g"].to_numpy(), sets, percent)
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return run


def _verified(sets: DataFrame, grouped: DataFrame, percent: int) -> DataFrame:
    """Edges (``a``, ``b``) that connect exactly the sets that links connect."""
    sizes = grouped.groupBy("g").agg(F.count("*").alias("size"))
    total = grouped.count()
    bins = max(1, total // (CELL // 2))
    placed = grouped.join(sizes, "g").withColumn("blocks", F.ceil(F.col("size") / (CELL // 2)).cast("long")
                                                 ).withColumn(
        "block", F.pmod(F.xxhash64("sid"), F.col("blocks")))
    placed = materialise(placed.join(sets.select("sid", "shingles"), "sid"), "placed")
    row = ["sid", "g", "shingles"]
    small = placed.where("blocks = 1").select(*row, F.lit(-1).cast("long").alias("cell_g"), F.pmod(
        F.xxhash64("g"), F.lit(bins)).alias("cell"))
    large = placed.where("blocks > 1").select(*row, F.col("g").alias("cell_g"), F.explode(
        F.when(F.col("block") == 0, F.sequence(F.lit(1).cast("long"), F.col("blocks") - 1))
        .otherwise(F.array("block"))).alias("cell"))
    one = materialise(small.unionByName(large).groupBy("cell_g", "cell").applyInPandas(
        _links(percent), "a long, b long"), "links")
    wide = placed.where("blocks > 1")
    if wide.isEmpty():
        return one
    labels = components(one)
    labelled = materialise(wide.select("sid", "g", "block", "blocks").join(
        labels.select(F.col("node").alias("sid"), "label"), "sid", "left")
        .withColumn("label", F.coalesce("label", "sid")), "labelled")
    most = (labelled.groupBy("g", "label").agg(F.count("*").alias("n"))
            .groupBy("g").agg(F.max_by("label", F.struct("n", "label")).alias("main")))
    apart = labelled.join(most, "g").where("label <> main")
    ways = apart.groupBy("g").agg(F.ceil(F.count("*") / (CELL // 2)).cast("long").alias("ways"))
    apart = materialise(apart.join(ways, "g").withColumn(
        "way", F.pmod(F.xxhash64(F.lit(3), "sid"), F.col("ways"))).select("sid", "g", "way", "blocks"), "apart")
    left = apart.join(sets.select("sid", "shingles"), "sid").select(
        *row, "way", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    right = wide.join(ways, "g").select(
        *row, F.explode(F.sequence(F.lit(0).cast("long"), F.col("ways") - 1)).alias("way"), "block")
    two = left.unionByName(right).groupBy("g", "way", "block").applyInPandas(_links(percent), "a long, b long")
    return one.unionByName(materialise(two, "links"))


def jaccard_classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, int(size // BYTES_PER_RANGE).bit_length())
    with batches_of(docs.sparkSession, TEXTS_PER_BATCH):
        census = materialise(docs.mapInArrow(_census(width, percent, bits), CENSUS), "census")
    classes, sets = _linked_sets(docs, census, width)
    labels = components(_verified(sets, _candidate_groups(sets, percent), percent))
    known = sets.select("sid", *KEY).join(labels.select(F.col("node").alias("sid"), "label"), "sid")
    named = known.join(classes.select(*KEY, "least"), KEY)
    heads = named.groupBy("label").agg(F.min("least").alias("component"))
    linked = named.join(heads, "label").select(*KEY, "component")
    # written, so that the join below deals it out anew and a set with very many copies can be split
    final = materialise(classes.select(*KEY, "least").join(linked, KEY, "left").select(
        *KEY, F.coalesce("component", "least").alias("component")), "components")
    empty = census.where("kind = 0 AND n = 0").select(
        "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    members = census.where("kind = 0 AND n > 0").select("doc_id", *KEY).join(final, KEY).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))
    return empty.unionByName(members)


def one_per_class(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that ``classes`` puts under another document's id.

    A row without an id stays, and so does a row whose id also names a document that stays. Only rows
    that a Bloom filter of the dropped ids lets through shuffle.
    """
    gone = materialise(
        classes.where("doc_id IS NOT NULL").groupBy("doc_id")
        .agg(F.min(F.col("doc_id") != F.col("component_id")).alias("gone")).where("gone")
        .select(F.col("doc_id").alias("id")), "gone")
    return _without(docs, gone, id_col)


def _without(docs: DataFrame, gone: DataFrame, key_col: str) -> DataFrame:
    """``docs`` without the rows whose key is an ``id`` of ``gone``."""
    test, cells = bitmaps.filter_of(gone, "id", gone.count(), "gone-filter")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col(key_col).cast("long").alias("key"))
    tested = bitmaps.with_test(packed, F.col("key"), test, cells, "maybe")
    sure = tested.where("NOT maybe OR key IS NULL").select("row")
    left = tested.where("maybe AND key IS NOT NULL").join(gone, F.col("key") == F.col("id"), "left_anti").select("row")
    return sure.unionByName(left).select("row.*")


def one_row_per_class(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row of each class, that of the smallest id (null last), all columns as they were.

    The rows are stored with a key of their own, which the join takes for their id; so rows without an
    id, or with the id of others, are members of classes like all others. A text without words stays.
    """
    row_key = ROW_KEY
    while row_key.lower() in [c.lower() for c in docs.columns]:
        row_key += "_"
    keyed = materialise(docs.withColumn(row_key, F.monotonically_increasing_id()), "keyed")
    classes = materialise(
        jaccard_classes(keyed, width, percent, row_key, text_col).where("n_shingles > 0")
        .select(F.col("doc_id").alias("key"), F.col("component_id").alias("class")), "classes")
    shared = materialise(classes.groupBy("class").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "shared")
    places = keyed.select(F.col(row_key).alias("key"), F.struct(
        F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(row_key).alias("key")).alias("place"))
    members = materialise(classes.hint("merge").join(shared, "class").hint("merge").join(places, "key"), "members")
    firsts = materialise(members.groupBy("class").agg(F.min("place").alias("first")), "firsts")
    gone = materialise(members.hint("merge").join(firsts, "class").where("place <> first")
                       .select(F.col("key").alias("id")), "gone")
    return _without(keyed, gone, row_key).drop(row_key)
