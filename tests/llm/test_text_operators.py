"""Dedup, join and string operators against their plain versions."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import edited, frame, prose
from pyspark.sql import functions as F

import corpus_pipeline
from quillrun.llm import jaccard_join, suffix_dedup, words
from quillrun.llm.components import components
from quillrun.llm.exact_dedup import exact_dedup, exact_groups
from quillrun.llm.jaccard_join import jaccard_classes, one_per_class
from quillrun.llm.line_dedup import dedup_lines
from quillrun.llm.suffix_dedup import remove_repeats

EMPTY = []


def test_exact_groups(spark, texts, docs):
    wanted = brute.exact_groups(list(enumerate(texts)))
    found = exact_groups(docs).collect()
    assert len(found) == len(texts)
    for r in found:
        keep, size, digest = wanted[r.id]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (keep, size, keep == r.id, digest)


def test_exact_groups_of_repeated_rows_and_null_ids(spark):
    rows = [(None, "a b"), (5, "ab"), (5, "ab"), (3, "a  b"), (None, None), (9, ""), (None, "z"), (None, "z")]
    found = exact_groups(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    by_text = {}
    for r in found:
        by_text.setdefault(r.text_sha256, []).append(r)
    for group in by_text.values():
        assert {r.group_size for r in group} == {len(group)}
        assert sum(r.kept for r in group) == 1
    assert sorted(len(g) for g in by_text.values()) == [2, 2, 4]
    assert {r.keep_id for r in found if r.id == 5} == {3}      # the longest original text stays


def test_exact_dedup_keeps_whole_rows(spark, texts, docs):
    kept = exact_dedup(docs)
    assert kept.columns == docs.columns
    wanted = brute.exact_groups(list(enumerate(texts)))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in wanted if wanted[i][0] == i)


def test_jaccard_classes(spark, texts, docs):
    sizes, classes = brute.jaccard_classes(texts)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(docs).collect()}
    assert found == {i: (sizes[i], classes[i]) for i in range(len(texts))}
    left = one_per_class(docs, jaccard_classes(docs))
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [i for i in range(len(texts)) if classes[i] == i]


def test_jaccard_of_a_group_larger_than_a_cell(spark, monkeypatch):
    """Blocks, the class most sets are in, and sets apart from it give what one cell gives."""
    base = prose(9, 120)
    rows = [edited(base, s, 1 + s % 9) for s in range(90)] + [prose(s, 50) for s in range(50, 60)]
    _, classes = brute.jaccard_classes(rows)
    monkeypatch.setattr(jaccard_join, "CELL", 16)
    found = {r.doc_id: r.component_id for r in jaccard_classes(frame(spark, list(enumerate(rows)))).collect()}
    assert [found[i] for i in range(len(rows))] == classes


def test_jaccard_with_null_and_repeated_ids(spark):
    base = prose(3, 60)
    rows = [(None, base), (None, base), (8, edited(base, 1, 1)), (8, "else"), (8, "else"), (None, None), (2, "")]
    found = sorted(jaccard_classes(frame(spark, rows)).collect(), key=str)
    assert len(found) == len(rows)
    assert sum(r.component_id == 8 for r in found) == 5
    assert [r for r in found if r.doc_id == 2][0].component_id == 2
    kept = one_per_class(frame(spark, rows), jaccard_classes(frame(spark, rows)))
    assert kept.where("doc_id = 8").count() == 3


def test_the_pipeline_keeps_one_row_of_each_class(spark, sf_dir):
    base = prose(3, 60)
    rows = [(None, base), (None, edited(base, 2, 1)), (8, edited(base, 1, 1)), (8, edited(base, 3, 1)), (8, "else"),
            (8, "else"), (None, "other"), (None, "other"), (None, None), (2, ""), (2, "")]
    df = frame(spark, rows)
    kept = corpus_pipeline.near_copies(spark, df, sf_dir)
    assert kept.columns == df.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert [x for x in found if x[1] and len(x[1]) > 9] in ([(8, rows[2][1])], [(8, rows[3][1])])
    assert [x for x in found if not x[1] or len(x[1]) < 9] == [(2, ""), (2, ""), (8, "else"), (None, "other"), (None, None)]


def test_cell_links_agree_with_pairs():
    pick = random.Random(4)
    base = list(range(200))
    sets = []
    for _ in range(120):
        own = set(pick.sample(base, pick.choice([40, 120, 150])))
        sets.append(np.array(sorted(own), dtype=np.int64))
    links = jaccard_join.cell_links(np.arange(120), np.zeros(120, np.int64), sets, 60)
    union, wanted = brute.Union(range(120)), brute.Union(range(120))
    for a, b in links:
        union.join(a, b)
    for i in range(120):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 60 * (len(sets[i]) + len(sets[j]) - both):
                wanted.join(i, j)
    assert [union.find(i) for i in range(120)] == [wanted.find(i) for i in range(120)]


def test_components(spark):
    pick = random.Random(1)
    edges = [(pick.randrange(200), pick.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(40)]
    union = brute.Union({x for e in edges for x in e})
    for a, b in edges:
        union.join(a, b)
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(union.find(x) == label for x, label in found.items())
    assert set(found) == {x for a, b in edges if a != b for x in (a, b)}


def test_shingles_follow_the_definition(texts):
    data, offsets = words.text_bytes(pa.array(texts))
    for text, found in zip(texts, words.shingle_sets(data, offsets, 5)):
        assert len(found) == len(brute.shingles(text))


def test_repeated_strings(spark, texts):
    rows = texts + [texts[0], "y" + texts[0]] + [prose(6, 20_000)[5000:7000]]
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in
             remove_repeats(frame(spark, list(enumerate(rows)))).collect()}
    wanted = brute.removed(rows)
    assert {i: w[:3] for i, w in enumerate(wanted)} == found
    assert sum(w[2] for w in wanted) > 20


def test_repeated_strings_digest_and_the_window_path(spark, texts, monkeypatch):
    wanted = [w[3] for w in brute.removed(texts)]
    digest = F.sha2("kept", 256).alias("d")
    monkeypatch.setattr(suffix_dedup, "HOT", 2)
    found = {r.doc_id: r.d for r in remove_repeats(frame(spark, list(enumerate(texts)))).select("doc_id", digest).collect()}
    assert [found[i] for i in range(len(texts))] == wanted


def test_anchors_of_stretches_cover_each_window_once(monkeypatch):
    text = prose(11, 2500)
    monkeypatch.setattr(suffix_dedup, "BYTES_AT_ONCE", 3000)
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([text])], names=["d1", "d2", "text"])
    rows = [r for b in suffix_dedup._anchor_rows([batch]) for r in b.to_pylist()]
    starts = sorted(s for r in rows for s in range(r["s0"], r["s1"] + 1))
    assert starts == list(range(len(text.encode()) - 399))
    assert all(r["s0"] <= r["at"] <= r["s0"] + 200 and r["at"] >= r["s1"] for r in rows)


def test_repeated_lines(spark, texts):
    many = "\n".join(prose(s, 4) for s in range(30))
    rows = texts + [many, "top\n" + many, many.replace("\n", "\nx\n", 3), "a\na\na\na\na", "b\na\na\na", "a\na"]
    found = {r.id: r for r in dedup_lines(frame(spark, list(enumerate(rows)))).collect()}
    assert len(found) == len(rows)
    for i, kept in enumerate(brute.kept_lines(list(enumerate(rows)))):
        assert found[i].text == "\n".join(kept)
        assert found[i].n_lines - found[i].n_removed == len(kept)


@pytest.mark.parametrize("need, words", [(3, 50), (1, 0), (5, 12)])
def test_repeated_runs_of_any_length(spark, need, words):
    pick = random.Random(need)
    lines = [prose(s, 1 + s % 7) for s in range(6)] + ["", prose(7, 49), prose(8, 50)]
    two = f"{prose(20, 90)}\n{prose(21, 90)}"
    rows = [two, two, prose(8, 50), f"{prose(9, 20)}\n{prose(10, 29)}", f"{prose(9, 20)}\n{prose(10, 29)}\nx"]
    rows += ["\n".join(pick.choice(lines) for _ in range(pick.randrange(1, 14))) for _ in range(40)]
    keyed = list(enumerate(rows))
    found = {r.id: r for r in dedup_lines(frame(spark, keyed), need, words).collect()}
    for i, kept in enumerate(brute.kept_lines(keyed, need, words)):
        assert found[i].text == "\n".join(kept) and found[i].n_removed == len(rows[i].split("\n")) - len(kept)


def test_copies_of_two_long_lines_lose_the_later_one(spark):
    two = f"{prose(20, 90)}\n{prose(21, 90)}"
    found = {r.id: r for r in dedup_lines(frame(spark, [(2, two), (1, two), (3, "x\n" + prose(20, 90))])).collect()}
    assert (found[1].text, found[2].text, found[3].text) == (two, "", "x")
    assert found[2].n_runs == found[3].n_runs == 1


def test_lines_of_rows_that_repeat_an_id(spark):
    rows = [(None, "a\nb\nc")] * 3 + [(4, "a\nb\nc\nd")]
    found = dedup_lines(frame(spark, rows)).collect()
    assert sorted((r.id is None, r.text) for r in found) == [(False, "a\nb\nc\nd")] + [(True, "")] * 3


@pytest.mark.parametrize("run", [exact_groups, exact_dedup, jaccard_classes, dedup_lines, remove_repeats])
def test_empty_tables(spark, run):
    assert run(frame(spark, EMPTY)).count() == 0
    assert run(frame(spark, [(1, None)])).count() == 1
