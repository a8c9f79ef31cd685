"""Every registered query of the folder, and the pipeline stage by stage."""

import re

import brute
import oracle
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from quillrun.llm.catalogue import QUERIES, SQL
from quillrun.session import materialise

WITHOUT_SQL = {"op2_cost_balanced_packing", "op3_pivot_top_k", "op4_jaccard_classes", "op6_nb_svm_quality",
               "op8_repeated_strings", "op10_hilbert_shards", "op12_token_files"} - {"op3_pivot_top_k"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    result = entry_module.queries()[name](spark, sf_dir)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in SQL:
        assert oracle.compare(result, oracle.connect(sf_dir), SQL[name]) == []
    else:
        assert result.count() >= spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_what_has_no_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) <= set(entry_module.queries()) and "pipeline" in entry_module.queries()


def test_joins_agree_with_plain_versions(spark, sf_dir, documents):
    rows = sorted((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
    texts = [t for _, t in rows]
    sizes, classes = brute.jaccard_classes(texts)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op4_jaccard_classes"](spark, sf_dir).collect()}
    assert found == {d: (sizes[i], rows[classes[i]][0]) for i, (d, _) in enumerate(rows)}
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
             for r in QUERIES["op8_repeated_strings"](spark, sf_dir).collect()}
    assert found == {d: w for (d, _), w in zip(rows, brute.removed(texts))}


def test_pipeline_stages(spark, sf_dir, documents):
    docs, before = documents, {r.doc_id: r.text for r in documents.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "test-stage")
        assert docs.columns == documents.columns
        after = {r.doc_id: r.text for r in docs.collect()}
        assert after.items() <= before.items() and after
        rows = sorted(before.items())
        if name == "exact dedup":
            wanted = brute.exact_groups(rows)
            assert set(after) == {i for i in wanted if wanted[i][0] == i}
        if name == "n-gram Jaccard join":
            _, classes = brute.jaccard_classes([t for _, t in rows])
            assert set(after) == {rows[i][0] for i in range(len(rows)) if classes[i] == i}
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {p.doc_id for p in pieces} == set(before)
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((p.doc_id, p.start, p.length, p.ids_crc32) for p in whole) == sorted(
        (p.doc_id, p.start, p.length, p.ids_crc32) for p in pieces)
