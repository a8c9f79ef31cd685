import time
import threading
import pathlib
import itertools
import random
import json

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from quillrun.functions import requests as rq
from quillrun.operators import batching, filling, ids, joining, pieces, positions, reports, search, similarity
from quillrun.operators import structured, tables
from quillrun.operators.results import job_progress, parse_files, parse_lines, status_table
from quillrun.plans import answers as an
from quillrun.session import materialise
from quillrun.sources import jsonl, runs


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# --- tables ------------------------------------------------------------------------------------

def test_scan_checks(spark):
    rows = frame(spark, [(1, "a")], "id int, t string")
    assert tables.scan_text(rows, "t", "id").columns == ["id", "t"]
    with pytest.raises(ValueError, match="no column missing"):
        tables.scan_text(rows, "missing", "id")
    with pytest.raises(ValueError, match="is empty"):
        tables.scan_text(rows.where("false"), "t", "id", require_rows=True)


def test_from_vectors(spark):
    got = tables.from_vectors(spark, ["x", "y"], [1, 2]).collect()
    assert [tuple(r) for r in got] == [(1, "x"), (2, "y")]
    assert tables.from_vectors(spark, ["x"], ["a"]).schema["id"].dataType.simpleString() == "string"
    with pytest.raises(ValueError, match="do not go with"):
        tables.from_vectors(spark, ["x"], [1, 2])


def test_invalid_policies(spark):
    rows = frame(spark, [(1, "a"), (2, ""), (3, None)], "id int, t string")
    assert tables.apply_invalid_policy(rows, "t", "drop").count() == 1
    assert tables.apply_invalid_policy(rows, "t", "error_row").count() == 3
    with pytest.raises(Exception, match="non-empty string"):
        tables.apply_invalid_policy(rows, "t", "fail").collect()
    with pytest.raises(Exception, match="row 2"):
        tables.apply_invalid_policy(rows.where("id < 3"), "t", "fail", "id").collect()
    with pytest.raises(ValueError):
        tables.apply_invalid_policy(rows, "t", "other")


def test_column_order(spark):
    rows = spark.range(1).select("id", F.lit(1).alias("V1"), F.lit(False).alias("error"),
                                 F.lit("").alias("error_msg"), F.lit("t").alias("text"))
    assert tables.order_columns(rows, ["text"]).columns == ["text", "error", "error_msg", "id", "V1"]
    assert tables.order_columns(rows, relocate=1).columns[:2] == ["error", "error_msg"]
    assert tables.embedding_columns(rows).columns == ["V1"]


def test_slice_and_sample(spark):
    rows = spark.range(5000).select("id", (-F.col("id")).alias("k"))
    got = sorted(r["id"] for r in tables.slice_rows(rows, "k", 3, 6).collect())
    assert got == [4994, 4995, 4996, 4997]
    first = {r["id"] for r in tables.sample_rows(rows, "id", 300, seed=1).collect()}
    again = {r["id"] for r in tables.sample_rows(rows.repartition(3), "id", 300, seed=1).collect()}
    other = {r["id"] for r in tables.sample_rows(rows, "id", 300, seed=2).collect()}
    assert len(first) == 300 and first == again and first != other
    assert tables.sample_rows(rows, "id", 9000).count() == 5000


def test_parameter_grid(spark):
    grid = tables.parameter_grid(spark, a=[1, 2], b=["x", "y", "z"])
    assert sorted(tuple(r) for r in grid.collect()) == [
        (a, b) for a in (1, 2) for b in ("x", "y", "z")]


# --- positions and batches ---------------------------------------------------------------------

@pytest.mark.parametrize("order, rows_per_bucket", [
    (["id"], 50), (["id"], 7), (["g", "id"], 40), (["s", "id"], 11), (["maybe", "id"], 60)])
def test_positions_equal_a_global_window(spark, order, rows_per_bucket):
    rows = spark.range(4000).select(
        F.col("id"), (F.col("id") * 7919 % 13).alias("g"),
        F.concat(F.lit('"é'), (F.col("id") * 31 % 97).cast("string")).alias("s"),
        F.when(F.col("id") % 3 != 0, F.col("id") % 5).alias("maybe"), (F.col("id") % 9).alias("w")
    ).repartition(5)
    everything = Window.orderBy(*order)
    expected = rows.select(
        "id", F.row_number().over(everything).alias("p"), F.coalesce(F.sum("w").over(
            everything.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"))
    got = positions.with_position(rows, order, running={"before": F.col("w")},
                                  highest={"top": F.col("w")}, rows_per_bucket=rows_per_bucket)
    assert got.join(expected, "id").where(
        "position = p and before = b and top = 8").count() == 4000


def test_position_plan_has_no_global_sort(spark, documents):
    placed = positions.with_position(documents.select("doc_id", "text"), "doc_id", rows_per_bucket=20)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    body, starts = plan.split("BroadcastExchange")[0], plan.split("BroadcastExchange")[1]
    assert "SinglePartition" not in body and "shufflepartitionidpassthrough" in body
    assert "text" not in starts.split("ReadSchema")[1]  # sizes are counted from the key alone


def test_chunk_sizes(spark):
    rows = spark.range(10)
    sizes = {r["chunk"]: r["count"] for r in
             batching.with_chunk(rows, 3, "id").groupBy("chunk").count().collect()}
    assert sizes == {1: 3, 2: 3, 3: 3, 4: 1}
    assert batching.with_chunk(rows, 10, "id").select("chunk").distinct().count() == 1
    assert batching.with_chunk(rows.where("false"), 10, "id").count() == 0
    for bad in (0, -1, 1.5, True):
        with pytest.raises(ValueError):
            batching.with_chunk(rows, bad, "id")


def test_row_cap(spark):
    rows = spark.range(25)
    assert batching.with_row_batches(rows, "id", 10).groupBy("batch").count().count() == 3
    with pytest.raises(ValueError, match="at most 10"):
        batching.with_row_batches(rows, "id", 10, on_excess="fail")


def greedy(sizes, max_bytes, max_rows=None):
    """Batch of each row, filled one after the other."""
    batch, used, n, out = 0, max_bytes, 0, []
    for size in sizes:
        if used + size > max_bytes or n == max_rows:
            batch, used, n = batch + 1, 0, 0
        used, n = used + size, n + 1
        out.append(batch)
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 60), min_size=1, max_size=60), st.integers(62, 200),
       st.integers(1, 12))
def test_batches_keep_both_caps(spark, sizes, max_bytes, max_rows):
    rows = frame(spark, [(i, "é" * (n // 2) + "x" * (n % 2)) for i, n in enumerate(sizes)],
                 "id int, line string")
    got = batching.with_batches(rows, "line", "id", max_rows, max_bytes, rows_per_bucket=9)
    per_batch = got.groupBy("batch").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("line") + 1).alias("b")).collect()
    assert sum(r["n"] for r in per_batch) == len(sizes)
    assert all(r["n"] <= max_rows and r["b"] <= max_bytes for r in per_batch)
    in_order = [r["batch"] for r in got.orderBy("id").collect()]
    assert in_order == greedy([2 * (n // 2) + n % 2 + 1 for n in sizes], max_bytes, max_rows)


def test_a_line_over_the_cap_is_refused(spark):
    rows = frame(spark, [(1, "x" * 50)], "id int, line string")
    with pytest.raises(Exception, match="does not fit"):
        batching.with_batches(rows, "line", "id", max_bytes=40).collect()


def test_multi_text_requests_keep_order(spark):
    rows = frame(spark, [(i, f"text{i}") for i in range(7)], "id int, text string").repartition(4)
    placed = batching.with_chunk(rows, 3, "id", chunk="batch", index="index")
    got = batching.multi_text_requests(placed, "text", rq.inference_request_multi, carry=["id"])
    found = {r["batch"]: r for r in got.collect()}
    assert json.loads(found[2]["request"])["inputs"] == ["text3", "text4", "text5"]
    assert [tuple(x) for x in found[3]["items"]] == [(7, 6)]
    assert found[1]["n_texts"] == 3 and found[1]["total_chars"] == 15


# --- ids ---------------------------------------------------------------------------------------

def test_id_rules(spark):
    rows = frame(spark, [("a",), ("a",), ("b",), ("ok_-9",), ("bad id",), ("x" * 65,), ("line\n",),
                         ("",)], "id string")
    found = {(r["rule"], r["custom_id"]) for r in ids.id_violations(rows, "id", True).collect()}
    assert found == {("duplicate", "a"), ("format", "bad id"), ("format", "x" * 65),
                     ("format", "line\n"), ("format", "")}
    with pytest.raises(ValueError, match="1 ids are used by more than one request, for example a"):
        ids.enforce_ids(rows, "id")
    with pytest.raises(ValueError, match="do not match"):
        ids.enforce_ids(rows.where("id <> 'a'"), "id", messages_rules=True)
    good = rows.where("id in ('b', 'ok_-9')")
    assert ids.enforce_ids(good, "id", messages_rules=True) is good


def test_duplicate_report_counts_all_and_shows_three(spark):
    rows = spark.range(20).select((F.col("id") % 5).alias("id"))
    got = ids.duplicate_report(rows, "id").collect()
    assert [tuple(r) for r in got] == [(0, 4, 5), (1, 4, 5), (2, 4, 5)]


# --- files -------------------------------------------------------------------------------------

def test_split_lines(spark):
    rows = frame(spark, [(1, "a\n\nb\n"), (2, ""), (3, "\n"), (4, None)], "id int, body string")
    got = jsonl.split_lines(rows, "body", ["id"]).collect()
    assert [tuple(r) for r in got] == [(1, 1, "a"), (1, 2, "b")]


def test_line_numbers_across_splits(spark, folder):
    lines = [f"line {i}" + ("" if i % 3 else "\n") for i in range(1, 3001)]
    frame(spark, [("\n".join(lines),)], "value string").coalesce(1).write.text(folder)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        read = jsonl.read_lines(spark, folder)
        assert read.select("split").distinct().count() > 5
        got = jsonl.line_numbers(read, F.col("line").endswith("7"))
        rows = got.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 300 and all(r["line"] == f"line {r['line_no']}" for r in rows)


def test_write_batches(spark, folder):
    rows = spark.range(100).select("id", (F.col("id") % 3).alias("batch"),
                                   F.concat(F.lit("l"), "id").alias("line"))
    jsonl.write_batches(rows, "line", f"{folder}/one", order_by="id")
    numbered = jsonl.line_numbers(jsonl.read_lines(spark, f"{folder}/one"))
    assert numbered.select("file").distinct().count() == 3
    assert numbered.where("line = 'l4'").first()["line_no"] == 2
    jsonl.write_batches(rows, "line", f"{folder}/many", single_file=False)
    assert spark.read.text(f"{folder}/many").count() == 100


def test_chunk_files_and_run_log(spark, folder):
    results = batching.with_chunk(spark.range(10), 4, "id")
    runs.write_chunks(results, f"{folder}/results")
    assert runs.read_chunks(spark, f"{folder}/results").where("chunk = 3").count() == 2
    runs.write_chunks(batching.with_chunk(spark.range(90), 4, "id"), f"{folder}/ranged", chunks_per_folder=5)
    some = runs.read_chunks(spark, f"{folder}/ranged", 5, 11, chunks_per_folder=5)
    assert some.columns == ["id", "chunk"] and len(some.inputFiles()) > 0
    assert sorted(r["id"] for r in some.collect()) == list(range(16, 44))
    assert "chunk_folder#" in some._jdf.queryExecution().executedPlan().toString()
    runs.write_metadata(spark, folder, {"model": "m", "chunk_size": 4, "schema": {"a": 1}})
    row = runs.run_log(spark, folder).first()
    assert (row["model"], row["chunk_size"], row["schema"]) == ("m", 4, '{"a": 1}')
    assert row["output_dir"] == folder and row["max_retries"] is None


def test_a_chunk_is_there_before_the_others_are_done(spark, folder, tmp_path):
    go = tmp_path / "go"

    @F.pandas_udf("long")
    def held_up(ids):
        while not go.exists() and (ids == 35).any():
            time.sleep(0.05)
        return ids

    rows = batching.with_chunk(spark.range(40), 10, "id", index="at")
    rows = materialise(rows, "rows").withColumn("id", held_up("id"))
    writing = threading.Thread(target=runs.write_chunks, args=(rows.withColumn("chunk", F.col("chunk")), folder))
    count = runs.by_chunk  # the slow rows are dealt out before they are made
    runs.by_chunk = lambda df, n: materialise(batching.with_chunk(spark.range(40), 10, "id"), "r").withColumn(
        runs.FOLDER, F.lit(0)).repartitionById(4, F.col("chunk") - 1).withColumn("id", held_up("id"))
    try:
        writing.start()
        seen, until = set(), time.time() + 60
        while len(seen) < 3 and time.time() < until:
            time.sleep(0.2)
            seen = {f.name for f in pathlib.Path(folder.removeprefix("file:")).glob("chunk_folder=0/part-*.parquet")}
        assert len(seen) == 3 and writing.is_alive()
    finally:
        go.write_text("")
        writing.join(60)
        runs.by_chunk = count
    assert sorted(r.id for r in runs.read_chunks(spark, folder).collect()) == list(range(40))


def test_output_paths(spark):
    import datetime

    now = datetime.datetime(2025, 3, 4, 5, 6, 7)
    assert runs.output_dir(spark, "given") == "given"
    assert runs.output_dir(spark, "auto", "base", now).startswith("base_04032025_050607_")
    assert runs.output_dir(spark) != runs.output_dir(spark)
    assert runs.output_file(spark, "auto", "base", now).endswith(".csv")
    assert runs.output_file(spark, "X.CSV") == "X.CSV"
    with pytest.raises(ValueError, match=".csv"):
        runs.output_file(spark, "x.txt")


# --- results -----------------------------------------------------------------------------------

def lines_of(spark, *lines):
    rows = [(i + 1, x if isinstance(x, str) else json.dumps(x)) for i, x in enumerate(lines)]
    return frame(spark, rows, "line_no int, line string")


def test_embedding_lines(spark):
    got = parse_lines(lines_of(
        spark, {"custom_id": "a", "response": {"body": {"data": [{"embedding": [0.1, 0.2]}]}}},
        {"custom_id": "b", "error": {"message": "Rate limit"}}, {"custom_id": "c", "error": {}},
        {"custom_id": "d", "response": {"body": {}}}, "oops"), "embeddings").collect()
    assert [tuple(r) for r in got] == [
        ("a", [0.1, 0.2], False, None), ("b", None, True, "Rate limit"),
        ("c", None, True, "Unknown error"), ("d", None, True, "No embedding found in response"),
        ("__PARSE_ERROR_LINE_5", None, True, "Failed to parse JSONL line 5")]


def test_completion_lines(spark):
    inner = {"status_code": 400, "body": {"error": {"message": "bad"}}}
    lines = lines_of(
        spark, {"custom_id": "a", "error": None,
                "response": {"body": {"choices": [{"message": {"content": "{\"x\":1}"}}]}}},
        {"custom_id": "b", "response": inner}, {"custom_id": "c", "error": "text"})
    got = parse_lines(lines, "completions", id="my_id")
    assert got.columns == ["my_id", "content", "error", "error_msg"]
    assert [tuple(r) for r in got.collect()] == [
        ("a", '{"x":1}', False, None), ("b", None, False, None), ("c", None, True, "text")]
    strict = parse_lines(lines, "completions", strict=True).collect()
    assert (strict[1]["error"], strict[1]["error_msg"]) == (True, "bad")


def test_message_lines(spark):
    good = {"custom_id": "t1", "result": {"type": "succeeded", "message": {
        "content": [{"type": "text", "text": "Hello"}], "stop_reason": "end_turn",
        "usage": {"input_tokens": 10, "output_tokens": 5}}}}
    bad = {"custom_id": "t2", "result": {"type": "errored", "error": {"message": "Invalid"}}}
    late = {"custom_id": "t3", "result": {"type": "expired"}}
    got = [tuple(r) for r in parse_lines(lines_of(spark, good, bad, late, "{"), "messages").collect()]
    assert got == [("t1", "Hello", False, None, "end_turn", 10, 5),
                   ("t2", None, True, "Invalid", None, None, None),
                   ("t3", None, True, "expired", None, None, None),
                   ("__PARSE_ERROR_LINE_4", None, True, "Failed to parse JSONL line 4", None, None, None)]
    empty = parse_lines(lines_of(spark, "x").where("false"), "messages")
    assert empty.count() == 0 and len(empty.columns) == 7
    with pytest.raises(ValueError):
        parse_lines(lines_of(spark, "x"), "other")


def test_parse_files_numbers_unreadable_lines(spark, folder):
    text = '\n{"custom_id":"a"}\n\nbroken\n{"custom_id":"b"}\nalso broken\n'
    frame(spark, [(text,)], "v string").coalesce(1).write.text(folder)
    got = {r["custom_id"]: r["error"] for r in parse_files(spark, folder, "completions").collect()}
    assert got == {"a": False, "b": False, "__PARSE_ERROR_LINE_2": True, "__PARSE_ERROR_LINE_4": True}


def test_batch_status(spark):
    def status(id, state, done, left):
        return json.dumps({"id": id, "type": "message_batch", "processing_status": state,
                           "request_counts": {"processing": left, "succeeded": done, "errored": 0,
                                              "canceled": 0, "expired": 0}, "results_url": None})

    rows = frame(spark, [("j", status("a", "ended", 2, 0)), ("j", status("b", "in_progress", 1, 1)),
                         ("k", json.dumps({"id": "c", "status": "completed",
                                           "request_counts": {"total": 3, "completed": 3, "failed": 0}}))],
                 "job string, body string")
    got = {r["job"]: r for r in job_progress(status_table(rows, "body", ["job"]), "job").collect()}
    assert (got["j"]["all_ended"], got["j"]["succeeded"], got["j"]["processing"]) == (False, 3, 1)
    assert (got["k"]["all_ended"], got["k"]["succeeded"], got["k"]["batches"]) == (True, 3, 1)


def test_parse_content_keeps_the_raw_text(spark):
    content = [("a", '{"lang":"en","n_chars":3,"grade":2}'), ("b", '{"lang":"xx"}'), ("c", None)]
    got = structured.parse_content(frame(spark, content, "id string, content string"), an.REVIEW)
    rows = {r["id"]: r for r in got.collect()}
    assert rows["a"]["valid"] and rows["a"]["parsed"]["grade"] == 2.0
    assert rows["b"]["valid"] is False and rows["b"]["parsed"] is None
    assert rows["b"]["content"] == '{"lang":"xx"}' and len(rows["b"]["violations"]) == 3
    assert rows["c"]["valid"] is None


# --- joins and reports -------------------------------------------------------------------------

def test_completeness(spark):
    asked = frame(spark, [(1,), (2,), (3,), (4,)], "id int")
    came = frame(spark, [("2",), ("3",), ("3",), ("9",), ("4",)], "custom_id string")
    got = {r["custom_id"]: (r["n_requests"], r["n_results"], r["state"])
           for r in joining.completeness(asked, came, "id").collect()}
    assert got == {"1": (1, 0, "missing"), "3": (1, 2, "repeated"), "9": (0, 1, "unknown")}
    assert tuple(joining.response_counts(asked, came).first()) == (4, 5)


def test_attach_and_bind(spark):
    source = frame(spark, [(1, "x"), (2, "y")], "id int, t string")
    results = frame(spark, [("2", "c")], "custom_id string, content string")
    got = joining.attach_results(source, results, "id")
    assert sorted(map(tuple, got.collect())) == [(1, "x", None), (2, "y", "c")]
    bound = joining.bind_rows(source, spark.range(1).select(F.lit(5).alias("id"), F.lit(1).alias("z")))
    assert bound.columns == ["id", "t", "z"] and bound.count() == 3


def test_splits_are_counted_without_sorting_their_rows(spark, folder, monkeypatch, capsys):
    twice = spark.range(3000).select(F.when(F.col("id") % 5 > 0, F.floor(F.col("id") / 2)).alias("id"), F.col("id").alias("at"))
    twice.repartitionByRange(3, "at").sortWithinPartitions("at").write.parquet(folder)
    stored = spark.read.parquet(folder)

    def shown(df, label, *rest):
        df.explain()
        return materialise(df, label, *rest)

    monkeypatch.setattr(positions, "materialise", shown)
    numbered = positions.with_stored_position(stored)
    told = capsys.readouterr().out
    assert "HashAggregate" in told and "SortAggregate" not in told
    assert numbered.where("position <> at + 1").isEmpty() and numbered.count() == 3000
    totals = positions.stored_totals(stored, F.col("id"))
    capsys.readouterr()
    ids_ = [r["id"] for r in stored.orderBy("at").collect()]
    before = list(itertools.accumulate((i or 0 for i in ids_), initial=0))
    assert {(r["position"], r["before"]) for r in totals.collect()} == set(enumerate(before[:-1], 1))


def test_no_texts_of_results_are_broadcast(spark, documents, capsys):
    results = parse_lines(an.chat_lines(documents, F.col("text")), "completions")
    got = joining.attach_results(documents.select("doc_id", "lang"), results, "doc_id")
    got.explain()
    assert "Broadcast" not in capsys.readouterr().out
    assert got.count() == documents.count()
    some = frame(spark, [(1, "x"), (None, "n"), (1, "y")], "id int, t string")
    twice = frame(spark, [("1", "c"), (None, "d"), ("1", "e")], "custom_id string, content string")
    assert sorted(map(str, joining.attach_results(some, twice, "id").collect())) == [
        "Row(id=1, t='x', content='c')", "Row(id=1, t='x', content='e')", "Row(id=1, t='y', content='c')",
        "Row(id=1, t='y', content='e')", "Row(id=None, t='n', content=None)"]


def test_summary_of_nothing(spark):
    empty = frame(spark, [], "error boolean")
    assert tuple(reports.job_summary(empty).first()) == (0, 0, 0, None, None)


def test_linear_model_recovers_a_plane(spark):
    rows = spark.range(200).select(
        (F.col("id") % 7).alias("batch"), (F.col("id") % 11).alias("conc"),
        (3 + 2 * (F.col("id") % 7) - 5 * (F.col("id") % 11) + F.sin("id") * 1e-3).alias("y"))
    fit = {r["term"]: r for r in reports.linear_model(rows, "y", ["batch", "conc"]).collect()}
    assert fit["(Intercept)"]["estimate"] == pytest.approx(3, abs=1e-3)
    assert fit["batch"]["estimate"] == pytest.approx(2, abs=1e-3)
    assert fit["conc"]["estimate"] == pytest.approx(-5, abs=1e-3)
    assert fit["conc"]["p_value"] < 1e-6 and fit["batch"]["std_error"] < 1e-3


def test_combine_piece_scores(spark):
    rows = frame(spark, [(1, {"a": 0.2, "b": 0.8}), (1, {"a": 0.6}), (1, None)],
                 "id int, scores map<string,double>")
    got = {r["label"]: (r["mean_score"], r["max_score"], r["n_pieces"])
           for r in pieces.combine_scores(rows, "id").collect()}
    assert got["a"] == (pytest.approx(0.4), 0.6, 2) and got["b"] == (0.8, 0.8, 1)


# --- vectors -----------------------------------------------------------------------------------

def vectors(spark, rows):
    return frame(spark, [(i, list(map(float, v))) for i, v in rows], "vec_id long, embedding array<double>")


def brute_first_duplicate(rows, threshold):
    found = {}
    for i, v in rows:
        for j, w in rows:
            length = np.linalg.norm(v) * np.linalg.norm(w)
            if j < i and length and np.dot(v, w) / length >= threshold - 1e-12:
                found[i] = min(j, found.get(i, j))
    return found


@pytest.mark.parametrize("threshold, block_rows, pivots", [
    (0.9, 4096, None), (0.9, 5, 40), (0.99, 1, 16), (0.99, 16, None), (0.5, 16, 64), (1.0, 2, 30)])
def test_near_duplicates_equal_brute_force(spark, threshold, block_rows, pivots):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 6))
    rows = [(int(i), centres[rng.integers(20)] + rng.normal(size=6) * rng.choice([0, 0.05, 0.5]))
            for i in rng.permutation(300)]
    rows += [(1000 + i, np.zeros(6)) for i in range(2)] + [(2000 + i, rows[0][1] * 3) for i in range(3)]
    got = similarity.near_duplicates(vectors(spark, rows), threshold, pivots=pivots, block_rows=block_rows)
    expected = brute_first_duplicate(rows, threshold)
    for i in (1000, 1001):  # a zero vector has no direction, but equals its copy
        expected.pop(i, None)
    found = {r["vec_id"]: r["duplicate_of"] for r in got.collect()}
    assert found.pop(1001, 1000) == 1000
    assert found == expected


def grouped_units(rng, n, groups, size=24):
    centres = rng.normal(size=(groups, size))
    rows = centres[np.arange(n) % groups] + rng.normal(size=(n, size)) * 0.1
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def test_cover_grows_with_the_table_where_vectors_form_groups():
    rng, reach = np.random.default_rng(5), np.sqrt(0.1)
    grown = [len(similarity.cover(grouped_units(rng, min(n, 16_384), n // 40), n, reach, 16_384, 4_096))
             for n in (2_000, 40_000, 10 ** 7)]
    assert grown == sorted(grown) and grown[0] < grown[-1]
    scattered = rng.normal(size=(16_384, 64))
    scattered /= np.linalg.norm(scattered, axis=1, keepdims=True)
    assert len(similarity.cover(scattered, 10 ** 5, reach, 16_384, 4_096)) <= 16


@pytest.mark.parametrize("reach", [0.05, 0.3, 1.0])
def test_no_pair_within_reach_is_in_a_closed_cell(reach):
    rng = np.random.default_rng(9)
    units = grouped_units(rng, 1_500, 60, 6)
    pivots = units[:50]
    near = np.sqrt(similarity._squares(units, pivots))
    home = near.argmin(axis=1)
    radii = np.array([near[home == c, c].max(initial=0) for c in range(50)])
    open_ = similarity._open(units, pivots, radii, reach)[1]
    close = np.sqrt(similarity._squares(units, units)) <= reach
    assert open_[:, home][close].all() and not open_.all()


def test_rows_shuffled_per_vector_stay_few(spark, monkeypatch):
    seen, count = [], similarity._meetings

    def counted(candidates, probes, *rest):
        met = count(candidates, probes, *rest)
        seen.append(met.count() / candidates.count())
        return met

    monkeypatch.setattr(similarity, "_meetings", counted)
    rng = np.random.default_rng(2)
    for n in (1_000, 8_000):
        rows = [(i, v) for i, v in enumerate(grouped_units(rng, n, n // 20))]
        assert similarity.near_duplicates(vectors(spark, rows), 0.95).count() > n / 2
    assert max(seen) < 6  # with 64 pivots, whatever the vectors, it was up to 65


def test_near_duplicates_with_one_huge_group(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("vec_id"),
        F.when(F.col("id") % 3 == 0, F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)))
        .otherwise(F.array(F.rand(1), F.rand(2) - 0.5, F.rand(3) - 0.5)).alias("embedding"))
    got = similarity.near_duplicates(rows, 0.999999, block_rows=64)
    assert got.where("vec_id % 3 = 0 and duplicate_of = 0").count() == 999
    assert got.count() == got.select("vec_id").distinct().count()


def test_search_ties_and_blocks(spark):
    corpus = vectors(spark, [(3, [1, 0]), (1, [2, 0]), (2, [0, 1]), (4, [0, 0]), (5, [-1, 0])])
    queries = frame(spark, [("q", [1.0, 0.0]), ("p", [0.0, 5.0])], "query_id string, embedding array<double>")
    for limit in (10 ** 6, 8):
        got = search.semantic_search(queries, corpus, 3, block_bytes=limit)
        rows = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect())
        assert rows == [("p", 1, 2, 1.0), ("p", 2, 1, 0.0), ("p", 3, 3, 0.0),
                        ("q", 1, 1, 1.0), ("q", 2, 3, 1.0), ("q", 3, 2, 0.0)]
    assert search.semantic_search(queries.where("false"), corpus).count() == 0


def test_clusters_are_nearest_centres(spark, sf_dir):
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    got = similarity.cluster(embeddings, 2).toPandas()
    points = np.stack(got["embedding"]).astype(float)
    centres = np.stack([points[got["cluster"] == c].mean(axis=0) for c in (0, 1)])
    nearest = np.linalg.norm(points[:, None] - centres[None], axis=2).argmin(axis=1)
    assert len(got) == embeddings.count() and (nearest == got["cluster"]).mean() > 0.99


def test_run_difference(spark):
    first, second = vectors(spark, [(1, [1, 2]), (2, [1, 2])]), vectors(spark, [(1, [1, 2.5]), (2, [1])])
    got = {r["vec_id"]: r["max_abs_diff"] for r in joining.run_difference(first, second, "vec_id").collect()}
    assert got == {1: 0.5, 2: None}


def test_prepare_batches(spark):
    from quillrun.operators.prepare import prepare_batches

    rows = frame(spark, [("a", "Hello"), ("b", "World")], "id string, text string")
    got = prepare_batches(rows, "text", "id", "completions").orderBy("id").collect()
    parsed = [json.loads(r["line"]) for r in got]
    assert [p["custom_id"] for p in parsed] == ["a", "b"] and {r["batch"] for r in got} == {1}
    assert parsed[0]["body"]["messages"][0]["content"] == "Hello"
    empty = prepare_batches(rows.where("false"), "text", "id", "embeddings")
    assert empty.columns == ["id", "line", "batch"] and empty.count() == 0
    twice = frame(spark, [("a", "x"), ("a", "y"), ("b", "z")], "id string, text string")
    with pytest.raises(ValueError, match="more than one request"):
        prepare_batches(twice, "text", "id", "embeddings")
    with pytest.raises(ValueError, match="do not match"):
        prepare_batches(frame(spark, [("a b", "x")], "id string, text string"), "text", "id", "messages")
    with pytest.raises(ValueError, match="kind"):
        prepare_batches(rows, "text", "id", "other")


def test_a_hot_key_is_split_and_still_in_order(spark):
    rows = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000).alias("k"))
    got = positions.with_position(rows, "k", rows_per_bucket=100).cache()
    assert got.agg(F.min("position"), F.max("position"), F.count_distinct("position")).first()[:] \
        == (1, 6000, 6000)
    spans = got.groupBy("k").agg(F.min("position").alias("a"), F.max("position").alias("z"),
                                 F.count("*").alias("n")).orderBy("k").collect()
    assert all(r["z"] - r["a"] + 1 == r["n"] for r in spans)
    assert [r["a"] for r in spans] == sorted(r["a"] for r in spans)
    hot = got.where("k = 500").select(F.spark_partition_id().alias("p")).distinct().count()
    assert hot > 1


def test_search_over_many_batches_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    points = np.round(rng.normal(size=(900, 4)), 1)
    corpus = vectors(spark, list(enumerate(points))).repartition(3)
    queries = frame(spark, [(i, list(map(float, rng.normal(size=4)))) for i in range(12)],
                    "query_id int, embedding array<double>")
    before = search.SCORES_AT_ONCE
    search.SCORES_AT_ONCE = 120
    try:
        got = search.semantic_search(queries, corpus, 7).collect()
    finally:
        search.SCORES_AT_ONCE = before
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    for query in queries.collect():
        q = np.array(query["embedding"])
        scores = np.round(unit @ (q / np.linalg.norm(q)), 9)
        expected = sorted(range(900), key=lambda i: (-scores[i], i))[:7]
        mine = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == query["query_id"])
        assert [i for _, i in mine] == expected


# --- stored order ------------------------------------------------------------------------------

@pytest.fixture()
def stored(spark, folder):
    """3,000 rows in 6 files whose names are in order."""
    rows = spark.range(3000).withColumn("text", F.repeat(F.lit("x"), (F.col("id") % 40).cast("int")))
    rows.repartitionByRange(6, "id").sortWithinPartitions("id").write.parquet(folder)
    return spark.read.parquet(folder)


def test_stored_positions(spark, stored):
    got = batching.with_chunk(stored, 7, index="at")
    assert got.where("at <> id + 1 OR chunk <> id div 7 + 1").count() == 0
    some = batching.with_chunk(stored.where("id % 3 = 1"), 10, index="at")
    assert some.where("at <> id div 3 + 1").count() == 0
    moved = batching.with_chunk(stored.repartition(5), 10, index="at", fallback="id")
    assert moved.where("at <> id + 1").count() == 0
    with pytest.raises(ValueError, match="no stored order"):
        batching.with_chunk(spark.range(3), 10)


@pytest.mark.parametrize("max_rows", [None, 11])
def test_stored_and_keyed_batches_are_the_same(stored, max_rows):
    lines = stored.withColumn("text", F.when(F.col("id") == 700, F.repeat(F.lit("y"), 990)).otherwise(F.col("text")))
    ours = batching.with_batches(lines, "text", None, max_rows, 1000)
    keyed = batching.with_batches(lines, "text", "id", max_rows, 1000, rows_per_bucket=100)
    assert ours.select("id", "batch").exceptAll(keyed.select("id", "batch")).count() == 0
    rows = ours.orderBy("id").collect()
    assert [r.batch for r in rows] == greedy([len(r.text) + 1 for r in rows], 1000, max_rows)


@pytest.mark.parametrize("width", [1, 3, 16])
@pytest.mark.parametrize("max_rows", [None, 40])
def test_batches_are_filled_over_many_chunks(spark, monkeypatch, width, max_rows):
    monkeypatch.setattr(filling, "CHUNK_BATCHES", width)
    monkeypatch.setattr(filling, "BLOCK_ROWS", 700)
    pick = random.Random(width)
    sizes = [pick.choice([1, 2, 30, 500, 501, 999, 1000]) if pick.random() < .2 else pick.randrange(1, 40)
             for _ in range(6000)]
    before = [0, *itertools.accumulate(sizes)]
    rows = spark.createDataFrame([(i + 1, n, before[i]) for i, n in enumerate(sizes)],
                                 "position long, size long, before long").repartition(5)
    got = filling.with_batch(rows, "position", filling.filled(rows, 1000, max_rows), "batch")
    assert [r.batch for r in got.orderBy("position").collect()] == greedy(sizes, 1000, max_rows)


@pytest.mark.parametrize("files", [1, 8, 300])
@pytest.mark.parametrize("limit", [positions.MAX_SPLITS, 4])
def test_numbers_do_not_depend_on_files_or_the_limit(spark, folder, monkeypatch, files, limit):
    monkeypatch.setattr(positions, "MAX_SPLITS", limit)
    rows = spark.range(3000).withColumn("k", F.hash("id"))
    rows.repartitionByRange(files, "id").sortWithinPartitions("id").write.parquet(folder)
    table = spark.read.parquet(folder)
    stored = batching.with_chunk(table, 7, index="at")
    assert stored.where("at <> id + 1 OR chunk <> id div 7 + 1").count() == 0
    ranked = {r.id: n + 1 for n, r in enumerate(sorted(rows.collect(), key=lambda r: (-r.k, r.id)))}
    by_k = table.orderBy(F.desc("k"), "id")  # a sorted table keeps its order, whatever the files
    for got in (batching.with_chunk(by_k, 7, index="at"),
                batching.with_chunk(by_k.where("id >= 0").select("id"), 7, index="at", fallback="id")):
        assert {r.id: r.at for r in got.collect()} == ranked
    lines = batching.with_batches(table.withColumn("text", F.repeat(F.lit("x"), F.col("id").cast("int") % 40)), "text",
                                  None, 90, 1000)
    rows = lines.orderBy("id").collect()
    assert [r.batch for r in rows] == greedy([len(r.text) + 1 for r in rows], 1000, 90)


def test_rows_in_no_order_are_refused_or_go_by_the_fallback(spark, stored):
    for moved in (stored.repartition(3), stored.distinct(), stored.join(stored.select("id"), "id"),
                  stored.sortWithinPartitions("text"), stored.orderBy("text").limit(9).distinct()):
        with pytest.raises(ValueError, match="no stored order"):
            batching.with_chunk(moved, 10)
    joined = batching.with_chunk(stored.join(stored.select("id"), "id"), 10, index="at", fallback="id")
    assert joined.where("at <> id + 1").count() == 0


def test_equal_rows_are_spread(spark):
    rows = spark.range(40_000).select(F.lit("same").alias("k"))
    got = positions.with_position(rows, "k", rows_per_bucket=2_000)
    per_task = got.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) >= 8 and max(r["count"] for r in per_task) < 10_000
    assert got.agg(F.count_distinct("position"), F.max("position")).first()[:] == (40_000, 40_000)


def test_a_slice_reads_only_the_buckets_it_reaches(spark, folder):
    spark.range(60_000).write.parquet(folder)
    placed = positions.with_position(spark.read.parquet(folder), "id", rows_per_bucket=1_000, between=(501, 1500))
    assert placed.count() < 6_000
    assert placed.where("position BETWEEN 501 AND 1500").count() == 1_000


# --- odd input ---------------------------------------------------------------------------------

def test_search_refuses_odd_vectors_or_leaves_them_out(spark):
    corpus = frame(spark, [(1, [1.0, 0.0]), (2, [float("nan"), 1.0]), (3, [1.0]), (4, None), (5, [0.9, 0.1]),
                           (6, [None, 1.0])], "vec_id long, embedding array<double>")
    queries = frame(spark, [(9, [1.0, 0.0])], "query_id long, embedding array<double>")
    with pytest.raises(Exception, match="vector of 2|vector of 3|vector of 6"):
        search.semantic_search(queries, corpus, 5).collect()
    got = search.semantic_search(queries, corpus, 5, on_odd="leave_out").collect()
    assert [(r["rank"], r["vec_id"]) for r in got] == [(1, 1), (2, 5)]
    odd = {r["vec_id"]: r["reason"] for r in search.odd_vectors(corpus, 2).collect()}
    assert odd == {2: "not finite", 3: "size 1", 4: "missing", 6: "not finite"}
    with pytest.raises(ValueError, match="query"):
        search.semantic_search(queries.union(queries.select(F.lit(8), F.array(F.lit(1.0)))), corpus)


def test_repeated_query_ids_fill_no_block(spark):
    corpus = vectors(spark, [(i, [float(i + 1), 1.0]) for i in range(30)])
    queries = frame(spark, [(1, [1.0, float(i)]) for i in range(64)], "query_id long, embedding array<double>")
    got = search.semantic_search(queries, corpus, 2, block_bytes=800)
    assert got.count() == 128


def test_clusters_keep_rows_without_a_vector(spark):
    rows = frame(spark, [(i, [float(i % 2), 1.0]) for i in range(20)] + [(90, None), (91, [1.0]), (92, [float("nan"), 0.0])],
                 "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["cluster"] for r in similarity.cluster(rows, 2).collect()}
    assert len(got) == 23 and {got[i] for i in (90, 91, 92)} == {None} and None not in {got[i] for i in range(20)}
    nothing = similarity.cluster(rows.where("vec_id = 90"), 2).collect()
    assert [r["cluster"] for r in nothing] == [None]


def test_duplicates_skip_unusable_vectors_and_keep_lengths_apart(spark):
    rows = frame(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [float("nan"), 1.0])],
                 "vec_id long, embedding array<double>")
    assert [tuple(r) for r in similarity.near_duplicates(rows, 0.99).collect()] == [(2, 1)]
    mixed = rows.unionByName(frame(spark, [(5, [1.0, 0.0, 0.0]), (6, [0.999, 0.001, 0.0]), (7, [0.999, 0.001]),
                                           (8, [0.0]), (9, [2.0])], "vec_id long, embedding array<double>"))
    found = sorted(map(tuple, similarity.near_duplicates(mixed, 0.99).collect()))
    assert found == [(2, 1), (6, 5), (7, 1)]


def test_results_with_the_sources_column_names(spark):
    source = frame(spark, [(1, "s", "t")], "id int, content string, error string")
    results = frame(spark, [("1", "r", False), ("1", "q", True)], "custom_id string, content string, error boolean")
    got = joining.attach_results(source, results, "id")
    assert got.columns == ["id", "content", "error", "content_result", "error_result"]
    assert sorted(r["content_result"] for r in got.collect()) == ["q", "r"]
    with pytest.raises(ValueError, match="another suffix"):
        joining.attach_results(source.withColumn("content_result", F.lit(1)), results, "id")


def test_a_missing_id_breaks_both_rules(spark):
    rows = frame(spark, [(None,), (None,), ("ok",)], "id string")
    for messages in (False, True):
        found = ids.id_violations(rows, "id", messages).collect()
        assert [(r["rule"], r["n"]) for r in found] == [("missing", 2)]
    with pytest.raises(ValueError, match="needs an id"):
        ids.enforce_ids(rows, "id")
