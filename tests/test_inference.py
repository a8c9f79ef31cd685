import os
import json
import threading
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillrun.functions import responses as rs
from quillrun.operators import inference as inf
from quillrun.operators import resume
from quillrun.plans import answers as an
from quillrun.session import materialise
from quillrun.streaming import ingest


def texts(spark, n=40):
    return spark.range(n).select("id", F.repeat(F.lit("a "), (F.col("id") % 50).cast("int") + 1)
                                 .alias("text"))


def test_retry_waits_and_stops():
    waits, calls = [], []

    def backend(request, timeout):
        calls.append(timeout)
        return (429, "{}") if len(calls) < 3 else (200, "ok")

    got = inf.call_with_retry(backend, "r", inf.Retry(5, timeout=7, sleep=waits.append))
    assert got == (200, "ok", None, 3)
    assert waits == [2.0, 4.0] and calls == [7, 7, 7]


def test_retry_gives_up_and_never_raises():
    def broken(request, timeout):
        raise TimeoutError

    got = inf.call_with_retry(broken, "r", inf.Retry(2, sleep=an.no_wait))
    assert got == (None, None, "TimeoutError", 2)
    got = inf.call_with_retry(lambda r, t: (400, "x"), "r", inf.Retry(9, sleep=an.no_wait))
    assert got.tries == 1
    assert inf.call_with_retry(broken, None, inf.Retry()).failure == inf.INVALID_TEXT
    with pytest.raises(ValueError):
        inf.Retry(0)
    with pytest.raises(ValueError):
        inf.Retry(timeout=0)


def test_pool_is_bounded_and_keeps_order():
    running, most, lock = [0], [0], threading.Lock()

    def backend(request, timeout):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(0.002)
        with lock:
            running[0] -= 1
        return 200, request

    for size in (1, 4):
        most[0] = 0
        caller = inf.Caller(backend, size, inf.Retry())
        got = list(caller.answers(str(i) for i in range(50)))
        caller.close()
        assert [r.body for r in got] == [str(i) for i in range(50)]
        assert most[0] <= size and (size == 1 or most[0] > 1)


def test_one_row_out_per_row_in_whatever_the_layout(spark):
    seen = set()
    for partitions, chunk_size, concurrency in ((1, 7, 1), (6, 1000, 5), (3, None, 2)):
        source = texts(spark).repartition(partitions)
        got = inf.infer(source, "text", "id", inf.embed_task(), an.EmbedBackend,
                        chunk_size=chunk_size, concurrency=concurrency, retry=an.FAST_RETRY)
        rows = frozenset((r["id"], str(r["embedding"]), r["error"], r["error_msg"], r["status"])
                         for r in got.collect())
        assert len(rows) == 40
        seen.add(rows)
    assert len(seen) == 1
    assert {r[3] for r in rows} == {None, "Too many requests", "Internal failure",
                                    "connection reset by peer", inf.UNREADABLE} - (
        {inf.UNREADABLE} if not any(len("a ") * (i % 50 + 1) % 17 == 9 for i in range(40)) else set())


def test_result_schema(spark):
    got = inf.infer(texts(spark, 3), "text", "id", inf.chat_task(), an.ChatBackend,
                    retry=an.FAST_RETRY)
    assert got.columns == ["id", "content", "error", "error_msg", "status", "chunk"]
    assert dict(got.dtypes)["status"] == "int" and dict(got.dtypes)["error"] == "boolean"


def test_one_call_per_row_with_two_branches(spark, folder):
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def backend(request, timeout):
            calls.add(1)
            return 200, "[[1.0]]"
        return backend

    got = inf.infer(texts(spark, 30), "text", "id", inf.embed_task(), factory, chunk_size=None)
    assert got.where("error").count() == 0 and got.where("not error").count() == 30
    assert calls.value == 30


def test_invalid_texts_are_never_sent(spark):
    rows = spark.createDataFrame([(1, ""), (2, None), (3, "abc")], "id int, text string")
    got = {r["id"]: r["error_msg"] for r in inf.infer(
        rows, "text", "id", inf.chat_task(), an.ChatBackend, chunk_size=None).collect()}
    assert got == {1: inf.INVALID_TEXT, 2: inf.INVALID_TEXT, 3: None}


def test_batched_results_go_back_to_their_rows(spark):
    rows = spark.createDataFrame(
        [(i, "" if i == 4 else None if i == 9 else "a" * i + "b") for i in range(23)],
        "id int, text string")
    got = inf.infer_batched(rows, "text", "id", an.EmbedManyBackend, result="embedding",
                            many=rs.embedding_vectors, batch_size=4, include_texts=True)
    found = {r["id"]: r for r in got.collect()}
    assert len(found) == 23
    assert all(r["embedding"] == an.vector_of(r["text"]) for i, r in found.items() if i not in (4, 9))
    assert found[4]["error"] and found[9]["error_msg"] == inf.INVALID_TEXT


def test_wrong_number_of_results_fails_the_request(spark):
    def factory():
        return lambda request, timeout: (200, "[[1.0],[2.0]]")

    rows = spark.range(5).select("id", F.lit("t").alias("text")).coalesce(1)
    got = inf.infer_batched(rows, "text", "id", factory, result="embedding",
                            many=rs.embedding_vectors, batch_size=3).collect()
    assert sorted(r["error"] for r in got) == [False, False, True, True, True]
    assert {r["error_msg"] for r in got} == {None, inf.WRONG_COUNT}


def test_tidy_may_be_an_arrow_function(spark):
    @F.pandas_udf("array<double>")
    def length_of(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda body: [float(len(body))], na_action="ignore")

    got = inf.infer(texts(spark, 4), "text", "id", inf.embed_task(tidy=length_of),
                    an.PatientBackend, chunk_size=None).collect()
    assert [r["embedding"] for r in sorted(got)] == [[len("[[2.0, 1.0, 1.0]]")]] * 4


def test_a_cut_off_run_calls_only_open_chunks_again(spark, folder, tmp_path):
    """A worker that dies in the middle takes the job with it, but no chunk that had ended."""
    source = texts(spark, 300).where("text is not null and text <> ''")
    log, marker = tmp_path / "calls", tmp_path / "died"

    def fatal():
        def backend(request, timeout):
            text = json.loads(request)["inputs"]
            with open(log, "a") as calls:
                calls.write(f"{text}\n")
            time.sleep(0.005)
            if text.startswith("row 150") and not marker.exists():
                marker.write_text("")
                os._exit(1)
            return 200, json.dumps([an.vector_of(text)])
        return backend

    source = source.withColumn("text", F.concat(F.lit("row "), F.col("id").cast("string")))
    settings = dict(chunk_size=5, retry=an.FAST_RETRY, concurrency=1)
    with pytest.raises(Exception):
        resume.run_in_chunks(source, "text", "id", inf.embed_task(), fatal, folder, **settings)
    before = log.read_text().splitlines()
    kept = spark.read.parquet(f"{folder}/responses")
    assert kept.groupBy("chunk").count().where("count <> 5").count() <= 1  # the last chunk may be shorter
    done = {r.id for r in kept.select("id").collect()}
    got = resume.run_in_chunks(source, "text", "id", inf.embed_task(), fatal, folder, **settings)
    again = log.read_text().splitlines()[len(before):]
    everything = {r.id for r in source.collect()}
    assert sorted(int(t.split()[1]) for t in again) == sorted(everything - done) and done
    assert len(set(before) & set(again)) <= 5 * 8  # a chunk of each task that was cut off
    assert {r.id for r in got.collect()} == everything and got.where("error").count() == 0
    calls = len(log.read_text().splitlines())
    assert resume.run_in_chunks(source, "text", "id", inf.embed_task(), fatal, folder, **settings).count() == len(everything)
    assert len(log.read_text().splitlines()) == calls


def test_a_provider_is_waited_for_as_long_as_it_asks():
    waits, tries = [], iter([(429, "", 3.0), (503, "", None), (429, "", 1e9), (200, "ok")])
    retry = inf.Retry(sleep=waits.append, longest_wait=50.0)
    assert inf.call_with_retry(lambda *_: next(tries), "{}", retry) == inf.Answer(200, "ok", None, 4)
    assert waits == [3.0, 4.0, 50.0]
    assert [retry.wait(2, asked) for asked in (None, -1.0, float("nan"), 0.0)] == [4.0, 4.0, 4.0, 0.0]


def test_a_client_that_waits_as_asked_is_not_given_up(monkeypatch):
    monkeypatch.setattr(inf, "GRACE_SECONDS", 0.05)
    tries = iter([(429, "", 1.0), (200, "ok")])
    caller = inf.Caller(lambda *_: next(tries), 1, inf.Retry(max_tries=2, timeout=0.1, backoff=0.01))
    assert [a.body for a in caller.answers(["{}"])] == ["ok"]


def test_throttle_halves_once_a_burst_and_recovers():
    throttle = inf.Throttle(8)
    burst = [throttle.enter() for _ in range(4)]
    for entered in burst:
        throttle.leave(entered, True, False)
    assert throttle.limit == 4
    throttle.leave(throttle.enter(), True, False)
    assert throttle.limit == 2
    for _ in range(2):
        throttle.leave(throttle.enter(), False, True)
    assert throttle.limit == 3
    for _ in range(60):
        throttle.leave(throttle.enter(), False, True)
    assert throttle.limit == 8
    for _ in range(9):
        throttle.leave(throttle.enter(), True, False)
    assert throttle.limit == 1


def test_fewer_calls_run_after_too_many_requests():
    running, most, refused = [0], [], [4]
    lock = threading.Lock()

    def backend(request, timeout):
        with lock:
            running[0] += 1
            most.append(running[0])
        time.sleep(0.01)
        with lock:
            running[0] -= 1
            if refused[0]:
                refused[0] -= 1
                return 429, ""
        return 200, "ok"

    caller = inf.Caller(backend, 8, inf.Retry(max_tries=20, backoff=0.0))
    assert {a.body for a in caller.answers(["{}"] * 60)} == {"ok"}
    assert max(most) <= 8 and caller.throttle.limit > 1


def test_remembered_ids_are_forgotten_in_time(spark, folder):
    def arrive(*rows):
        spark.createDataFrame(rows, "id long, text string").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        return ingest.infer_arrivals(
            spark, f"{folder}/in", T.StructType.fromDDL("id long, text string"), "text", "id", inf.embed_task(),
            an.EmbedBackend, f"{folder}/out", f"{folder}/checkpoint", files_per_batch=1, once_per_id=True,
            remember="4 seconds", state_partitions=2, retry=an.FAST_RETRY)

    assert arrive((1, "a"), (1, "b"), (None, "c"), (None, "c")).count() == 3
    time.sleep(6)
    arrive((2, "d"))            # moves the clock on
    arrive((3, "e"))            # and drops what is past it
    state = spark.read.format("statestore").load(f"{folder}/checkpoint")
    held = {r["k"] for r in state.selectExpr("key.__key AS k").collect()}
    assert "id:1" not in held and "id:3" in held
    assert arrive((1, "again")).where("id = 1").count() == 2


def test_failed_rows_get_a_second_try(spark):
    source = texts(spark, 40)
    first = inf.infer(source, "text", "id", inf.embed_task(), an.EmbedBackend, retry=an.FAST_RETRY)
    assert first.where("error").count() > 0
    both = resume.retry_failed(first, source, "text", "id", inf.embed_task(), an.PatientBackend)
    assert both.count() == 40 and both.where("error").count() == 0
    assert both.where("attempt = 2").count() == first.where("error").count()
    assert both.where("chunk is null").count() == 0


def test_latest_attempt(spark):
    log = spark.createDataFrame([(1, 1, "x"), (1, 2, None), (2, 1, "z")],
                                "id int, attempt int, content string")
    got = sorted(map(tuple, resume.latest_attempt(log, "id").collect()))
    assert got == [(1, 2, None), (2, 1, "z")]


# --- streams -----------------------------------------------------------------------------------

def write_lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.mode("append").text(path)


def test_result_files_as_they_land(spark, folder):
    def line(id):
        return json.dumps({"custom_id": id, "response": {"body": {
            "choices": [{"message": {"content": id * 2}}]}}})

    landing, target, checkpoint = (f"{folder}/{x}" for x in ("landing", "target", "checkpoint"))
    write_lines(spark, landing, [line("a"), line("a"), "broken", line("b")])

    def run():
        return ingest.ingest_results(spark, landing, "completions", target, checkpoint)

    assert sorted(r["custom_id"] for r in run().collect()) == ["__PARSE_ERROR_LINE_3", "a", "a", "b"]
    write_lines(spark, landing, [line("b"), line("c"), '{"no":"id"}', "broken"])
    got = run().collect()
    assert sorted(str(r["custom_id"]) for r in got) == [
        "None", "__PARSE_ERROR_LINE_3", "__PARSE_ERROR_LINE_4", "a", "a", "b", "b", "c"]
    assert run().count() == 8
    assert {r["custom_id"]: r["content"] for r in got}["c"] == "cc"


def test_nothing_has_landed_yet(spark, folder):
    landing = f"{folder}/landing"
    spark.createDataFrame([], "v string").write.text(landing)
    got = ingest.ingest_results(spark, landing, "messages", f"{folder}/t", f"{folder}/c")
    assert got.count() == 0 and "stop_reason" in got.columns


def test_arrivals_are_called_once(spark, folder):
    calls = spark.sparkContext.accumulator(0)

    def counting():
        def backend(request, timeout):
            calls.add(1)
            return 200, "[[1.0]]"
        return backend

    source = texts(spark, 30)

    def run():
        return ingest.infer_arrivals(
            spark, f"{folder}/landing", source.schema, "text", "id", inf.embed_task(), counting,
            f"{folder}/target", f"{folder}/checkpoint", files_per_batch=1, once_per_id=True)

    source.where("id < 20").write.parquet(f"{folder}/landing")
    assert run().count() == 20
    source.where("id >= 10").write.mode("append").parquet(f"{folder}/landing")
    got = run()
    assert got.count() == 30 and got.select("id").distinct().count() == 30
    assert calls.value == 30


def test_a_given_run_folder_gets_metadata(spark, folder):
    from quillrun.sources.runs import read_metadata, run_log

    assert read_metadata(spark, folder) is None
    task = inf.chat_task(system_prompt="p", schema=an.REVIEW)
    inf.infer(texts(spark, 10), "text", "id", task, an.ChatBackend, chunk_size=4,
              retry=an.FAST_RETRY, run_dir=folder)
    row = run_log(spark, folder).first()
    assert (row["n_texts"], row["n_chunks"], row["chunk_size"]) == (10, 3, 4)
    assert (row["model"], row["system_prompt"], row["max_retries"]) == ("gpt-4.1-nano", "p", 3)
    assert json.loads(row["schema"])["json_schema"]["name"] == "review"
    assert read_metadata(spark, folder)["n_texts"] == 10


def test_waves_keep_repeated_ids(spark, folder):
    rows = spark.createDataFrame([(1, "abc"), (1, "abcd"), (2, "x")], "id int, text string")
    got = resume.run_in_chunks(rows, "text", "id", inf.embed_task(), an.EmbedBackend, folder,
                              chunk_size=2, retry=an.FAST_RETRY)
    assert sorted(r["id"] for r in got.collect()) == [1, 1, 2]


def test_empty_tables_give_empty_results(spark, folder):
    nothing = texts(spark, 5).where("false")
    for got in (
            inf.infer(nothing, "text", "id", inf.chat_task(), an.ChatBackend),
            resume.run_in_chunks(nothing, "text", "id", inf.chat_task(), an.ChatBackend, folder)):
        assert got.count() == 0
        assert got.columns == ["id", "content", "error", "error_msg", "status", "chunk"]


def test_a_failure_and_a_later_success_of_one_id_both_land(spark, folder):
    def line(id, **answer):
        return json.dumps({"custom_id": id, **answer})

    good = {"response": {"body": {"choices": [{"message": {"content": "fine"}}]}}}
    for batch, lines in enumerate([[line("1", **good), line("3", error={"message": "busy"})],
                                   [line("1", **good), line("2", **good)], [line("3", **good)]]):
        write_lines(spark, f"{folder}/in/batch-{batch}", lines)
    got = ingest.ingest_results(spark, f"{folder}/in/*", "completions", f"{folder}/t", f"{folder}/c")
    found = sorted((r["custom_id"], r["content"]) for r in got.collect() if not r["error"])
    assert found == [("1", "fine"), ("1", "fine"), ("2", "fine"), ("3", "fine")]
    assert got.where("error").select("custom_id").collect()[0][0] == "3" and got.count() == 5


@pytest.mark.parametrize("once, wanted", [(False, 6), (True, 5)])
def test_arrivals_without_an_id_are_not_each_others_repeats(spark, folder, once, wanted):
    rows = spark.createDataFrame([(None, "a"), (None, "b"), (None, "a"), (4, "x"), (4, "y"), (5, "z")],
                                 "id long, text string")
    rows.repartition(3).write.parquet(f"{folder}/in")
    got = ingest.infer_arrivals(spark, f"{folder}/in", rows.schema, "text", "id", inf.embed_task(),
                                an.EmbedBackend, f"{folder}/t", f"{folder}/c", retry=an.FAST_RETRY,
                                once_per_id=once)
    assert got.count() == wanted and got.where("id IS NULL").count() == 3


def test_waves_refuse_another_run(spark, folder):
    settings = dict(chunk_size=4, retry=an.FAST_RETRY)
    rows = texts(spark, 10)
    resume.run_in_chunks(rows, "text", "id", inf.embed_task(), an.EmbedBackend, folder, **settings)
    again = resume.run_in_chunks(rows.repartition(3), "text", "id", inf.embed_task(), an.EmbedBackend,
                                folder, **settings)
    assert again.count() == 10
    for other, task, more in (
            (rows.withColumn("id", F.col("id") + 1), inf.embed_task(), {}),
            (rows, inf.chat_task(), {}), (rows, inf.embed_task({"truncate": False}), {}),
            (rows, inf.embed_task(), {"chunk_size": 5}), (rows.limit(9), inf.embed_task(), {})):
        with pytest.raises(ValueError, match="another table, task or settings"):
            resume.run_in_chunks(other, "text", "id", task, an.EmbedBackend, folder,
                                **{**settings, **more})


def test_waves_of_texts_that_are_all_dropped(spark, folder):
    rows = spark.createDataFrame([(1, ""), (2, None)], "id int, text string")
    got = resume.run_in_chunks(rows, "text", "id", inf.embed_task(), an.EmbedBackend, folder,
                              on_invalid="drop")
    assert got.count() == 0 and "embedding" in got.columns


def test_retry_of_repeated_ids(spark, folder):
    long = {n: "x" * n for n in (1, 5, 6, 22)}  # lengths 5, 6 and 22 fail at first
    rows = spark.createDataFrame([(7, 0, long[1]), (7, 1, long[5]), (7, 2, long[22]), (8, 3, long[6])],
                                 "id int, place int, text string")
    first = materialise(inf.infer(rows, "text", "id", inf.embed_task(), an.EmbedBackend, chunk_size=2,
                                  retry=an.FAST_RETRY, keep=["place"]), "first")
    with pytest.raises(ValueError, match="does not tell"):
        resume.retry_failed(first, rows, "text", "id", inf.embed_task(), an.PatientBackend)
    both = resume.retry_failed(first, rows, "text", "id", inf.embed_task(), an.PatientBackend,
                               key=["id", "place"])
    assert sorted((r["id"], r["place"], r["embedding"][0], r["attempt"], r["chunk"]) for r in both.collect()) == [
        (7, 0, 1.0, 1, 1), (7, 1, 5.0, 2, 1), (7, 2, 22.0, 2, 2), (8, 3, 6.0, 2, 2)]


def test_chunks_in_stored_order_move_no_text(spark, documents):
    requests = inf.request_table(documents, "text", "doc_id", inf.embed_task(), chunk_size=50)
    plan = requests._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
    assert requests.groupBy("chunk").count().where("count = 50").count() == documents.count() // 50


def test_a_client_that_ignores_its_timeout_costs_one_row(monkeypatch):
    monkeypatch.setattr(inf, "GRACE_SECONDS", 0.0)
    released = threading.Event()

    def backend(request, timeout):
        if request == "3":
            released.wait(20)
        return 200, request

    caller = inf.Caller(backend, 2, inf.Retry(1, timeout=0.3))
    got = list(caller.answers(str(i) for i in range(30)))
    released.set()
    caller.close()
    assert [a.body for a in got] == [str(i) if i != 3 else None for i in range(30)]
    assert (got[3].status, got[3].failure) == (None, inf.NO_ANSWER)


def test_requests_are_drawn_as_they_are_answered():
    drawn, ahead = [0], [0]

    def requests():
        for i in range(400):
            drawn[0] += 1
            yield str(i)

    caller = inf.Caller(lambda r, t: (200, r), 4, inf.Retry())
    for done, _ in enumerate(caller.answers(requests())):
        ahead[0] = max(ahead[0], drawn[0] - done)
    caller.close()
    assert ahead[0] <= 9


def test_batched_answers_copy_no_body(spark):
    responses = spark.createDataFrame(
        [([(1, "a"), (2, "b")], (200, "[[1.0],[2.0]]", None, 1)), ([(3, "c")], (200, "[[1.0],[2.0]]", None, 1)),
         ([(4, "d")], (500, "x", None, 2)), ([(5, "e"), (6, "f")], (200, "[[1.0],[]]", None, 1))],
        f"items array<struct<id:int,k:string>>, response {inf.RESPONSE}")
    got = inf.tidy_batched(responses, "v", inf.rs.embedding_vectors)
    above = got._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "response" not in above
    assert [(r["id"], r["v"], r["error"], r["status"]) for r in got.orderBy("id").collect()] == [
        (1, [1.0], False, None), (2, [2.0], False, None), (3, None, True, None), (4, None, True, 500),
        (5, None, True, None), (6, None, True, None)]


def test_result_files_are_read_once(spark, folder):
    from quillrun.operators.results import parse_files

    write_lines(spark, folder, ['{"custom_id":"a","error":{"message":"no"}}', "broken"])
    got = parse_files(spark, folder, "completions")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan  # read, parsed and stored before
    assert sorted(r["custom_id"] for r in got.collect()) == ["__PARSE_ERROR_LINE_2", "a"]


def test_a_table_dealt_out_anew_is_read_by_as_many_tasks_as_it_needs(spark, folder, monkeypatch):
    from quillrun.plans import model_calls

    texts(spark, 2000).select(F.col("id").alias("doc_id"), F.concat("text", F.uuid()).alias("text")) \
        .write.parquet(f"{folder}/documents.parquet")
    given, run = [], resume.run_in_chunks
    monkeypatch.setattr(resume, "run_in_chunks", lambda df, *a, **k: given.append(df) or run(df, *a, **k))
    small = "spark.sql.adaptive.coalescePartitions.enabled"  # which would put these few rows into one task
    spark.conf.set(small, "false")
    try:
        assert tuple(model_calls.other_input_refused(spark, folder).first()) == (2000, True)
        assert given[1].rdd.getNumPartitions() > 3
    finally:
        spark.conf.unset(small)
