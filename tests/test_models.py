import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from paperloom.functions.payloads import payload_completion, payload_messages
from paperloom.functions.responses import completion_text, first_text
from paperloom.operators.evaluation import judge_accuracy, judge_quality, model_table
from paperloom.operators.invoke import Retry, ServiceError, _in_flight, call_once, invoke, make_stub
from paperloom.plans.documents import compare_models, process_documents


def _docs(spark, n=4):
    return spark.createDataFrame([(i, f"Claimant Name: P{i}\nClaim Amount: ${i}.00") for i in range(n)], "doc_id long, text string")


def make_picky():
    """Refuses documents of P1; answers with what it was given."""

    def client(model_id, payload, policy):
        prompt = payload["messages"][0]["content"][0]["text"]
        if "P1" in prompt:
            raise ServiceError("ResourceNotFoundException", "gone")
        return {"content": [{"type": "text", "text": f"{model_id}|{policy}|{payload['temperature']}|{payload['max_tokens']}|{len(prompt)}"}]}

    return client


def test_errors_as_column_or_failure(spark):
    requests = _docs(spark).withColumn("payload", payload_messages(F.col("text")))
    got = {r["doc_id"]: r for r in invoke(requests, make_picky, "column").collect()}
    assert (got[1]["ok"], got[1]["error_code"], got[1]["error_message"], got[1]["response"]) == (False, "ResourceNotFoundException", "gone", None)
    assert got[0]["ok"] and got[0]["seconds"] >= 0
    with pytest.raises(Exception, match="model invocation failed: ResourceNotFoundException - gone"):
        invoke(requests, make_picky).collect()
    with pytest.raises(ValueError):
        invoke(requests, make_picky, "ignore")


def test_policy_reaches_the_client_only_whole(spark):
    rows = _docs(spark, 1).withColumn("payload", payload_messages(F.col("text"), temperature=0.0, max_tokens=7))
    for pid, version, seen in (("g", "1", "('g', '1')"), ("g", None, "None")):
        sent = rows.withColumns({"model_id": F.lit("m"), "policy_id": F.lit(pid), "policy_version": F.lit(version).cast("string")})
        text = invoke(sent, make_picky).select(first_text(F.col("response"))).first()[0]
        assert text.startswith(f"m|{seen}|0.0|7|")


def test_older_completion_style(spark):
    rows = _docs(spark, 1).withColumn("payload", payload_completion(F.col("text")))
    assert invoke(rows, make_stub).select(completion_text(F.col("response"))).first()[0].endswith("Assistant:")


def test_process_documents_keeps_failures(spark):
    done = {r["doc_id"]: r for r in process_documents(_docs(spark), make_picky, "m").collect()}
    assert len(done) == 4
    assert done[1]["ok"] is False and done[1]["summary_text"] is None and done[1]["error_code"] == "ResourceNotFoundException"
    assert done[0]["extracted_text"].startswith("m|None|0.0|1024|") and done[0]["summary_text"].startswith("m|None|0.5|512|")
    older = process_documents(_docs(spark, 1), make_picky, "m", older=True).first()
    assert older["summary_text"].startswith("m|None|0.7|500|")


def test_process_documents_calls_once_per_step(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def make_counting():
        def client(model_id, payload, policy):
            prompt = payload["messages"][0]["content"][0]["text"]
            import uuid

            (log / uuid.uuid4().hex).write_text(prompt)
            return {"content": [{"text": "x"}]}

        return client

    done = process_documents(_docs(spark), make_counting)
    done.count(), done.collect(), done.filter("ok").count()
    assert len(list(log.iterdir())) == 8


def test_a_rerun_calls_only_for_what_has_no_answer(spark, tmp_path):
    log, down = tmp_path / "calls", tmp_path / "down"
    log.mkdir()
    down.touch()

    def make_flaky():
        def client(model_id, payload, policy):
            import uuid

            prompt = payload["messages"][0]["content"][0]["text"]
            (log / uuid.uuid4().hex).write_text(prompt)
            if down.exists() and "Document" in prompt and prompt.split("Document:")[1].split()[0].endswith("1"):
                raise ServiceError("ThrottlingException", "later")
            return {"content": [{"text": "x"}]}

        return client

    docs = spark.createDataFrame([(i, f"doc{i} text") for i in range(3)], "doc_id long, text string")
    keep = str(tmp_path / "kept")
    first = process_documents(docs, make_flaky, keep=keep)
    assert {r["doc_id"]: r["ok"] for r in first.collect()} == {0: True, 1: False, 2: True}
    assert len(list(log.iterdir())) == 5
    down.unlink()
    second = process_documents(docs, make_flaky, keep=keep)
    assert {r["doc_id"]: r["ok"] for r in second.collect()} == {0: True, 1: True, 2: True}
    assert len(list(log.iterdir())) == 7  # one extraction and one summary more


def test_judges(spark):
    rows = _docs(spark, 2).withColumn("summary_text", F.lit("short"))
    accuracy = judge_accuracy(rows, make_stub, "judge").first()
    assert 0 <= accuracy["accuracy"] <= 1 and accuracy["inaccuracies"][0].startswith("read ")
    other = judge_accuracy(rows.withColumn("text", F.concat("text", F.lit("!"))), make_stub, "judge").first()
    assert other["inaccuracies"] != accuracy["inaccuracies"]  # the verdict follows the claim
    quality = judge_quality(rows, make_stub, "judge", policy=("g", "1")).first()["quality"]
    assert set(quality) == {"clarity", "completeness", "overall"} and all(0 <= v["score"] <= 5 for v in quality.values())


def test_calls_are_dealt_over_tasks(spark):
    rows = _docs(spark, 64).coalesce(1).withColumn("payload", payload_completion(F.col("text")))
    called = invoke(rows, make_stub, parallel=4)
    assert called.groupBy(F.spark_partition_id()).count().count() == 4
    assert called.count() == 64


def test_the_stub_says_the_whole_prompt(spark):
    rows = spark.createDataFrame([(0, "x" * 5000)], "doc_id long, text string").withColumn("payload", payload_completion(F.col("text")))
    assert "x" * 5000 in invoke(rows, make_stub).first()["response"]


def test_failed_runs_stay_in_the_comparison(spark):
    def make_throttled():
        def client(model_id, payload, policy):
            if model_id == "slow":
                raise ServiceError("ThrottlingException", "later")
            return {"content": [{"text": "x"}]}

        return client

    table = {r["model_id"]: r for r in model_table(compare_models(_docs(spark, 3), ["slow", "quick"], make_throttled)).collect()}
    assert (table["slow"]["n_runs"], table["slow"]["n_failed"], table["slow"]["avg_seconds"]) == (3, 3, None)
    assert (table["quick"]["n_runs"], table["quick"]["n_failed"]) == (3, 0) and table["quick"]["p95_seconds"] is not None


def test_compare_models_runs_a_repeated_model_once(spark):
    runs = compare_models(_docs(spark, 3), ["b", "a", "b"], make_stub)
    assert sorted({(r["ordinal"], r["model_id"]) for r in runs.collect()}) == [(0, "a"), (1, "b")] and runs.count() == 6
    assert {r["n_blocks"] for r in runs.collect()} == {1}


def _counting(log, refuse=0, code="ThrottlingException"):
    """Clients that note every call in a folder, and refuse the first calls of each prompt."""

    def make():
        def client(model_id, payload, policy):
            import hashlib
            import uuid

            prompt = payload["messages"][0]["content"][0]["text"]
            name = hashlib.md5(prompt.encode()).hexdigest()
            (log / f"{name}-{uuid.uuid4().hex}").write_text(prompt)
            if len(list(log.glob(f"{name}-*"))) <= refuse:
                raise ServiceError(code, "later")
            return {"content": [{"text": f"{model_id}: {prompt}"}]}

        return client

    return make


def _texts(df):
    return sorted((r["doc_id"], r["t"]) for r in df.select("doc_id", first_text(F.col("response")).alias("t")).collect())


def test_equal_requests_are_one_call(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()
    rows = spark.range(90).select(F.col("id").alias("doc_id"), F.lit("m").alias("model_id"), payload_messages(F.concat(F.lit("text "), (F.col("id") % 3).cast("string"))).alias("payload"))
    rows = rows.unionByName(spark.createDataFrame([(90, "m", None)], rows.schema))
    got = call_once(rows, _counting(log), str(tmp_path / "kept"), slice_calls=2)
    assert _texts(got)[:2] == [(0, "m: text 0"), (1, "m: text 1")] and got.count() == 91
    assert got.filter("NOT ok").select("doc_id", "error_code").collect()[0] == (90, "NoPayload")
    assert len(list(log.iterdir())) == 3
    # another model is another call, what has an answer is not asked again
    more = rows.withColumn("model_id", F.when(F.col("doc_id") < 3, "n").otherwise("m"))
    assert _texts(call_once(more, _counting(log), str(tmp_path / "kept")))[0] == (0, "n: text 0")
    assert len(list(log.iterdir())) == 6


def test_named_errors_are_tried_again(spark, tmp_path):
    rows = _docs(spark, 4).withColumn("payload", payload_messages(F.col("text")))
    quick = Retry(first=0.01)
    for name, refuse, code, retry, calls, ok in [
        ("a", 2, "ThrottlingException", quick, 12, True),
        ("b", 9, "ThrottlingException", quick, 16, False),
        ("c", 1, "AccessDeniedException", quick, 4, False),
        ("d", 1, "ThrottlingException", None, 4, False),
    ]:
        log = tmp_path / name
        log.mkdir()
        got = invoke(rows, _counting(log, refuse, code), "column", retry=retry).select("ok").collect()
        assert [r["ok"] for r in got] == [ok] * 4 and len(list(log.iterdir())) == calls, name
    waits = [Retry().wait(n) for n in (1, 2, 3)]
    assert 0.25 <= waits[0] <= 0.5 <= waits[1] <= 1 <= waits[2] <= 2


def test_a_broken_run_repeats_no_finished_slice(spark, tmp_path):
    log, broken = tmp_path / "calls", tmp_path / "broken"
    log.mkdir()
    broken.touch()
    counting = _counting(log)

    def make():
        inner = counting()

        def client(model_id, payload, policy):
            if broken.exists() and len(list(log.iterdir())) >= 30:
                raise RuntimeError("lost")
            return inner(model_id, payload, policy)

        return client

    rows = spark.range(60).select(F.col("id").alias("doc_id"), payload_messages(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("payload"))
    with pytest.raises(Exception, match="lost"):
        call_once(rows, make, str(tmp_path / "kept"), slice_calls=10, parallel=1, in_flight=1)
    committed = spark.read.parquet(str(tmp_path / "kept")).count()
    assert 0 < committed <= 30
    broken.unlink()
    before = len(list(log.iterdir()))
    assert call_once(rows, make, str(tmp_path / "kept"), slice_calls=10).filter("ok").count() == 60
    assert len(list(log.iterdir())) - before == 60 - committed


def test_time_falls_with_the_calls_in_flight(spark):
    import time

    def make_slow():
        def client(model_id, payload, policy):
            time.sleep(0.05)
            return {"content": [{"text": "x"}]}

        return client

    rows = _docs(spark, 64).withColumn("payload", payload_messages(F.col("text")))
    invoke(rows, make_stub, parallel=1).count()

    def seconds(n):
        started = time.perf_counter()
        assert invoke(rows, make_slow, parallel=1, in_flight=n).agg(F.sum("seconds")).first()[0] >= 64 * 0.05
        return time.perf_counter() - started

    assert seconds(16) < seconds(1) / 3
    with pytest.raises(ValueError):
        invoke(rows, make_slow, in_flight=0)


def test_kept_answers_are_those_of_the_same_text(spark, tmp_path):
    """A changed text, prompt or model under the same id is called for anew."""
    keep = str(tmp_path / "kept")
    docs = lambda text: spark.createDataFrame([(1, text)], "doc_id long, text string")
    first = process_documents(docs("first text"), make_stub, keep=keep).first()
    second = process_documents(docs("SECOND TEXT"), make_stub, keep=keep).first()
    assert "first text" in first["extracted_text"] and "SECOND TEXT" in second["extracted_text"] and "first" not in second["extracted_text"]
    older = process_documents(docs("SECOND TEXT"), make_stub, keep=keep, older=True).first()
    other = process_documents(docs("SECOND TEXT"), make_stub, "other", keep=keep).first()
    assert older["extracted_text"] != second["extracted_text"] and other["extracted_text"].startswith("[other]")


def test_documents_of_equal_text_may_share_their_calls(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()
    docs = spark.createDataFrame([(i, f"text {i % 2}") for i in range(8)], "doc_id long, text string")
    done = process_documents(docs, _counting(log), share=True, in_flight=2)
    assert len({r["summary_text"] for r in done.collect()}) == 2 and len(list(log.iterdir())) == 4


def test_slices_do_not_cost_a_job_each(spark, tmp_path):
    """Two hundred slices are committed by a bounded number of jobs, and a broken job keeps those that ended."""
    rows = spark.range(400).select(F.col("id").alias("doc_id"), payload_messages(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("payload"))
    spark.sparkContext.setJobGroup("slices", "slices")
    try:
        got = call_once(rows, make_stub, str(tmp_path / "kept"), slice_calls=2)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("slices"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert jobs < 40 and got.filter("ok").count() == 400
    kept = spark.read.parquet(str(tmp_path / "kept"))
    assert kept.count() == 400 and kept.select(F.input_file_name()).distinct().count() >= 150

    broken, seen = tmp_path / "broken", tmp_path / "seen"
    broken.touch()
    seen.mkdir()

    def make():
        stub = make_stub()

        def client(model_id, payload, policy):
            if broken.exists() and len(list(seen.iterdir())) >= 100:
                raise RuntimeError("lost")
            (seen / str(time.perf_counter_ns())).touch()
            return stub(model_id, payload, policy)

        return client

    with pytest.raises(Exception, match="lost"):
        call_once(rows, make, str(tmp_path / "half"), slice_calls=2)
    assert spark.read.schema("_call string").parquet(str(tmp_path / "half")).count() > 0
    broken.unlink()
    assert call_once(rows, make, str(tmp_path / "half"), slice_calls=2).filter("ok").count() == 400


def test_a_call_is_no_task_of_the_pool():
    """As many pieces of work as threads, whatever the calls: handing over each one cost more than a quick call."""
    handed = []

    class Pool(ThreadPoolExecutor):
        def submit(self, *args, **named):
            handed.append(1)
            return super().submit(*args, **named)

    with Pool(4) as pool:
        assert list(_in_flight(pool, lambda args: (args[0] * 2,), iter([(n,) for n in range(1000)]), 4)) == [(n * 2,) for n in range(1000)]
        assert len(handed) <= 8 and list(_in_flight(pool, None, iter([]), 4)) == []

        made = []

        def broken(args):
            made.append(args)
            if len(made) == 20:
                raise ValueError("lost")
            return args

        with pytest.raises(ValueError, match="lost"):
            list(_in_flight(pool, broken, iter([(n,) for n in range(1000)]), 4))
        assert len(made) <= 24
