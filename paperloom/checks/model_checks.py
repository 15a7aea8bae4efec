"""Model-calling jobs with the stub (M)."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from paperloom.checks.base import CLAIMS_SQL, check, claims, table
from paperloom.checks.prompt_checks import SUMMARIES_SQL, _sql_render, summaries
from paperloom.functions.payloads import payload_messages
from paperloom.functions.prompts import TEMPLATES
from paperloom.functions.responses import first_text
from paperloom.operators.evaluation import judge_accuracy, judge_quality, model_table, output_sample
from paperloom.operators.invoke import Retry, ServiceError, call_digest, call_once, invoke, make_stub, prompt_of
from paperloom.plans.documents import compare_models, process_documents
from paperloom.staging import stage_path


def _stub_sql(prompt: str, model: str = "stub") -> str:
    return f"'[{model}] ' || trim({prompt}, E' \\n')"


def _requests(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", "role", payload_messages(F.col("text")).alias("payload"))


@check("m1_invoke", f"SELECT conv_id, turn, {_stub_sql('text')} AS answer FROM conversations")
def m1(spark, sf):
    return invoke(_requests(spark, sf), make_stub).select("conv_id", "turn", first_text(F.col("response")).alias("answer"))


def make_refusing():
    """The stub, but refusing system prompts."""
    stub = make_stub()

    def client(model_id, payload, policy):
        if model_id == "system":
            raise ServiceError("ResourceNotFoundException", "no such model")
        return stub(model_id, payload, policy)

    return client


@check(
    "m2_error_column",
    """SELECT conv_id, turn, role <> 'system' AS ok, CASE WHEN role = 'system' THEN 'ResourceNotFoundException' END AS error_code,
    CASE WHEN role = 'system' THEN 'no such model' END AS error_message, role <> 'system' AS answered FROM conversations""",
)
def m2(spark, sf):
    called = invoke(_requests(spark, sf).withColumn("model_id", F.col("role")), make_refusing, on_error="column")
    return called.select("conv_id", "turn", "ok", "error_code", "error_message", F.col("response").isNotNull().alias("answered"))


DELAY = 0.02


def make_delayed():
    """The stub, answering short prompts at once and others after a known time."""
    stub = make_stub()

    def client(model_id, payload, policy):
        if len(prompt_of(payload)) > 60:
            time.sleep(DELAY)
        return stub(model_id, payload, policy)

    return client


@check("m9_timed_invoke", "SELECT conv_id, turn, length(text) > 60 AS slow FROM conversations")
def m9(spark, sf):
    """Seconds tell the calls that took the client's delay from those that did not."""
    called = invoke(_requests(spark, sf), make_delayed)
    return called.select("conv_id", "turn", (F.col("seconds") >= DELAY).alias("slow"))


@check(
    "m1_call_once",
    f"""SELECT role, count(*) AS n_rows, count(DISTINCT md5(left(text, 40))) AS n_calls, min({_stub_sql("left(text, 40)")}) AS first_answer FROM conversations GROUP BY role""",
)
def m1_once(spark, sf):
    """Equal requests share a call: as many answers are kept as there are distinct beginnings of turns."""
    begun = table(spark, sf, "conversations").select("role", F.substring("text", 1, 40).alias("text"))
    requests = begun.select("role", F.lit("stub").alias("model_id"), payload_messages(F.col("text")).alias("payload"))
    folder = stage_path(spark, "kept-calls")
    answered = call_once(requests, make_stub, folder, slice_calls=200, retry=Retry()).withColumn("answer", first_text(F.col("response")))
    kept = spark.read.parquet(folder).select("_call")
    calls = requests.select("role", call_digest(["model_id", "payload"]).alias("_call")).distinct().join(kept, "_call").groupBy("role").agg(F.count("*").alias("n_calls"))
    return answered.groupBy("role").agg(F.count("*").alias("n_rows"), F.min("answer").alias("first_answer")).join(calls, "role")


_EXTRACTED = _stub_sql(_sql_render(TEMPLATES["extract_info"], document_text="text"))


@check(
    "m3_process_documents",
    f"""WITH {CLAIMS_SQL}, extracted AS (SELECT doc_id, {_EXTRACTED} AS extracted_text FROM claims)
    SELECT doc_id, extracted_text, {_stub_sql(_sql_render(TEMPLATES['generate_summary'], extracted_text='extracted_text'))} AS summary_text, true AS ok FROM extracted""",
)
def m3(spark, sf):
    return process_documents(claims(spark, sf), make_stub).select("doc_id", "extracted_text", "summary_text", "ok")


def _summarised(spark, sf):
    return summaries(spark, sf).select("doc_id", "text", F.col("summary").alias("summary_text"))


_ACCURACY_PROMPT = _sql_render(TEMPLATES["judge_accuracy"], claim_text="text", summary_text="summary")
_QUALITY_PROMPT = _sql_render(TEMPLATES["judge_quality"], summary_text="summary")


@check(
    "m5_judge_accuracy",
    f"""WITH {CLAIMS_SQL}, {SUMMARIES_SQL}, read AS (SELECT doc_id, md5({_ACCURACY_PROMPT}) AS seen FROM summaries)
    SELECT doc_id, round(('0x' || left(seen, 4))::BIGINT % 101 / 100, 2) AS accuracy, 'read ' || seen AS inaccuracies, true AS ok FROM read""",
)
def m5(spark, sf):
    judged = judge_accuracy(_summarised(spark, sf), make_stub, "judge")
    return judged.select("doc_id", "accuracy", F.array_join("inaccuracies", "|").alias("inaccuracies"), "ok")


@check(
    "m6_judge_quality",
    f"""WITH {CLAIMS_SQL}, {SUMMARIES_SQL}, read AS (SELECT doc_id, md5({_QUALITY_PROMPT}) AS seen FROM summaries),
    n AS (SELECT doc_id, seen, ('0x' || left(seen, 4))::BIGINT AS n FROM read)
    SELECT doc_id, 'clarity' AS metric, (n % 6)::DOUBLE AS score, NULL AS why FROM n UNION ALL
    SELECT doc_id, 'completeness', (n // 6 % 6)::DOUBLE, seen FROM n UNION ALL SELECT doc_id, 'overall', (n % 11) / 2, NULL FROM n""",
)
def m6(spark, sf):
    judged = judge_quality(_summarised(spark, sf), make_stub, "judge", policy=("gr-1", "3"))
    return judged.select("doc_id", F.explode("quality").alias("metric", "q")).select("doc_id", "metric", "q.score", "q.why")


def make_partial():
    """The stub, but one model is not to be had."""
    stub = make_stub()

    def client(model_id, payload, policy):
        if model_id == "model-c":
            raise ServiceError("ThrottlingException", "slow down")
        return stub(model_id, payload, policy)

    return client


def _compared_sql(prompt: str) -> str:
    return f"""WITH {CLAIMS_SQL}, runs AS (SELECT ordinal, model_id, CASE WHEN model_id <> 'model-c' THEN '[' || model_id || '] ' || trim({prompt}, E' \\n') END AS out
      FROM claims, (VALUES (0, 'model-a'), (1, 'model-c'), (2, 'model-b')) AS m(ordinal, model_id))
    SELECT model_id, ordinal, count(*) AS n_runs, count(*) FILTER (out IS NULL) AS n_failed, any_value(CASE WHEN out IS NULL THEN 'ThrottlingException' END) AS error_code,
    count(out) AS n_blocks, coalesce(sum(length(out)), 0)::BIGINT AS n_chars FROM runs GROUP BY ALL"""


def _compared(spark, sf, older):
    runs = compare_models(claims(spark, sf), MODELS, make_partial, older)
    sizes = runs.groupBy("model_id").agg(
        F.sum("n_blocks").alias("n_blocks"), F.sum("n_chars").cast("long").alias("n_chars"), F.max("error_code").alias("error_code")
    )
    return model_table(runs).join(sizes, "model_id").select("model_id", "ordinal", "n_runs", "n_failed", "error_code", "n_blocks", "n_chars")


MODELS = ["model-b", "model-a", "model-c", "model-b"]


@check("m10_compare_models", _compared_sql(_sql_render(TEMPLATES["extract_info"], document_text="text")))
def m10(spark, sf):
    return _compared(spark, sf, False)


_ASKED_IN_ONE_LINE = f"'Human:' || {_sql_render(TEMPLATES['compare'], document_text='text')} || chr(10) || chr(10) || 'Assistant:'"


@check("m10_compare_models_older", _compared_sql(_ASKED_IN_ONE_LINE))
def m10_older(spark, sf):
    """The older form: one line of prompt, the completion in place of content blocks."""
    return _compared(spark, sf, True)


@check(
    "g2_older_samples",
    f"""WITH {CLAIMS_SQL}, runs AS (SELECT doc_id, '[model-a] ' || trim({_ASKED_IN_ONE_LINE}, E' \\n') AS out FROM claims)
    SELECT doc_id, length(out)::INT AS n_chars, left(out, 100) || '...' AS sample FROM runs""",
)
def g2_older(spark, sf):
    runs = compare_models(claims(spark, sf), ["model-a"], make_stub, older=True)
    return runs.select("doc_id", "n_chars", output_sample(F.col("output_sample")).alias("sample"))
