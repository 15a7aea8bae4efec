"""Whole document jobs: extract and summarise, compare models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.payloads import payload_completion, payload_messages
from paperloom.functions.prompts import comparison_prompt, extraction_prompt, summary_prompt
from paperloom.functions.responses import completion_text, first_text
from paperloom.operators.evaluation import cross_models, model_metrics
from paperloom.operators.invoke import call_once, invoke
from paperloom.staging import stage, stage_path

EXTRACTION = {"temperature": 0.0, "max_tokens": 1024}
SUMMARY = {"temperature": 0.5, "max_tokens": 512}
OLDER_SUMMARY = {"temperature": 0.7, "max_tokens": 500}


def _call(requests: DataFrame, make_client: Callable, name: str, keep: str | None, share: bool, calls: dict) -> DataFrame:
    """``(doc_id, response, ok, ...)``: of a call only its key and outcome are written.

    Payloads are compared only where outcomes outlast the run or are shared.
    """
    requests, outcome = requests.select("doc_id", "model_id", "payload"), ["doc_id", "response", "ok", "error_code", "error_message"]
    if keep is None and not share:
        settings = {k: v for k, v in calls.items() if k != "slice_calls"}
        return stage(invoke(requests, make_client, "column", **settings).select(*outcome), name)
    folder = stage_path(requests.sparkSession, name) if keep is None else f"{keep.rstrip('/')}/{name}"
    return stage(call_once(requests, make_client, folder, None if share else "doc_id", **calls).select(*outcome), name)


def process_documents(
    docs: DataFrame,
    make_client: Callable,
    model_id: str = "stub",
    older: bool = False,
    with_text: bool = True,
    keep: str | None = None,
    share: bool = False,
    **calls,
) -> DataFrame:
    """M3: ``(doc_id, text, extracted_text, summary_body, summary_text, ok, ...)``.

    Each of the two calls per document is written down before the next one
    reads it; a document whose extraction failed keeps its error and is not
    summarised. Texts are sent, not written: ``with_text`` joins them to the
    outcome by key. ``keep`` names a folder where outcomes outlast the run, by
    a digest of what was sent: a rerun there calls only for what has no answer
    yet, and a changed text or prompt is called for anew. With ``share``
    documents of equal text share their calls. ``calls`` are settings of
    ``call_once`` (calls in flight, retries, slices).
    """
    asked = docs.select("doc_id", F.lit(model_id).alias("model_id"), payload_messages(extraction_prompt(F.col("text"), older), **EXTRACTION).alias("payload"))
    extracted = _call(asked, make_client, "extracted", keep, share, calls).withColumn("extracted_text", first_text(F.col("response"))).drop("response")
    settings = OLDER_SUMMARY if older else SUMMARY
    prompt = summary_prompt(F.col("extracted_text"), older)
    again = extracted.filter("ok").select("doc_id", F.lit(model_id).alias("model_id"), payload_messages(prompt, **settings).alias("payload"))
    summed = _call(again, make_client, "summed", keep, share, calls).select(
        "doc_id", F.col("response").alias("summary_body"), first_text(F.col("response")).alias("summary_text"), "ok", "error_code", "error_message"
    )
    outcome = ["ok", "error_code", "error_message"]
    failed = extracted.filter("NOT ok").select("doc_id", *[F.lit(None).cast("string").alias(c) for c in ("summary_body", "summary_text")], *outcome)
    done = extracted.select("doc_id", "extracted_text").join(summed.unionByName(failed), "doc_id")
    result = ["doc_id", "extracted_text", "summary_body", "summary_text", *outcome]
    return done.join(docs.select("doc_id", "text"), "doc_id").select("doc_id", "text", *result[1:]) if with_text else done.select(*result)


def compare_models(docs: DataFrame, models: list[str], make_client: Callable, older: bool = False) -> DataFrame:
    """One measured run per document and model; sum up with ``model_table``.

    A model named twice in the list is run once; its last place stands. A run
    that failed stays, with its error. The older form asks in one line and is
    answered by a completion.
    """
    names = [m for i, m in enumerate(models) if m not in models[i + 1 :]]
    prompt = comparison_prompt(F.col("text")) if older else extraction_prompt(F.col("text"))
    payload = payload_completion(prompt) if older else payload_messages(prompt, **EXTRACTION)
    asked = docs.select("doc_id", payload.alias("payload"))
    called = invoke(cross_models(asked, names), make_client, on_error="column").drop("payload")
    return model_metrics(stage(called, "runs"), text=completion_text if older else first_text)
