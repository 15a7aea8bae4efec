"""Context assembly and answers with citations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.functions.payloads import payload_nova
from paperloom.functions.policy import Policy
from paperloom.functions.prompts import render
from paperloom.functions.responses import first_text
from paperloom.functions.text import sentences
from paperloom.operators.ingest import Index
from paperloom.operators.invoke import invoke
from paperloom.operators.retrieval import overlap, retrieve, with_texts
from paperloom.operators.screening import apply_policy
from paperloom.staging import stage

# Fixed value: the generation instruction the answers are asked with.
ANSWER_TEMPLATE = "Answer clearly using the citations.\n\n{text}"
OUTCOME = ("ok", "error_code", "error_message")
CITATION = "struct<rank:int,chunk_id:string,text:string>"


def build_context(hits: DataFrame, template: str = ANSWER_TEMPLATE) -> DataFrame:
    """``(query_id, prompt, citations)``; a question has at most k hits."""
    passages = hits.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "chunk_id", "text"))).alias("citations"))
    marked = F.transform("citations", lambda c: F.concat(F.lit("["), c["rank"].cast("string"), F.lit("] "), c["text"]))
    return passages.select("query_id", render(template, text=F.array_join(marked, "\n")).alias("prompt"), "citations")


def answer(
    questions: DataFrame,
    index: Index,
    make_client: Callable,
    k: int = 3,
    max_tokens: int | Column = 512,
    temperature: float | Column = 0.5,
    policy: Policy | None = None,
    model_id: str = "stub",
) -> DataFrame:
    """Retrieve and generate: ``(query_id, question, answer, citations, ok,
    error_code, error_message, action)``.

    With a policy, blocked questions are answered by its message, without
    citations, and answers are screened too. A failed call gives a null answer
    and its error; a blocked question was not sent, so its outcome is null. The
    calls are written to a stage table, so no later step repeats them.
    """
    asked = questions if policy is None else apply_policy(questions, policy, "input", "question")
    passed = asked if policy is None else asked.filter(F.col("action") != "blocked")
    contexts = build_context(with_texts(stage(retrieve(passed, index, k), "hits"), index))
    # a question without hits is still asked, with no citations
    requests = (
        passed.join(contexts, "query_id", "left")
        .withColumn("citations", F.coalesce("citations", F.array().cast(f"array<{CITATION}>")))
        .withColumn("prompt", F.concat(F.coalesce("prompt", F.lit("")), F.lit("\n\nQuestion: "), F.col("question")))
        .withColumn("payload", payload_nova(F.col("prompt"), max_tokens=max_tokens, temperature=temperature))
        .withColumn("model_id", F.lit(model_id))
    )
    called = stage(invoke(requests, make_client, on_error="column").drop("payload", "prompt"), "answers")
    answered = called.select("query_id", "question", first_text(F.col("response")).alias("answer"), "citations", *OUTCOME)
    if policy is None:
        return answered.withColumn("action", F.lit("none"))
    output = apply_policy(answered, policy, "output", "answer").drop("reasons")
    refused = asked.filter(F.col("action") == "blocked").select(
        "query_id", "question", F.col("question").alias("answer"), F.array().cast(f"array<{CITATION}>").alias("citations"),
        F.lit(None).cast("boolean").alias("ok"), F.lit(None).cast("string").alias("error_code"), F.lit(None).cast("string").alias("error_message"), "action"
    )
    return output.unionByName(refused)


def n_citations(answers: DataFrame) -> DataFrame:
    """G6"""
    return answers.withColumn("n_citations", F.size("citations"))


def answer_extractive(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """The sentence of the hits sharing most terms with the question.

    Ties go to the better rank, then to the earlier sentence.
    """
    found = (
        hits.join(questions.select("query_id", "question"), "query_id")
        .select("query_id", "question", "rank", "chunk_id", F.posexplode(sentences("text")).alias("pos", "answer"))
        .withColumn("score", F.round(overlap(F.col("question"), F.col("answer")), 6))
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "rank", "pos")
    return found.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") == 1).drop("_n", "question")
