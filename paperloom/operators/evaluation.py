"""Evaluation and model comparison."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.fields import WRITTEN_DATE, written_date
from paperloom.functions.payloads import payload_messages, with_policy
from paperloom.functions.prompts import ACCURACY_SYSTEM, QUALITY_SYSTEM, accuracy_prompt, quality_prompt
from paperloom.functions.responses import first_text, parse_accuracy, parse_quality
from paperloom.functions.text import sentences, tokens
from paperloom.operators.invoke import invoke
from paperloom.staging import stage

# A fact is a word holding a digit, without end punctuation: numbers, ISO
# dates, ids. Currency signs and thousands separators are dropped before.
FACT_PATTERN = r"(?<![A-Za-z0-9#])(?=[A-Za-z./#-]*+[0-9])(?:[A-Za-z0-9#][A-Za-z0-9./#-]*[A-Za-z0-9]|[0-9])"
DROPPED = "$,"
PERCENTILE_ACCURACY = 100_000
JUDGE_TEMPERATURE = 0.5
JUDGE_TOKENS = 512


def cross_models(docs: DataFrame, models: list[str]) -> DataFrame:
    """Every document for every model, in list order, inside its own row."""
    each = [F.struct(F.lit(i).alias("ordinal"), F.lit(m).alias("model_id")) for i, m in enumerate(models)]
    return docs.withColumn("_m", F.explode(F.array(*each))).select(*docs.columns, "_m.*")


def join_summary(claims: DataFrame, summaries: DataFrame, key: str = "doc_id") -> DataFrame:
    """Claims with their summary."""
    return claims.join(summaries, key)


def model_metrics(runs: DataFrame, body: str = "response", seconds: str = "seconds", text: Callable[[Column], Column] = first_text) -> DataFrame:
    """G1: per run the rounded seconds, content blocks, characters and sample.

    ``text`` reads the answer out of the body. A run that failed has no blocks
    and characters, and keeps its error where ``runs`` has one.
    """
    said = F.coalesce(text(F.col(body)), F.lit(""))
    return runs.select(
        *[c for c in ("doc_id", "ordinal", "model_id", "ok", "error_code", "error_message") if c in runs.columns],
        F.round(seconds, 6).alias("time_seconds"),
        F.coalesce(F.json_array_length(F.get_json_object(body, "$.content")), F.lit(0)).alias("n_blocks"),
        F.length(said).alias("n_chars"),
        said.alias("output_sample"),
    )


def output_sample(text: Column) -> Column:
    """The first 100 characters and an ellipsis."""
    return F.concat(F.substring(text, 1, 100), F.lit("..."))


def model_table(runs: DataFrame, model: str = "model_id", seconds: str = "time_seconds") -> DataFrame:
    """Run times per model, in input list order; failed runs are counted, not timed.

    Percentiles are those of all times up to one part in ``PERCENTILE_ACCURACY``
    of the ranks, so that no task holds all times of a model.
    """
    ok = F.coalesce(F.col("ok"), F.lit(True)) if "ok" in runs.columns else F.lit(True)
    timed = F.when(ok, F.col(seconds))

    def percentile(share: float) -> Column:
        return F.percentile_approx(timed, share, PERCENTILE_ACCURACY)

    return (
        runs.groupBy(model)
        .agg(
            F.min("ordinal").alias("ordinal"),
            F.count("*").alias("n_runs"),
            F.count_if(~ok).alias("n_failed"),
            F.round(F.avg(timed), 6).alias("avg_seconds"),
            F.min(timed).alias("min_seconds"),
            F.max(timed).alias("max_seconds"),
            percentile(0.5).alias("median_seconds"),
            percentile(0.95).alias("p95_seconds"),
        )
        .orderBy("ordinal", model)
    )


# Size parameter of the sketches of run times, and the rank error it is good
# for: 0.0035 with a confidence of 99 %, so this holds with room.
SKETCH_SIZE = 800
SKETCH_RANK_ERROR = 0.01


def time_sketches(runs: DataFrame, run: str, model: str = "model_id", seconds: str = "time_seconds") -> DataFrame:
    """G3 over runs: one row for each run and model, to be kept beside those of other runs.

    Has exact counts, sum, least and greatest time, and a mergeable quantile
    sketch of some kilobytes whatever the number of times. Failed runs (``ok``
    false) are counted, not timed; a group without a time has a null sketch.
    """
    ok = F.coalesce(F.col("ok"), F.lit(True)) if "ok" in runs.columns else F.lit(True)
    timed = F.when(ok, F.col(seconds).cast("double"))
    return runs.groupBy(run, model).agg(
        F.count("*").alias("n_runs"),
        F.count_if(~ok).alias("n_failed"),
        F.count(timed).alias("n_timed"),
        F.sum(timed).alias("sum_seconds"),
        F.min(timed).alias("min_seconds"),
        F.max(timed).alias("max_seconds"),
        F.when(F.count(timed) > 0, F.kll_sketch_agg_double(timed, SKETCH_SIZE)).alias("sketch"),
    )


def model_table_of(sketches: DataFrame, *by: str) -> DataFrame:
    """Run times by model (or the columns ``by``) from ``time_sketches`` of any number of runs.

    Counts, mean and bounds are exact; median and 95th percentile lie within
    ``SKETCH_RANK_ERROR`` of their rank. Reads the sketches, not the runs.
    """
    quantile = lambda share: F.round(F.kll_sketch_get_quantile_double("_all", F.lit(share)), 6)
    by = by or ("model_id",)
    merged = sketches.groupBy(*by).agg(
        F.sum("n_runs").alias("n_runs"),
        F.sum("n_failed").alias("n_failed"),
        F.round(F.sum("sum_seconds") / F.nullif(F.sum("n_timed"), F.lit(0)), 6).alias("avg_seconds"),
        F.min("min_seconds").alias("min_seconds"),
        F.max("max_seconds").alias("max_seconds"),
        F.when(F.count("sketch") > 0, F.kll_merge_agg_double("sketch")).alias("_all"),
    )
    known = F.col("_all").isNotNull()
    return merged.withColumns(
        {"median_seconds": F.when(known, quantile(0.5)), "p95_seconds": F.when(known, quantile(0.95))}
    ).drop("_all")


def last_per_model(runs: DataFrame, model: str, order_col: str, columns: list[str]) -> DataFrame:
    """Of several runs of one model the last stands."""
    return runs.groupBy(model).agg(F.max_by(F.struct(*columns), order_col).alias("_last")).select(model, "_last.*")


def ab_policy(evals: DataFrame, key: str = "doc_id", score: str = "accuracy") -> DataFrame:
    """The same judgement without and with policy, side by side."""
    sides = evals.groupBy(key).agg(
        F.max(F.when(~F.col("policy"), F.col(score))).alias("without_policy"),
        F.max(F.when(F.col("policy"), F.col(score))).alias("with_policy"),
    )
    return sides.withColumn("change", F.col("with_policy") - F.col("without_policy"))


# Digits of one digest make this many draws, of this many values each.
DRAWS, DRAW_VALUES = 8, 1 << 16


def _poisson_cuts() -> list[int]:
    """From which draw on a Poisson number of mean 1 is at least 1, 2, ..."""
    cuts, share, below = [], math.exp(-1), 0.0
    while not cuts or cuts[-1] < DRAW_VALUES:
        below += share
        share /= len(cuts) + 1
        cuts.append(round(below * DRAW_VALUES))
    return cuts[:-1]


def mean_interval(df: DataFrame, value: str, key: str, *by: str, replicates: int = 200, share: float = 0.95, seed: int = 0) -> DataFrame:
    """The mean of a measure with a bootstrap interval, by the keys ``by``.

    In each replicate a row counts as often as a Poisson number of mean 1 that
    a digest of seed, ``key`` and replicate gives; so all replicates come from
    one pass, sums are combined before the shuffle, rows of one key always
    count together, and a lost task draws the same again. ``replicates`` is a
    multiple of 8. Gives ``n``, ``mean``, ``low``, ``high`` (the middle
    ``share`` of the replicates' means) and ``share_not_above_zero`` of them.
    Null values do not count; a group without any is missing.
    """
    if replicates < DRAWS or replicates % DRAWS:
        raise ValueError(f"replicates is a multiple of {DRAWS}")
    digest = lambda b: F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("_key"), F.lit("")), b.cast("string")).cast("binary"))
    blocks = F.transform(F.sequence(F.lit(0), F.lit(replicates // DRAWS - 1)), lambda b: F.struct(b.alias("b"), digest(b).alias("md5")))
    rows = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_value"), F.col(key).cast("string").alias("_key"))
    hashed = rows.select(*by, "_value", F.explode(blocks).alias("_b"))

    def draw(j: Column) -> Column:
        digits = F.substr(F.col("_b.md5"), j * 4 + 1, F.lit(4))
        return F.struct((F.col("_b.b") * DRAWS + j).alias("r"), F.conv(digits, 16, 10).cast("int").alias("u"))

    drawn = hashed.select(*by, "_value", F.explode(F.transform(F.sequence(F.lit(0), F.lit(DRAWS - 1)), draw)).alias("_d"))
    times = sum(((F.col("_d.u") >= cut).cast("int") for cut in _poisson_cuts()), F.lit(0))
    means = (
        drawn.select(*by, "_value", F.col("_d.r").alias("_r"), times.alias("_times"))
        .groupBy(*by, "_r")
        .agg(
            F.count("*").alias("_n"),
            F.avg("_value").alias("_plain"),
            (F.sum(F.col("_value") * F.col("_times")) / F.nullif(F.sum("_times"), F.lit(0))).alias("_mean"),
        )
    )
    tail = (1 - share) / 2
    return means.groupBy(*by).agg(
        F.max("_n").alias("n"),
        F.max(F.round("_plain", 6)).alias("mean"),
        F.round(F.percentile("_mean", tail), 6).alias("low"),
        F.round(F.percentile("_mean", 1 - tail), 6).alias("high"),
        F.round(F.avg((F.round("_mean", 9) <= 0).cast("int")), 6).alias("share_not_above_zero"),
    )


def ab_interval(evals: DataFrame, key: str = "doc_id", score: str = "accuracy", **how) -> DataFrame:
    """The mean change a policy makes, with its interval; keys with one side only do not count."""
    return mean_interval(ab_policy(evals, key, score), "change", key, **how)


def eval_report(evals: DataFrame, measures: list[str], *keys: str) -> DataFrame:
    """Mean of every measure by the keys, with subtotals (keys null)."""
    return evals.rollup(*keys).agg(
        F.count("*").alias("n_docs"), *[F.round(F.avg(m), 6).alias(f"avg_{m}") for m in measures]
    )


def concat_ordered(df: DataFrame, key: str, order: str, text: str = "text", sep: str = "\n", block: int = 1_000) -> DataFrame:
    """The texts of a key joined in order.

    Blocks of ``block`` positions are joined first, then the blocks, so the
    rows of a hot key are spread and never sorted in one place.
    """
    blocks = (
        df.groupBy(key, F.floor(F.col(order) / block).alias("_block"))
        .agg(F.array_sort(F.collect_list(F.struct(order, text))).alias("_rows"))
        .select(key, "_block", F.array_join(F.col(f"_rows.{text}"), sep).alias("_piece"))
    )
    return (
        blocks.groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("_block", "_piece"))).alias("_pieces"))
        .select(key, F.array_join(F.col("_pieces._piece"), sep).alias(text))
    )


def _judge(df: DataFrame, system: str, prompt: Column, make_judge: Callable, judge_model: str, policy: tuple[str, str] | None) -> DataFrame:
    requests = df.withColumn("model_id", F.lit(judge_model)).withColumn(
        "payload", payload_messages(prompt, system, JUDGE_TEMPERATURE, JUDGE_TOKENS)
    )
    requests = with_policy(requests, *(policy or (None, None)))
    return stage(invoke(requests, make_judge, on_error="column"), "judged")


def judge_accuracy(
    df: DataFrame,
    make_judge: Callable,
    judge_model: str,
    policy: tuple[str, str] | None = None,
    claim: str = "text",
    summary: str = "summary_text",
) -> DataFrame:
    """M5: add ``accuracy`` and ``inaccuracies`` by a judge model."""
    judged = _judge(df, ACCURACY_SYSTEM, accuracy_prompt(F.col(claim), F.col(summary)), make_judge, judge_model, policy)
    verdict = judged.withColumn("_v", parse_accuracy(first_text(F.col("response"))))
    return verdict.select(
        *df.columns, F.col("_v.score").alias("accuracy"), F.col("_v.inaccuracies").alias("inaccuracies"), "ok", "error_code", "error_message"
    )


def judge_quality(
    df: DataFrame, make_judge: Callable, judge_model: str, policy: tuple[str, str] | None = None, summary: str = "summary_text"
) -> DataFrame:
    """M6: add the ``quality`` map by a judge model."""
    judged = _judge(df, QUALITY_SYSTEM, quality_prompt(F.col(summary)), make_judge, judge_model, policy)
    return judged.select(*df.columns, parse_quality(first_text(F.col("response"))).alias("quality"), "ok", "error_code", "error_message")


def facts(text: Column) -> Column:
    """The distinct facts of a text; a written-out date counts in ISO form too."""
    plain = F.translate(text, DROPPED, "")
    written = F.regexp_extract_all(plain, F.lit(WRITTEN_DATE), F.lit(0))
    dates = F.array_compact(F.transform(written, lambda d: written_date(d).cast("string")))
    return F.array_distinct(F.concat(F.regexp_extract_all(plain, F.lit(FACT_PATTERN), F.lit(0)), dates))


def grounding(df: DataFrame, claim: str = "text", summary: str = "summary") -> DataFrame:
    """M7: add ``score`` and ``inaccuracies``, the summary's facts the claim has not."""
    found = df.withColumns({"_said": facts(F.col(summary)), "_known": facts(F.col(claim))})
    found = found.withColumn("inaccuracies", F.array_except("_said", "_known"))
    share = F.when(F.size("_said") == 0, F.lit(1.0)).otherwise(1 - F.size("inaccuracies") / F.size("_said"))
    return found.withColumn("score", F.round(share, 6)).drop("_said", "_known")


def quality_scores(source: Column, summary: Column, n_found: Column, n_asked: int) -> Column:
    """M8: completeness, conciseness, clarity and their mean, each 1-5."""
    completeness = 1 + 4 * n_found / F.lit(n_asked)
    conciseness = 5 - 4 * F.least(F.lit(1.0), F.length(summary) / F.length(source))
    per_sentence = F.size(tokens(summary)) / F.greatest(F.lit(1), F.size(sentences(summary)))
    clarity = F.greatest(F.lit(1.0), F.least(F.lit(5.0), 5 - 4 * (per_sentence - 20) / 40))
    return F.struct(
        F.round(completeness, 6).alias("completeness"),
        F.round(conciseness, 6).alias("conciseness"),
        F.round(clarity, 6).alias("clarity"),
        F.round((completeness + conciseness + clarity) / 3, 6).alias("overall"),
    )
