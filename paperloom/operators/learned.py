"""Filters learned from labelled texts (K1), topics calibrated on ordinary ones (K2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.policy import (
    LearnedFilter,
    Policy,
    TopicModel,
    learned_score,
    plain_terms,
    sentence_sets,
    sentence_terms,
    weighted_scores,
)
from paperloom.functions.text import terms
from paperloom.operators.embedding import idf_value

# Terms a filter holds at most: what is collected, and the size of its Column.
MAX_TERMS = 1_000
# Labelled texts of the category a term must be in.
MIN_TEXTS = 3
# Weights are thousandths of natural logarithms, so that sums are exact.
SCALE = 1_000
# A term is kept if it is this much likelier in the category (about 7 times).
MIN_WEIGHT = 2_000
# Share of ordinary sentences that may reach a topic, and the least threshold.
FALSE_ALARMS = 0.001
MIN_TOPIC_SCORE = 0.5
# Precision each strength asks of its threshold.
PRECISION = (("HIGH", 0.8), ("MEDIUM", 0.9), ("LOW", 0.97))


def term_weights(labelled: DataFrame, text: str = "text", label: str = "label", max_terms: int = MAX_TERMS) -> list[tuple[str, int]]:
    """The strongest terms of a category: ``(term, weight)``, strongest first.

    The weight is the logarithm of how much likelier a text of the category
    (``label`` 1) holds the term than another (0), with one text added to each
    side. All labelled rows count; counts are combined before the shuffle, and
    only the ``max_terms`` largest come to the driver (ties: in more texts of
    the category, then in order of the term). Rows with a null label are no
    evidence, null texts hold no terms.
    """
    known = labelled.filter(F.col(label).isNotNull()).select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"))
    n, n_in = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    ratio = ((F.col("n_in") + 1) / F.lit(n_in + 2.0)) / ((F.col("n") - F.col("n_in") + 1) / F.lit(n - n_in + 2.0))
    strongest = (
        known.select("label", F.explode(F.array_distinct(terms("text"))).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("n"), F.sum("label").alias("n_in"))
        .filter(F.col("n_in") >= MIN_TEXTS)
        .select("term", "n_in", F.round(F.log(ratio) * SCALE).cast("int").alias("weight"))
        .filter(F.col("weight") >= MIN_WEIGHT)
        .orderBy(F.desc("weight"), F.desc("n_in"), "term")
        .limit(max_terms)
    )
    return [(r["term"], r["weight"]) for r in strongest.collect()]


def thresholds(scored: DataFrame, score: str = "score", label: str = "label", precision=PRECISION) -> tuple[tuple[str, int | None], ...]:
    """For each strength the lowest score from which its precision holds, or None.

    Precision is counted over all rows at or above a score, ties together; a
    score of 0 never blocks. Rows are counted by score first: scores are sums
    of a few weights, so their number has a bound whatever the rows.
    """
    counts = (
        scored.filter((F.col(score) > 0) & F.col(label).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(F.count("*").alias("n"), F.sum(F.col(label).cast("int")).alias("n_in"))
        .orderBy(F.desc("score"))
        .collect()
    )
    lowest: dict[str, int | None] = {name: None for name, _ in precision}
    n = n_in = 0
    for row in counts:
        n, n_in = n + row["n"], n_in + row["n_in"]
        for name, wanted in precision:
            if n_in / n >= wanted:
                lowest[name] = row["score"]
    return tuple(lowest.items())


def fit_filter(
    fitting: DataFrame, calibration: DataFrame, text: str = "text", label: str = "label", top: int = 3, max_terms: int = MAX_TERMS
) -> LearnedFilter:
    """K1: weights from one set of labelled texts, thresholds from another.

    The two should share no text, or the thresholds promise more than holds.
    Empty sets give a filter that never blocks.
    """
    plain = LearnedFilter(tuple(term_weights(fitting, text, label, max_terms)), (), top)
    scored = calibration.select(learned_score(terms(text), plain).alias("score"), F.col(label).alias("label"))
    return LearnedFilter(plain.weights, thresholds(scored), top)


def score_strengths(df: DataFrame, model: LearnedFilter, text: str = "text") -> DataFrame:
    """Add ``score`` and the array ``blocks`` of the strengths that block a text; a projection."""
    names = [(name, at) for name, at in model.thresholds if at is not None]
    scored = df.withColumn("score", F.coalesce(learned_score(terms(text), model), F.lit(0)))
    marks = [F.when(F.col("score") >= at, F.lit(name)) for name, at in names]
    return scored.withColumn("blocks", F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>"))


def fit_topics(ordinary: DataFrame, policy: Policy, text: str = "text", false_alarms: float = FALSE_ALARMS) -> TopicModel:
    """K2: weights of the examples' terms and a threshold for each topic, from ordinary texts.

    A term weighs its idf over all sentences, a term of no example as one that
    never occurs. A topic's threshold is the lowest hundredth, from
    ``MIN_TOPIC_SCORE`` on, that at most a share ``false_alarms`` of the
    sentences reaches; without sentences it is the least one. Counts are
    combined before the shuffle; to the driver come one row for each term of
    the examples and one for each topic and hundredth, whatever the texts.
    """
    vocabulary = sorted({t for _, _, examples in policy.topics for e in examples for t in plain_terms(e)})
    if not vocabulary:
        return TopicModel((), 0)
    sets = ordinary.select(F.explode(sentence_sets(sentence_terms(F.col(text)))).alias("s"))
    known = sets.select(F.explode(F.concat(F.array(F.lit("")), F.filter("s", lambda t: t.isin(*vocabulary)))).alias("term"))
    df = {r["term"]: r["df"] for r in known.groupBy("term").agg(F.count("*").alias("df")).collect()}
    n = df.pop("", 0)  # the empty term stands for the sentence itself
    square = lambda d: F.round(idf_value(n, F.lit(d).cast("double")) ** 2 * SCALE).cast("bigint")
    values = ordinary.sparkSession.range(1).select(square(0).alias("0"), *[square(df.get(t, 0)).alias(f"t{i}") for i, t in enumerate(vocabulary)]).first()
    model = TopicModel(tuple((t, max(1, values[f"t{i}"])) for i, t in enumerate(vocabulary)), max(1, values["0"]))

    scores = sets.select(F.posexplode(weighted_scores(F.col("s"), policy.topics, model)).alias("topic", "score"))
    counts = (
        scores.filter(F.col("score") >= MIN_TOPIC_SCORE)
        .groupBy("topic", F.floor(F.col("score") * 100).cast("int").alias("level"))
        .agg(F.count("*").alias("n"))
        .collect()
    )
    thresholds = []
    for i, (name, _, _) in enumerate(policy.topics):
        level, above = 101, 0
        at = {r["level"]: r["n"] for r in counts if r["topic"] == i}
        while level - 1 >= round(MIN_TOPIC_SCORE * 100) and above + at.get(level - 1, 0) <= false_alarms * n:
            level -= 1
            above += at.get(level, 0)
        thresholds.append((name, level / 100))
    return TopicModel(model.squares, model.unknown, tuple(thresholds))
