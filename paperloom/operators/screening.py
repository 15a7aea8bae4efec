"""Screening tables of texts against a policy."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.policy import (
    Policy,
    _let,
    blocked_categories,
    blocked_message,
    blocking_types,
    denied_topics,
    mask_mentions,
    mask_pii,
    masked_count,
    may_be_near,
    near_topic,
    piece_places,
    pii_spans,
    sentence_pieces,
    sentence_terms,
    word_spans,
)
from paperloom.functions.text import terms
from paperloom.operators.invoke import invoke
from paperloom.staging import once, stage


TRACE_FIELDS = (("policy", "string"), ("type", "string"), ("action", "string"), ("start", "int"), ("end", "int"))


def _labels(kind: str, names: Column) -> Column:
    return F.transform(names, lambda n: F.concat(F.lit(f"{kind}:"), n))


def apply_policy(df: DataFrame, policy: Policy | None = None, side: str = "input", text: str = "text") -> DataFrame:
    """K6: add ``action`` (none, masked, blocked) and ``reasons``; replace ``text``.

    Filters, topics and blocking data decide first; only what passes is masked.
    """
    policy = policy or Policy()
    mask = mask_mentions if policy.mentions else mask_pii
    parts = once(df, _masked=mask(F.col(text), policy), _sents=sentence_terms(F.col(text)))
    marks = [F.when(masked_count(F.col("_masked"), F.col(text), k) > 0, F.lit(f"pii:{k}")) for k in policy.of_type("ANONYMIZE")]
    found = once(
        parts,
        _why=F.concat(
            _labels("filter", blocked_categories(F.flatten("_sents"), policy, side)),
            _labels("topic", denied_topics(F.col("_sents"), policy)),
            _labels("pii", blocking_types(F.col(text), policy)),
        ),
        _marks=F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>"),
    )
    blocked, masked = F.size("_why") > 0, F.size("_marks") > 0
    kept = [c for c in df.columns if c != text]
    return found.select(
        *kept,
        F.when(blocked, blocked_message(side, policy)).otherwise(F.col("_masked")).alias(text),
        F.when(blocked, "blocked").when(masked, "masked").otherwise("none").alias("action"),
        F.when(blocked, F.col("_why")).otherwise(F.col("_marks")).alias("reasons"),
    )


def policy_findings(df: DataFrame, policy: Policy | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """K8: one row ``(key, type, action, n)`` per personal data type found."""
    policy = policy or Policy()
    rows = []
    for kind, action in policy.pii:
        if action == "BLOCK":
            n = F.regexp_count(F.col(text), F.lit(policy.found_by(kind))).cast("int")
        else:
            n = masked_count(F.col("_masked"), F.col(text), kind)
        rows.append(F.struct(F.lit(kind).alias("type"), F.lit(action).alias("action"), n.alias("n")))
    return (
        once(df.select(key, text), _masked=mask_pii(F.col(text), policy))
        .select(key, F.explode(F.array(*rows)).alias("_f"))
        .select(key, "_f.*")
        .filter(F.col("n") > 0)
    )


def policy_trace(
    df: DataFrame, policy: Policy | None = None, side: str = "input", key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """K8: every finding with its place: ``(key, policy, type, action, start, end)``.

    ``policy`` is filter, topic or pii; places are code points of the original
    text, ``end`` exclusive. Filters give their words, with action BLOCK where
    the category blocks on this side and NONE where it was too weak to; topics
    give the sentences that reach the threshold, personal data what would be
    masked or blocks. Patterns of personal data are searched in the original
    text each for itself, so places of two types may overlap. Row-local: no
    shuffle, and the same on a stream. Null and empty texts have no findings,
    and repeated rows each have theirs.
    """
    policy = policy or Policy()
    body = F.col(text)
    listed = []
    for category, *_ in policy.filters:
        model = policy.learned.get(category)
        listed.append((category, tuple(w for w, _ in model.weights) if model is not None else tuple(policy.lexicon[category])))
    every = sorted({w.lower() for _, words in listed for w in words})

    def read(pieces: Column, sents: Column) -> Column:
        hits = F.filter(F.flatten(sents), lambda t: t.isin(*every)) if every else F.array().cast("array<string>")
        close = may_be_near(sents, policy) if policy.topics else F.array().cast("array<int>")
        # terms of the few sentences that may be near a topic, and where these stand
        def zipped(numbers: Column) -> Column:
            return F.zip_with(numbers, piece_places(pieces, numbers), lambda i, p: F.struct(F.array_distinct(F.get(sents, i)).alias("own"), p.alias("place")))

        return F.struct(hits.alias("hits"), _let(close, zipped).alias("close"))

    seen = once(df.select(key, text), _read=_let(sentence_pieces(body), lambda pieces: _let(F.transform(pieces, terms), lambda sents: read(pieces, sents))))
    judged = once(seen, _hits=F.col("_read.hits"), _blocked=blocked_categories(F.col("_read.hits"), policy, side))
    found = []

    def add(kind: str, name: str, action: Column, places: Column) -> None:
        def row(s: Column) -> Column:
            return F.struct(
                F.lit(kind).alias("policy"), F.lit(name).alias("type"), action.alias("action"), s["start"].alias("start"), s["end"].alias("end")
            )

        found.append(F.coalesce(F.transform(places, row), F.array().cast("array<struct<policy:string,type:string,action:string,start:int,end:int>>")))

    def stands(words: tuple[str, ...]) -> Column:
        """Whether one of the words may stand in the text: plain ones are terms of it then."""
        if not all(w.isascii() and w.isalnum() for w in words):
            return F.lit(True)
        return F.exists("_hits", lambda t: t.isin(*[w.lower() for w in words]))

    for category, words in listed:
        if words:
            blocks = F.array_contains("_blocked", category)
            add("filter", category, F.when(blocks, "BLOCK").otherwise("NONE"), F.when(stands(words), word_spans(body, words)))

    def near(name: str) -> Callable[[Column], Column]:
        return lambda s: near_topic(s["own"], name, policy)

    for name, _, _ in policy.topics:
        add("topic", name, F.lit("BLOCK"), F.transform(F.filter("_read.close", near(name)), lambda s: s["place"]))
    for kind, action in policy.pii:
        add("pii", kind, F.lit(action), pii_spans(body, kind, policy))
    if not found:
        return df.select(key, *[F.lit(None).cast(t).alias(n) for n, t in TRACE_FIELDS]).limit(0)
    return judged.select(key, F.explode(F.flatten(F.array(*found))).alias("_f")).select(key, "_f.*")


def screening_report(screened: DataFrame) -> DataFrame:
    """Documents by action and reason; documents without reason count too."""
    return (
        screened.select("action", F.explode_outer("reasons").alias("reason"))
        .groupBy("action", F.coalesce("reason", F.lit("-")).alias("reason"))
        .agg(F.count("*").alias("n_docs"))
    )


def cross_policies(df: DataFrame, policies: list[tuple[str, str]], stages: tuple[str, ...] = ("input",)) -> DataFrame:
    """Every document meets every (policy id, version), inside its own row."""
    each = [
        F.struct(F.lit(i).alias("policy_id"), F.lit(v).alias("policy_version"), F.lit(s).alias("side"))
        for i, v in policies
        for s in stages
    ]
    return df.withColumn("_p", F.explode(F.array(*each))).select(*df.columns, "_p.*")


def guarded_invoke(
    df: DataFrame,
    make_client: Callable,
    build_payload: Callable[[Column], Column],
    answer_of: Callable[[Column], Column],
    policy: Policy | None = None,
    text: str = "text",
) -> DataFrame:
    """K7: screen the input, call the model on what passed, screen the output.

    Adds ``answer``, ``action``, ``reasons`` and the outcome of the call: ``ok``,
    ``error_code`` and ``error_message``, null where nothing was sent. The model
    sees the masked text.
    """
    screened = apply_policy(df, policy, "input", text)
    blocked = F.col("action") == "blocked"
    requests = screened.withColumn("payload", F.when(~blocked, build_payload(F.col(text))))
    called = stage(invoke(requests, make_client, on_error="column"), "guarded")
    # the verdict on the answer stands unless the question was blocked before
    first = called.select(
        *[c for c in screened.columns if c not in ("action", "reasons")],
        F.when(blocked, F.struct(text, "action", "reasons")).alias("_refused"),
        answer_of(F.col("response")).alias("answer"),
        *[F.when(~blocked, F.col(c)).alias(c) for c in ("ok", "error_code", "error_message")],
    )
    second = apply_policy(first, policy, "output", "answer")
    refused = F.col("_refused")
    return second.withColumns(
        {
            "answer": F.when(refused.isNotNull(), refused[text]).otherwise(F.col("answer")),
            "action": F.coalesce(refused["action"], F.col("action")),
            "reasons": F.coalesce(refused["reasons"], F.col("reasons")),
        }
    ).drop("_refused")
