import math
import random
import re
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from paperloom.functions import policy as rules
from paperloom.functions.payloads import payload_completion
from paperloom.functions.responses import completion_text
from paperloom.functions.text import terms
from paperloom.operators import learned, screening

FORM = """Claimant Name: Ana Ruiz
Address: 12 Old Mill Road, Dayton
Phone: (555) 123-4567, +1 614-555-0117
Email: ana.ruiz+x@mail.example.org
VIN: 1HGCM82633A123456 1HGCM82633A123457
License Plate: ABC-1234
"""


def _masked(value, text, policy=None):
    return value(rules.mask_pii(F.col("t"), policy), "t string", text)


def test_mask_every_type(value):
    assert _masked(value, FORM) == (
        "Claimant Name: {NAME}\nAddress: {ADDRESS}, Dayton\nPhone: {PHONE}, {PHONE}\nEmail: {EMAIL}\n"
        "VIN: {VEHICLE_IDENTIFICATION_NUMBER} {VEHICLE_IDENTIFICATION_NUMBER}\nLicense Plate: {LICENSE_PLATE}\n"
    )


def test_masking_is_a_fixed_point_and_leaves_no_match(value):
    once = _masked(value, FORM * 3)
    assert _masked(value, once) == once
    for kind, pattern, _ in rules.MASKS:
        assert not value(F.regexp_like(F.col("t"), F.lit(pattern)), "t string", once), kind


def test_signs_rule_out_no_match(value):
    """Whatever a pattern matches, its cheap test lets through."""
    for kind, pattern, _ in rules.MASKS:
        hit = value(F.regexp_extract(F.col("t"), pattern, 0), "t string", FORM + "SSN 123-45-6789\nDriver ID: X9\n")
        assert hit and value(rules.may_mask(F.col("t"), kind), "t string", hit), kind


def test_mask_only_wanted_types(value):
    only_email = replace(rules.Policy(), pii=(("EMAIL", "ANONYMIZE"),))
    assert _masked(value, FORM, only_email) == FORM.replace("ana.ruiz+x@mail.example.org", "{EMAIL}")


def test_phone_does_not_eat_ssn_and_ssn_blocks(value):
    assert _masked(value, "123-45-6789") == "123-45-6789"
    assert value(rules.block_pii(F.col("t")), "t string", "ssn 123-45-6789") == rules.BLOCKED_OUTPUT
    assert value(rules.block_pii(F.col("t"), side="input"), "t string", "Driver License ID: K1") == rules.BLOCKED_INPUT
    assert value(rules.block_pii(F.col("t")), "t string", "a driver") == "a driver"


@pytest.mark.parametrize(
    "text, side, found",
    [
        ("You IDIOT!", "input", ["HATE"]),
        ("please jailbreak it", "input", ["PROMPT_ATTACK"]),
        ("please jailbreak it", "output", []),
        ("idiotic", "input", []),
        ("murder, trash", "output", ["HATE", "VIOLENCE"]),
    ],
)
def test_content_filter(value, text, side, found):
    assert value(rules.blocked_categories(terms("t"), rules.Policy(), side), "t string", text) == found


def test_strengths_need_more_hits(value):
    for strength, needed in (("HIGH", 1), ("MEDIUM", 2), ("LOW", 3), ("NONE", None)):
        policy = replace(rules.Policy(), filters=(("HATE", strength, "NONE"),))
        for n in range(1, 4):
            got = value(rules.blocked_categories(terms("t"), policy, "input"), "t string", "trash " * n)
            assert bool(got) == (needed is not None and n >= needed)


@pytest.mark.parametrize(
    "text, topics",
    [
        ("Hello. Is this policy contract enforceable?", ["LegalAdvice"]),
        ("Who is the president of Spain?", ["Politics"]),
        ("What does comprehensive coverage include?", []),
        # close to an example of another topic as well: shared terms are a weak sign
        ("What legal action should I take?", ["LegalAdvice", "MedicalAdvice"]),
        ("", []),
    ],
)
def test_denied_topics(value, text, topics):
    assert value(rules.denied_topics(rules.sentence_terms(F.col("t")), rules.Policy()), "t string", text) == topics


def test_prefilter_of_topics_changes_nothing(spark):
    """denied_topics drops far sentences early; the plain score must agree."""
    words = "what legal action should i take is this symptom serious who the president of france policy x y".split()
    texts = [(i, " ".join(words[(i * 7 + j * j) % len(words)] for j in range(1 + i % 9)) + ". ok") for i in range(400)]
    policy = rules.Policy()
    sents = rules.sentence_terms(F.col("t"))
    plain = F.array_compact(
        F.array(*[F.when(rules.topic_score(rules.sentence_sets(sents), ex) >= 0.6, F.lit(n)) for n, _, ex in policy.topics])
    )
    rows = spark.createDataFrame(texts, "i long, t string").select(rules.denied_topics(sents, policy).alias("a"), plain.alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows) and any(r["a"] for r in rows)


def test_apply_policy_precedence(spark):
    rows = [(1, "mail a@b.org"), (2, "mail a@b.org, ssn 123-45-6789"), (3, "you moron a@b.org"), (4, "fine"), (5, "{EMAIL} seen")]
    got = {r["i"]: r for r in screening.apply_policy(spark.createDataFrame(rows, "i long, text string")).collect()}
    assert (got[1]["action"], got[1]["reasons"], got[1]["text"]) == ("masked", ["pii:EMAIL"], "mail {EMAIL}")
    assert (got[2]["action"], got[2]["reasons"]) == ("blocked", ["pii:US_SOCIAL_SECURITY_NUMBER"])
    assert (got[3]["action"], got[3]["reasons"], got[3]["text"]) == ("blocked", ["filter:HATE"], rules.BLOCKED_INPUT)
    assert (got[4]["action"], got[4]["reasons"], got[4]["text"]) == ("none", [], "fine")
    assert got[5]["action"] == "none"


def test_filter_on_action_keeps_the_plan_small(spark):
    screened = screening.apply_policy(spark.createDataFrame([("x",)], "text string")).filter("action <> 'blocked'")
    plan = screened._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("{EMAIL}, 1") == 1  # the replacement itself appears once


def test_findings(spark):
    docs = spark.createDataFrame([(1, FORM), (2, "1 ssn: 123-45-6789"), (3, "none")], "doc_id long, text string")
    got = {(r["doc_id"], r["type"]): (r["action"], r["n"]) for r in screening.policy_findings(docs).collect()}
    assert got[(1, "PHONE")] == ("ANONYMIZE", 2) and got[(1, "VEHICLE_IDENTIFICATION_NUMBER")] == ("ANONYMIZE", 2)
    assert got[(2, "US_SOCIAL_SECURITY_NUMBER")] == ("BLOCK", 1) and len(got) == 7


def test_policy_from_tables(spark):
    filters = spark.createDataFrame([("HATE", "LOW", "NONE")], "category string, input_strength string, output_strength string")
    topics = spark.createDataFrame([("T", "d", ["one two three"])], "name string, definition string, examples array<string>")
    pii = spark.createDataFrame([("EMAIL", "BLOCK")], "type string, action string")
    made = rules.policy_from_tables(filters, topics, pii)
    assert made.filters == (("HATE", "LOW", "NONE"),) and made.topics == (("T", "d", ("one two three",)),)
    assert made.of_type("BLOCK") == ["EMAIL"]


def make_leaky():
    def client(model_id, payload, policy):
        text = payload["prompt"]
        assert "moron" not in text, "a blocked text reached the model"
        return {"completion": "call 555-123-4567" if "phone" in text else "ok " + ("123-45-6789" if "leak" in text else "")}

    return client


def test_guarded_invoke(spark):
    rows = spark.createDataFrame([(1, "you moron"), (2, "phone?"), (3, "leak"), (4, "hi")], "i long, text string")
    done = screening.guarded_invoke(rows, make_leaky, lambda p: payload_completion(p), completion_text)
    got = {r["i"]: (r["action"], r["answer"]) for r in done.collect()}
    assert got == {
        1: ("blocked", rules.BLOCKED_INPUT),
        2: ("masked", "call {PHONE}"),
        3: ("blocked", rules.BLOCKED_OUTPUT),
        4: ("none", "ok "),
    }


def test_side_is_checked():
    with pytest.raises(ValueError):
        rules.blocked_message("both")


def test_either_action_for_every_type(value):
    swapped = tuple((t, "BLOCK" if a == "ANONYMIZE" else "ANONYMIZE") for t, a in rules.PII_ACTIONS)
    policy = replace(rules.Policy(), pii=swapped)
    assert value(rules.blocking_types(F.col("t"), policy), "t string", FORM) == [t for t, a in swapped if a == "BLOCK"]
    text = "SSN 123-45-6789, Driver License ID: X99 8"
    assert _masked(value, text, policy) == "SSN {US_SOCIAL_SECURITY_NUMBER}, Driver License ID: {DRIVER_ID}"
    own = replace(rules.Policy().with_blocks({"BADGE": "B[0-9]{4}"}), pii=(("BADGE", "ANONYMIZE"),))
    assert _masked(value, "B1234 B12", own) == "{BADGE} B12"


@pytest.mark.parametrize(
    "change",
    [
        {"pii": (("EMAIL", "block"),)},
        {"pii": (("SHOE_SIZE", "BLOCK"),)},
        {"pii": (("SHOE_SIZE", "ANONYMIZE"),)},
        {"filters": (("HATE", "high", "HIGH"),)},
        {"filters": (("RUDENESS", "HIGH", "HIGH"),)},
        {"topics": (("Weather", "rain", ()),)},
    ],
)
def test_unknown_values_are_refused(change):
    with pytest.raises(ValueError):
        replace(rules.Policy(), **change)


def test_guarded_calls_keep_the_outcome(spark):
    from paperloom.functions.payloads import payload_messages
    from paperloom.functions.responses import first_text
    from paperloom.operators.invoke import ServiceError

    def make_throttled():
        def client(model_id, payload, policy):
            raise ServiceError("ThrottlingException", "later")

        return client

    rows = spark.createDataFrame([(1, "hello"), (2, "you moron")], "i long, text string")
    got = {r["i"]: r for r in screening.guarded_invoke(rows, make_throttled, payload_messages, first_text).collect()}
    assert (got[1]["ok"], got[1]["error_code"], got[1]["answer"]) == (False, "ThrottlingException", None)
    assert (got[2]["ok"], got[2]["action"]) == (None, "blocked")


def _mentions(value, text, policy=None):
    return value(rules.mask_mentions(F.col("t"), policy), "t string", text)


@pytest.mark.parametrize(
    "text, masked",
    [
        ("Claimant Name: Ana Ruiz\nAna Ruiz, ana ruiz, Ana Ruizo.", "Claimant Name: {NAME}\n{NAME}, ana ruiz, Ana Ruizo."),
        # the longer value first, closing marks outside
        ("Name: Ana\nFull Name: Ana Ruiz.\nAna Ruiz and Ana", "Name: {NAME}\nFull Name: {NAME}.\n{NAME} and {NAME}"),
        ("Address: 1 Elm Road, Dayton\nat 1 Elm Road, Dayton now", "Address: {ADDRESS}\nat {ADDRESS} now"),
        ("Email Address: a@b.org\nto a@b.org", "Email Address: {EMAIL}\nto {EMAIL}"),
        # signs of patterns are plain characters, short values stay where they are labelled
        ("Name: A.*\\E(b\nA.*\\E(b A.xyE(b", "Name: {NAME}\n{NAME} A.xyE(b"),
        ("Name: Al\nAl said", "Name: {NAME}\nAl said"),
        ("nobody is named, a@b.org", "nobody is named, {EMAIL}"),
        ("", ""),
        (None, None),
    ],
)
def test_mask_mentions(value, text, masked):
    assert _mentions(value, text) == masked


def test_mentions_follow_the_policy(value, spark):
    text = "Name: Ana Ruiz\nAna Ruiz at a@b.org"
    only_email = replace(rules.Policy(), pii=(("EMAIL", "ANONYMIZE"),))
    assert _mentions(value, text, only_email) == "Name: Ana Ruiz\nAna Ruiz at {EMAIL}"
    rows = spark.createDataFrame([(1, text)], "i long, text string")
    assert screening.apply_policy(rows, replace(rules.Policy(), mentions=True)).first()["text"] == "Name: {NAME}\n{NAME} at {EMAIL}"


def test_spans_match_a_plain_search(spark):
    """Places and hits as Python finds them, over more matches than a block holds."""
    texts = ["", "x", "ab", "abab" * 300, "é😀ab" * 5 + "b", "a" * 700 + "ab" * 600]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for pattern in ("ab", "a+b?", "[^a]"):
        for r in rows.select("t", rules.spans(F.col("t"), pattern).alias("s")).collect():
            assert [tuple(x) for x in r["s"]] == [(*m.span(), m.group()) for m in re.finditer(pattern, r["t"])]
    assert spark.createDataFrame([(None,)], "t string").select(rules.spans(F.col("t"), "a")).first()[0] is None


def test_policy_trace(spark):
    text = FORM + "You IDIOT 😀 trashy. jailbreak!  Who is the president of Spain? ssn 123-45-6789"
    docs = spark.createDataFrame([(1, text, "x"), (2, None, "x"), (3, "", "x"), (4, "fine", "x")], "doc_id long, text string, start string")
    rows = screening.policy_trace(docs, side="output").collect()
    assert {r["doc_id"] for r in rows} == {1}
    got = sorted((r["policy"], r["type"], r["action"], text[r["start"] : r["end"]]) for r in rows)
    assert got == sorted(
        [
            ("filter", "HATE", "BLOCK", "IDIOT"),
            ("filter", "PROMPT_ATTACK", "NONE", "jailbreak"),
            ("topic", "Politics", "BLOCK", "Who is the president of Spain?"),
            ("pii", "NAME", "ANONYMIZE", "Ana Ruiz"),
            ("pii", "ADDRESS", "ANONYMIZE", "12 Old Mill Road"),
            ("pii", "PHONE", "ANONYMIZE", "(555) 123-4567"),
            ("pii", "PHONE", "ANONYMIZE", "+1 614-555-0117"),
            ("pii", "EMAIL", "ANONYMIZE", "ana.ruiz+x@mail.example.org"),
            ("pii", "VEHICLE_IDENTIFICATION_NUMBER", "ANONYMIZE", "1HGCM82633A123456"),
            ("pii", "VEHICLE_IDENTIFICATION_NUMBER", "ANONYMIZE", "1HGCM82633A123457"),
            ("pii", "LICENSE_PLATE", "ANONYMIZE", "ABC-1234"),
            ("pii", "US_SOCIAL_SECURITY_NUMBER", "BLOCK", "123-45-6789"),
        ]
    )


def test_trace_agrees_with_the_verdict(spark):
    """A text is blocked if, and only if, a finding says so."""
    texts = ["you moron", "fine", "ssn 123-45-6789", "a@b.org", "Who is the president of Spain?", FORM, "jailbreak"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for side in ("input", "output"):
        blocked = {r["doc_id"] for r in screening.apply_policy(docs, side=side).collect() if r["action"] == "blocked"}
        assert blocked == {r["doc_id"] for r in screening.policy_trace(docs, side=side).collect() if r["action"] == "BLOCK"}


def test_trace_shuffles_nothing(spark):
    plan = screening.policy_trace(spark.range(9).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


LABELLED = [(f"zork word{i} common", 1) for i in range(8)] + [(f"plain word{i} common", 0) for i in range(40)]


def test_learned_filter(spark, value):
    rows = spark.createDataFrame([*LABELLED, ("zork", None), (None, 0)], "text string, label int")
    model = learned.fit_filter(rows, rows)
    assert [t for t, _ in model.weights] == ["zork"]  # "common" is everywhere, each "word" in too few texts
    # 8 of 8 against 0 of 41, one text added to each side
    assert model.weights[0][1] == round(1000 * math.log((9 / 10) / (1 / 43)))
    assert model.thresholds == tuple((s, model.weights[0][1]) for s in ("HIGH", "MEDIUM", "LOW"))
    policy = replace(rules.Policy(), learned={"HATE": model})
    assert value(rules.blocked_categories(terms("t"), policy, "input"), "t string", "ZORK, murder") == ["HATE", "VIOLENCE"]
    assert value(rules.blocked_categories(terms("t"), policy, "input"), "t string", "idiot") == []
    docs = spark.createDataFrame([(1, "a Zork")], "doc_id long, text string")
    assert [tuple(r) for r in screening.policy_trace(docs, policy).collect()] == [(1, "filter", "HATE", "BLOCK", 2, 6)]


def test_learned_score_takes_the_largest(value):
    model = rules.LearnedFilter((("a", 5), ("b", 4), ("c", 3), ("d", 2)), (("HIGH", 9),), top=2)
    assert value(rules.learned_score(terms("t"), model), "t string", "d a a b c") == 9
    assert value(rules.learned_score(terms("t"), model), "t string", "x") == 0


def test_thresholds_count_ties_together(spark):
    scored = spark.createDataFrame([(9, 1), (9, 1), (9, 0), (5, 1), (5, 1), (2, 0), (0, 1), (7, None)], "score int, label int")
    assert learned.thresholds(scored, precision=(("HIGH", 0.8), ("MEDIUM", 0.66), ("LOW", 0.97))) == (("HIGH", 5), ("MEDIUM", 2), ("LOW", None))


def test_learned_filter_without_evidence_blocks_nothing(spark):
    empty = spark.createDataFrame([], "text string, label int")
    model = learned.fit_filter(empty, empty)
    assert model.weights == () and all(at is None for _, at in model.thresholds)
    docs = spark.createDataFrame([(1, "idiot"), (2, None)], "doc_id long, text string")
    assert [(r["score"], r["blocks"]) for r in learned.score_strengths(docs, model).collect()] == [(0, []), (0, [])]
    policy = replace(rules.Policy(), learned={"HATE": model})
    assert {r["action"] for r in screening.apply_policy(docs.filter("doc_id = 1"), policy).collect()} == {"none"}
    assert screening.policy_trace(docs, policy).count() == 0


def _calibrated(spark, texts=("An ordinary claim about a car.", "What should be done is said here.", None, "")):
    policy = rules.Policy()
    ordinary = spark.createDataFrame([(t,) for t in texts], "text string")
    return replace(policy, topic_model=learned.fit_topics(ordinary, policy))


@pytest.mark.parametrize(
    "text, topics",
    [
        ("What legal action should I take?", ["LegalAdvice"]),
        ("Hm. What medication should I take?", ["MedicalAdvice"]),
        ("What legal action should I take? Who is the president of France?", ["LegalAdvice", "Politics"]),
        ("What should I say?", []),
        ("", []),
    ],
)
def test_calibrated_topics(spark, value, text, topics):
    assert value(rules.denied_topics(rules.sentence_terms(F.col("t")), _calibrated(spark)), "t string", text) == topics


def test_topic_thresholds_follow_ordinary_sentences(spark):
    policy = rules.Policy()
    common = ["Is this symptom serious today"] * 9 + ["nothing of the kind"] * 91
    rows = spark.createDataFrame([(". ".join(common) + ".",)], "text string")
    model = learned.fit_topics(rows, policy, false_alarms=0.05)
    cuts = dict(model.thresholds)
    assert cuts["MedicalAdvice"] > 0.5 == cuts["Politics"]
    assert dict(learned.fit_topics(rows, policy, false_alarms=0.2).thresholds)["MedicalAdvice"] == 0.5
    one = rules.sentence_sets(rules.sentence_terms(F.lit(common[0])))[0]
    score = spark.range(1).select(rules.weighted_scores(one, policy.topics, model)[1]).first()[0]
    assert cuts["MedicalAdvice"] == math.floor(score * 100 + 1) / 100


def test_calibrated_policy_and_trace_agree(spark):
    policy = _calibrated(spark)
    text = "Fine. What legal action should I take? Bye."
    docs = spark.createDataFrame([(1, text), (2, "What should I say?")], "doc_id long, text string")
    assert [r["reasons"] for r in screening.apply_policy(docs, policy).orderBy("doc_id").collect()] == [["topic:LegalAdvice"], []]
    rows = screening.policy_trace(docs, policy).collect()
    assert [(r["type"], text[r["start"] : r["end"]]) for r in rows] == [("LegalAdvice", "What legal action should I take?")]


def test_topics_without_ordinary_texts(spark):
    policy = rules.Policy()
    model = learned.fit_topics(spark.createDataFrame([], "text string"), policy)
    assert {n for _, n in model.squares} == {model.unknown} and set(dict(model.thresholds).values()) == {0.5}


def test_places_are_those_of_a_plain_search(spark):
    """E-mail and phone are looked for from fewer starts, and a text may hold the mark that cuts it."""
    rng = random.Random(5)
    texts = ["".join(rng.choices(["a", "b.c", "@", "_", "%", ".", "x1", "-", " ", "\x01", "614", "555-0123", "+1 ", "(", ")", "\n", "\U0001f600"], k=60)) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    listed = {t: p for t, p, _ in rules.MASKS}
    got = rows.select("i", *[rules.pii_spans(F.col("text"), k, rules.Policy()).alias(k) for k in ("EMAIL", "PHONE")]).collect()
    found = 0
    for r in got:
        for kind in ("EMAIL", "PHONE"):
            want = [(*m.span(), m.group()) for m in re.finditer(listed[kind], texts[r["i"]])]
            assert [tuple(s) for s in r[kind]] == want, (kind, texts[r["i"]])
            found += len(want)
    assert found > 50 and any("\x01" in t for t in texts)


def test_a_long_word_is_no_square_of_work(spark):
    """Looked for from every character of a run, an address costs the square of the run."""
    row = spark.createDataFrame([("a" * 40_000 + " @",)], "text string").repartition(1).cache()
    row.count()

    def seconds(column):
        started = time.perf_counter()
        assert row.select(column.alias("s")).first()["s"] == []
        return time.perf_counter() - started

    plain = {t: p for t, p, _ in rules.MASKS}["EMAIL"]
    seconds(rules.pii_spans(F.col("text"), "PHONE", rules.Policy()))
    assert seconds(rules.pii_spans(F.col("text"), "EMAIL", rules.Policy())) < seconds(rules.spans(F.col("text"), plain)) / 2


def test_trace_judges_close_sentences_only(spark):
    """Places of sentences between runs of marks and newlines; what shares too few terms with an example is not compared with it."""
    text = "..\n Is it?\n\n.\t Is this POLICY contract enforceable?!  \n\nWho is the president of France. 😀 Is this symptom serious" + "?\n" * 3_000
    docs = spark.createDataFrame([(1, text), (2, "\n.!?"), (3, "a b c. policy"), (4, None)], "doc_id long, text string")
    traced = screening.policy_trace(docs)
    got = sorted((r["doc_id"], r["type"], text[r["start"] : r["end"]]) for r in traced.collect())
    assert got == [
        (1, "LegalAdvice", "Is this POLICY contract enforceable?!"),
        (1, "MedicalAdvice", "😀 Is this symptom serious?"),
        (1, "Politics", "Who is the president of France."),
    ]
    close = docs.select("doc_id", rules.may_be_near(F.transform(rules.sentence_pieces("text"), terms), rules.Policy()).alias("n"))
    assert {r["doc_id"]: r["n"] for r in close.collect()} == {1: [1, 3, 4], 2: [], 3: [], 4: None}


def test_email_places_behind_what_cannot_match(spark):
    texts = ["a b.c@d.org,x@y.de @ z@q.com", "x@y.de", "é \U0001f600 \x01 a@b.org", "a@ b@c.org", "@ @", "nothing"]
    docs = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    for r in docs.select("t", rules.pii_spans(F.col("t"), "EMAIL", rules.Policy()).alias("s")).collect():
        wanted = re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r["t"])
        assert [tuple(x) for x in r["s"]] == [(*m.span(), m.group()) for m in wanted]
