"""Content policy (K)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from paperloom.checks.base import CLAIMS_SQL, check, claims, document_index, documents, questions, table
from paperloom.checks.search_checks import ANSWERS_SQL, HITS_SQL, SENTENCES_SQL, TERMS_SQL, _flat_answers
from paperloom.functions import policy as rules
from paperloom.functions.payloads import payload_messages, question_params
from paperloom.functions.prompts import render
from paperloom.functions.responses import first_text
from paperloom.functions.text import WHITESPACE, terms
from paperloom.operators import learned, screening
from paperloom.operators.answers import answer
from paperloom.operators.invoke import make_stub
from paperloom.operators.retrieval import retrieve_guarded
from paperloom.staging import once

# The documents hold no social security numbers; card numbers and access
# tokens stand in for data that blocks a text.
STAND_INS = {"CARD_NUMBER": r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}", "ACCESS_TOKEN": "token = .[0-9a-f]{40}"}


def _policy() -> rules.Policy:
    return rules.Policy().with_blocks(STAND_INS)


def _md5(c):
    return F.md5(F.col(c).cast("binary"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def mask_sql(text: str) -> str:
    for kind, pattern, replacement in rules.MASKS:
        to = replacement.replace("$1", "\\1").replace("$2", "\\2")
        for _ in range(2 if kind in rules.MASKED_TWICE else 1):
            text = f"regexp_replace({text}, {_quoted(pattern)}, {_quoted(to)}, 'g')"
    return text


def _hits_of(category: str) -> str:
    words = ", ".join(_quoted(w) for w in rules.LEXICON[category])
    return f"len(list_filter(terms, lambda t: t IN ({words})))"


def _filters_sql(side: str) -> str:
    active = [c for c, i, o in rules.FILTERS if (i if side == "input" else o) == "HIGH"]
    return "list_filter([" + ", ".join(f"CASE WHEN {_hits_of(c)} >= 1 THEN 'filter:{c}' END" for c in active) + "], lambda x: x IS NOT NULL)"


def _topic_score_sql(examples: tuple[str, ...]) -> str:
    scores = []
    for e in examples:
        known = f"list_distinct({TERMS_SQL.format(_quoted(e))})"
        scores.append(
            f"coalesce(list_max(list_transform(sets, lambda s: len(list_intersect(s, {known})) / sqrt((len(s) * len({known}))::DOUBLE))), 0)"
        )
    return "greatest(" + ", ".join(scores) + ")"


_TOPICS_SQL = (
    "list_filter([" + ", ".join(f"CASE WHEN {_topic_score_sql(ex)} >= 0.6 THEN 'topic:{n}' END" for n, _, ex in rules.TOPICS) + "], lambda x: x IS NOT NULL)"
)
_BLOCKS = {**rules.BLOCK_PATTERNS, **STAND_INS}
_BLOCKS_SQL = (
    "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(text, {_quoted(p)}) THEN 'pii:{k}' END" for k, p in _BLOCKS.items()) + "], lambda x: x IS NOT NULL)"
)


def _added(kind: str) -> str:
    def count(text: str) -> str:
        return f"(length({text}) - length(replace({text}, '{{{kind}}}', '')))"

    return f"(({count('masked')} - {count('text')}) // {len(kind) + 2})"


_MASKED_KINDS = [t for t, a in rules.PII_ACTIONS if a == "ANONYMIZE"]
_MARKS_SQL = "list_filter([" + ", ".join(f"CASE WHEN {_added(k)} > 0 THEN 'pii:{k}' END" for k in _MASKED_KINDS) + "], lambda x: x IS NOT NULL)"


def screened_sql(source: str, keys: str, side: str, text: str = "text", tag: str = "") -> str:
    """CTEs ending in ``screened(keys, text, action, reasons)``, names ending in ``tag``."""
    message = _quoted(rules.BLOCKED_INPUT if side == "input" else rules.BLOCKED_OUTPUT)
    return f"""prepared{tag} AS (SELECT {keys}, {text} AS text, {TERMS_SQL.format(text)} AS terms, {mask_sql(text)} AS masked,
      list_filter(list_transform({SENTENCES_SQL.format(t=text)}, lambda s: list_distinct({TERMS_SQL.format('s')})), lambda s: len(s) > 0) AS sets FROM {source}),
    judged{tag} AS (SELECT {keys}, text, masked, list_concat({_filters_sql(side)}, {_TOPICS_SQL}, {_BLOCKS_SQL}) AS why, {_MARKS_SQL} AS marks FROM prepared{tag}),
    screened{tag} AS (SELECT {keys}, CASE WHEN len(why) > 0 THEN {message} ELSE masked END AS text,
      CASE WHEN len(why) > 0 THEN 'blocked' WHEN len(marks) > 0 THEN 'masked' ELSE 'none' END AS action,
      CASE WHEN len(why) > 0 THEN why ELSE marks END AS reasons FROM judged{tag})"""


# Turns of which some are followed by a question close to a denied topic.
_ADDED = {3: "Which legal action should I take", 5: "Who is the president of Spain?", 7: "Is this symptom a serious thing?"}
PROMPTS_SQL = (
    "prompts AS (SELECT conv_id, turn, text || CASE conv_id % 8 "
    + " ".join(f"WHEN {k} THEN chr(10) || {_quoted(v)}" for k, v in _ADDED.items())
    + " ELSE '' END AS text FROM conversations)"
)


def _prompts(spark, sf):
    extra = F.when(F.lit(False), "")
    for rest, question in _ADDED.items():
        extra = extra.when(F.col("conv_id") % 8 == rest, F.lit("\n" + question))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.concat("text", extra.otherwise("")).alias("text"))


@check(
    "k1_content_filter",
    f"""SELECT doc_id, {_hits_of('HATE')} AS n_hate, array_to_string({_filters_sql('input')}, ',') AS on_input,
    array_to_string({_filters_sql('output')}, ',') AS on_output FROM (SELECT doc_id, {TERMS_SQL.format('text')} AS terms FROM documents)""",
)
def k1(spark, sf):
    policy = rules.Policy()
    read = documents(spark, sf).select("doc_id", terms("text").alias("_terms"))

    def on(side):
        return F.array_join(F.transform(rules.blocked_categories(F.col("_terms"), policy, side), lambda c: F.concat(F.lit("filter:"), c)), ",")

    n_hate = rules.filter_hits(F.col("_terms"), rules.LEXICON["HATE"])
    return read.select("doc_id", n_hate.cast("long").alias("n_hate"), on("input").alias("on_input"), on("output").alias("on_output"))


@check(
    "k1_filter_recall",
    f"""SELECT lang, count(*) AS n_toxic, count(*) FILTER ({_hits_of('HATE')} >= 1) AS n_found FROM (
      SELECT lang, {TERMS_SQL.format('text')} AS terms FROM documents JOIN labels USING (doc_id) WHERE toxic = 1) GROUP BY lang""",
)
def k1_recall(spark, sf):
    """What the lexicon finds of the texts labelled toxic, by language."""
    toxic = table(spark, sf, "labels").filter("toxic = 1").select("doc_id")
    read = documents(spark, sf, "lang").join(toxic, "doc_id").select("lang", terms("text").alias("_terms"))
    found = rules.filter_hits(F.col("_terms"), rules.LEXICON["HATE"]) >= 1
    return read.groupBy("lang").agg(F.count("*").alias("n_toxic"), F.count_if(found).alias("n_found"))


# Of five documents three fit the filter, one sets its thresholds, one is held out.
_KNOWN = f"""known AS (SELECT doc_id, lang, toxic, list_distinct({TERMS_SQL.format('text')}) AS terms FROM documents JOIN labels USING (doc_id))"""
_LEARNED = f"""{_KNOWN},
  sides AS (SELECT count(*) AS n, sum(toxic) AS n_in FROM known WHERE doc_id % 5 < 3),
  counts AS (SELECT term, count(*) AS n, sum(toxic) AS n_in FROM (SELECT toxic, unnest(terms) AS term FROM known WHERE doc_id % 5 < 3) GROUP BY term HAVING sum(toxic) >= 3),
  rated AS (SELECT term, c.n_in, round(1000 * ln(((c.n_in + 1) / (s.n_in + 2.0)) / ((c.n - c.n_in + 1) / (s.n - s.n_in + 2.0))))::BIGINT AS weight FROM counts c, sides s),
  weights AS (SELECT term, weight FROM rated WHERE weight >= 2000 ORDER BY weight DESC, n_in DESC, term LIMIT 1000),
  hits AS (SELECT doc_id, weight, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC) AS place FROM (
    SELECT doc_id, unnest(list_distinct({TERMS_SQL.format('text')})) AS term FROM documents) JOIN weights USING (term)),
  scored AS (SELECT doc_id, coalesce(sum(weight) FILTER (place <= 3), 0)::BIGINT AS score FROM documents LEFT JOIN hits USING (doc_id) GROUP BY doc_id),
  levels AS (SELECT score, sum(count(*)) OVER (ORDER BY score DESC) AS n, sum(sum(toxic)) OVER (ORDER BY score DESC) AS n_in
    FROM scored JOIN known USING (doc_id) WHERE doc_id % 5 = 3 AND score > 0 GROUP BY score),
  cuts AS (SELECT min(score) FILTER (n_in / n >= 0.8) AS high, min(score) FILTER (n_in / n >= 0.9) AS medium, min(score) FILTER (n_in / n >= 0.97) AS low FROM levels)"""


def _labelled(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    return documents(spark, sf, "lang").join(labels, "doc_id")


def _fitted(spark, sf):
    labelled, part = _labelled(spark, sf), F.col("doc_id") % 5
    return learned.fit_filter(labelled.filter(part < 3), labelled.filter(part == 3))


@check(
    "k1_learned_filter",
    f"""WITH {_LEARNED} SELECT doc_id, score, concat_ws(',', CASE WHEN score >= high THEN 'HIGH' END,
    CASE WHEN score >= medium THEN 'MEDIUM' END, CASE WHEN score >= low THEN 'LOW' END) AS blocks FROM scored, cuts""",
)
def k1_learned(spark, sf):
    """A filter fitted on labels, applied to every document."""
    scored = learned.score_strengths(documents(spark, sf), _fitted(spark, sf))
    return scored.select("doc_id", F.col("score").cast("long").alias("score"), F.array_join("blocks", ",").alias("blocks"))


@check(
    "k1_learned_recall",
    f"""WITH {_LEARNED} SELECT lang, sum(toxic)::BIGINT AS n_toxic, count(*) FILTER (toxic = 1 AND score >= high) AS n_found,
    count(*) FILTER (toxic = 0 AND score >= high) AS n_false FROM known JOIN scored USING (doc_id), cuts WHERE doc_id % 5 = 4 GROUP BY lang""",
)
def k1_learned_recall(spark, sf):
    """What the fitted filter finds among held-out labels at strength HIGH, by language."""
    held = learned.score_strengths(_labelled(spark, sf).filter(F.col("doc_id") % 5 == 4), _fitted(spark, sf))
    blocks, toxic = F.array_contains("blocks", "HIGH"), F.col("label") == 1
    return held.groupBy("lang").agg(
        F.sum(F.col("label").cast("long")).alias("n_toxic"), F.count_if(blocks & toxic).alias("n_found"), F.count_if(blocks & ~toxic).alias("n_false")
    )


@check(
    "k2_topic_filter",
    f"""WITH {PROMPTS_SQL}, prepared AS (SELECT conv_id, turn,
      list_filter(list_transform({SENTENCES_SQL.format(t='text')}, lambda s: list_distinct({TERMS_SQL.format('s')})), lambda s: len(s) > 0) AS sets FROM prompts)
    SELECT conv_id, turn, round({_topic_score_sql(rules.TOPICS[0][2])}, 6) AS legal, round({_topic_score_sql(rules.TOPICS[2][2])}, 6) AS politics,
    array_to_string({_TOPICS_SQL}, ',') AS denied FROM prepared""",
)
def k2(spark, sf):
    policy = rules.Policy()
    read = _prompts(spark, sf).select("conv_id", "turn", rules.sentence_terms(F.col("text")).alias("_sents"))
    score = lambda i: F.round(rules.topic_score(rules.sentence_sets(F.col("_sents")), policy.topics[i][2]), 6)
    denied = F.transform(rules.denied_topics(F.col("_sents"), policy), lambda t: F.concat(F.lit("topic:"), t))
    return read.select("conv_id", "turn", score(0).alias("legal"), score(2).alias("politics"), F.array_join(denied, ",").alias("denied"))


@check("k3_mask_pii", f"SELECT doc_id, md5({mask_sql('text')}) AS text_md5, {mask_sql('text')} <> text AS changed FROM documents")
def k3(spark, sf):
    masked = once(documents(spark, sf), masked=rules.mask_pii(F.col("text")))
    return masked.select("doc_id", _md5("masked").alias("text_md5"), (F.col("masked") != F.col("text")).alias("changed"))


@check("k3_mask_claims", f"WITH {CLAIMS_SQL} SELECT doc_id, md5({mask_sql('text')}) AS text_md5 FROM claims")
def k3_claims(spark, sf):
    return claims(spark, sf).select("doc_id", F.md5(rules.mask_pii(F.col("text")).cast("binary")).alias("text_md5"))


_EXAMPLE_ROWS = " UNION ALL ".join(
    f"SELECT {i} AS topic, {_quoted(e)} AS example, unnest(list_distinct({TERMS_SQL.format(_quoted(e))})) AS term"
    for i, (_, _, examples) in enumerate(rules.TOPICS)
    for e in examples
)


def _weighted_sql(name: str, source: str, keys: str) -> str:
    """Scores of all topics for the sentences of ``source``: ``name(keys, sent, topic, score)``."""
    return f"""{name}_terms AS (SELECT {keys}, sent, unnest(list_distinct({TERMS_SQL.format('sentence')})) AS term FROM (
      SELECT {keys}, unnest(l) AS sentence, generate_subscripts(l, 1) AS sent FROM (SELECT {keys}, {SENTENCES_SQL.format(t='text')} AS l FROM {source}))),
    {name}_sizes AS (SELECT {keys}, sent, sum(coalesce(w2, (SELECT u2 FROM unknown))) AS size FROM {name}_terms LEFT JOIN squares USING (term) GROUP BY ALL),
    {name} AS (SELECT {keys}, sent, topic, max(round(dot / sqrt(size::DOUBLE * esize::DOUBLE), 6)) AS score FROM (
      SELECT {keys}, sent, topic, example, sum(w2) AS dot FROM {name}_terms JOIN examples USING (term) JOIN squares USING (term) GROUP BY ALL)
      JOIN {name}_sizes USING ({keys}, sent) JOIN example_sizes USING (topic, example) GROUP BY ALL)"""


_CALIBRATED = f"""examples AS ({_EXAMPLE_ROWS}),
  ordinary AS (SELECT list_distinct({TERMS_SQL.format('sentence')}) AS s FROM (SELECT unnest({SENTENCES_SQL.format(t='text')}) AS sentence FROM documents) WHERE len({TERMS_SQL.format('sentence')}) > 0),
  total AS (SELECT count(*) AS n FROM ordinary),
  found AS (SELECT term, count(*) AS df FROM (SELECT unnest(s) AS term FROM ordinary) GROUP BY term),
  squares AS (SELECT term, round(1000 * pow(ln(1 + (n - d + 0.5) / (d + 0.5)), 2))::BIGINT AS w2 FROM (
    SELECT DISTINCT term, coalesce(df, 0)::DOUBLE AS d FROM examples LEFT JOIN found USING (term)), total),
  unknown AS (SELECT round(1000 * pow(ln(1 + (n + 0.5) / 0.5), 2))::BIGINT AS u2 FROM total),
  example_sizes AS (SELECT topic, example, sum(w2) AS esize FROM examples JOIN squares USING (term) GROUP BY ALL),
  {_weighted_sql('known_scores', 'documents', 'doc_id')},
  cuts AS (SELECT topic, min(level) / 100 AS cut FROM (SELECT t.topic AS topic, l.level AS level, count(k.doc_id) AS n_above FROM range(3) AS t(topic), range(50, 102) AS l(level)
    LEFT JOIN known_scores k ON k.topic = t.topic AND floor(k.score * 100) >= l.level GROUP BY t.topic, l.level), total WHERE n_above <= 0.001 * n GROUP BY topic)"""
_TOPIC_NAMES = "[" + ", ".join(_quoted(n) for n, _, _ in rules.TOPICS) + "]"


def _calibrated_policy(spark, sf):
    policy = rules.Policy()
    return replace(policy, topic_model=learned.fit_topics(documents(spark, sf), policy))


@check(
    "k2_topic_calibrated",
    f"""WITH {PROMPTS_SQL}, {_CALIBRATED}, {_weighted_sql('scores', 'prompts', 'conv_id, turn')},
    reached AS (SELECT DISTINCT conv_id, turn, topic FROM (SELECT *, max(score) OVER (PARTITION BY conv_id, turn, sent) AS best FROM scores) JOIN cuts USING (topic) WHERE score >= cut AND score >= best)
    SELECT conv_id, turn, coalesce(string_agg({_TOPIC_NAMES}[topic + 1], ',' ORDER BY topic), '') AS denied FROM prompts LEFT JOIN reached USING (conv_id, turn) GROUP BY conv_id, turn""",
)
def k2_calibrated(spark, sf):
    """Topics by weighted terms, thresholds from ordinary documents, the closest topic alone."""
    denied = rules.denied_topics(rules.sentence_terms(F.col("text")), _calibrated_policy(spark, sf))
    return _prompts(spark, sf).select("conv_id", "turn", F.array_join(denied, ",").alias("denied"))


@check(
    "k2_false_alarms",
    f"""WITH {_CALIBRATED},
    reached AS (SELECT DISTINCT doc_id, topic FROM (SELECT *, max(score) OVER (PARTITION BY doc_id, sent) AS best FROM known_scores) JOIN cuts USING (topic) WHERE score >= cut AND score >= best),
    prepared AS (SELECT doc_id, list_filter(list_transform({SENTENCES_SQL.format(t='text')}, lambda s: list_distinct({TERMS_SQL.format('s')})), lambda s: len(s) > 0) AS sets FROM documents),
    plain AS (SELECT doc_id, unnest({_TOPICS_SQL}) AS topic FROM prepared)
    SELECT {_TOPIC_NAMES}[t + 1] AS topic, (SELECT count(*) FROM plain WHERE topic = 'topic:' || {_TOPIC_NAMES}[t + 1]) AS n_plain,
      (SELECT count(*) FROM reached r WHERE r.topic = t) AS n_calibrated FROM range(3) AS x(t)""",
)
def k2_alarms(spark, sf):
    """Documents, none of which asks for advice, that either way of judging denies."""
    sents = once(documents(spark, sf), _sents=rules.sentence_terms(F.col("text")))
    both = sents.select(
        rules.denied_topics(F.col("_sents"), rules.Policy()).alias("plain"),
        rules.denied_topics(F.col("_sents"), _calibrated_policy(spark, sf)).alias("calibrated"),
    )
    names = [n for n, _, _ in rules.TOPICS]
    counts = [
        F.struct(F.lit(n).alias("topic"), *[F.count_if(F.array_contains(side, n)).alias(f"n_{side}") for side in ("plain", "calibrated")]) for n in names
    ]
    return both.agg(F.array(*counts).alias("_c")).select(F.inline("_c"))


# What follows a claim: mentions of both names, once inside a longer word.
_TAIL = "On the phone {name} said that {patient}s, {name} and {patient} agreed.\n"


@check(
    "k3_mask_mentions",
    f"""WITH {CLAIMS_SQL}, named AS (SELECT doc_id, regexp_extract(text, 'Patient Name: ([^\n]+)', 1) AS patient, text FROM claims)
    SELECT doc_id, md5('Claimant Name: {{NAME}}' || chr(10) || 'Patient Name: {{NAME}}' || chr(10) || 'Phone Number: {{PHONE}}' || chr(10) ||
      substr(text, strpos(text, 'Policy Number: '), strpos(text, 'Signed By: ') - strpos(text, 'Policy Number: ')) || 'Signed By: {{NAME}}' || chr(10) ||
      substr(text, strpos(text, 'Incident Description: ')) || 'On the phone {{NAME}} said that ' || patient || 's, {{NAME}} and {{NAME}} agreed.' || chr(10)) AS text_md5 FROM named""",
)
def k3_mentions(spark, sf):
    """The expected text is written out, without the library's patterns."""
    said = lambda label: F.regexp_extract("text", label + r" Name: ([^\n]+)", 1)
    text = F.concat("text", render(_TAIL, name=said("Claimant"), patient=said("Patient")))
    return claims(spark, sf).select("doc_id", F.md5(rules.mask_mentions(text).cast("binary")).alias("text_md5"))


# What is asked of planted texts is written out here: neither side of these two checks has the library's patterns.
@check(
    "k3_mask_planted",
    r"""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'Ref ' || doc_id || ': ratio 3-4, see mail.example.org, VIN 1HGCM8263, Plate unknown, 12 green roads.'
      ELSE 'Ref ' || doc_id || ': write to {EMAIL} or call {PHONE}.' || chr(10) || 'Claimant Name: {NAME}' || chr(10) || 'Lives at {ADDRESS} now' || chr(10)
        || 'Plate: {LICENSE_PLATE}' || chr(10) || 'VIN {VEHICLE_IDENTIFICATION_NUMBER} seen.' END AS masked FROM documents""",
)
def k3_planted(spark, sf):
    """Known personal data of every masked type, and beside it what only looks like some."""
    docs = table(spark, sf, "documents").select("doc_id")
    padded = lambda size: F.lpad((F.col("doc_id") % 10**size).cast("string"), size, "0")
    plain = F.lit("ratio 3-4, see mail.example.org, VIN 1HGCM8263, Plate unknown, 12 green roads.")
    phone = F.when(F.col("doc_id") % 2 == 1, F.concat(F.lit("614-555-0"), padded(3))).otherwise(F.concat(F.lit("+1 (614) 555-0"), padded(3)))
    private = F.concat(
        F.lit("write to ann.lee"), "doc_id", F.lit("@mail.example.org or call "), phone, F.lit(".\nClaimant Name: Ann Lee "), "doc_id",
        F.lit("\nLives at "), 1 + F.col("doc_id") % 97, F.lit(" Green Hill Road now\nPlate: KLM-"), padded(3), F.lit("\nVIN 1HGCM82633A"), padded(6), F.lit(" seen."),
    )
    text = F.concat(F.lit("Ref "), "doc_id", F.lit(": "), F.when(F.col("doc_id") % 4 == 0, plain).otherwise(private))
    return docs.select("doc_id", rules.mask_pii(text).alias("masked"))


# Text, then what is to become of it: action, reasons, and the text that is handed on (null: the message for blocked input).
_CASES = (
    ("The claim was filed on time.", "none", "", "The claim was filed on time."),
    ("Her number is 123-45-6789.", "blocked", "pii:US_SOCIAL_SECURITY_NUMBER", None),
    ("Driver License ID: D1234567", "blocked", "pii:DRIVER_ID", None),
    ("You are an idiot.", "blocked", "filter:HATE", None),
    ("Is this symptom serious?", "blocked", "topic:MedicalAdvice", None),
    ("Claimant Name: Ann Lee", "masked", "pii:NAME", "Claimant Name: {NAME}"),
)


def _case_sql(place: int, heading: str = "") -> str:
    message = "'The input content has been instructed to deny processing.' || chr(10)"
    whens = " ".join(f"WHEN {i} THEN {message if c[place] is None else heading + _quoted(c[place])}" for i, c in enumerate(_CASES))
    return f"CASE doc_id % {len(_CASES)} {whens} END"


@check(
    "k6_planted",
    f"""SELECT doc_id, {_case_sql(1)} AS action, {_case_sql(2)} AS reasons, {_case_sql(3, "'File ' || doc_id || '.' || chr(10) || ")} AS text FROM documents""",
)
def k6_planted(spark, sf):
    """Texts whose outcome is known, whatever the rules are made of."""
    said = F.element_at(F.array(*[F.lit(c[0]) for c in _CASES]), (F.col("doc_id") % len(_CASES) + 1).cast("int"))
    docs = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("File "), "doc_id", F.lit(".\n"), said).alias("text"))
    return screening.apply_policy(docs).select("doc_id", "action", F.array_join("reasons", ",").alias("reasons"), "text")


_BLOCKED = " OR ".join(f"regexp_matches(text, {_quoted(p)})" for p in _BLOCKS.values())


@check(
    "k4_block_pii",
    f"SELECT doc_id, md5(CASE WHEN {_BLOCKED} THEN {_quoted(rules.BLOCKED_OUTPUT)} ELSE text END) AS text_md5, {_BLOCKED} AS blocked FROM documents",
)
def k4(spark, sf):
    read = documents(spark, sf)
    blocked = F.size(rules.blocking_types(F.col("text"), _policy())) > 0
    return read.select("doc_id", F.md5(rules.block_pii(F.col("text"), _policy()).cast("binary")).alias("text_md5"), blocked.alias("blocked"))


@check(
    "k5_blocked_message",
    f"""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN {_quoted(rules.BLOCKED_INPUT)} ELSE {_quoted(rules.BLOCKED_OUTPUT)} END AS message FROM documents""",
)
def k5(spark, sf):
    on_input = F.col("doc_id") % 2 == 0
    message = F.when(on_input, rules.blocked_message("input")).otherwise(rules.blocked_message("output"))
    return table(spark, sf, "documents").select("doc_id", message.alias("message"))


def _flat(df, *keys):
    return df.select(*keys, "action", F.array_join("reasons", ",").alias("reasons"), _md5("text").alias("text_md5"))


@check(
    "k6_apply_policy",
    f"""WITH {screened_sql('documents', 'doc_id', 'input')} SELECT doc_id, action, array_to_string(reasons, ',') AS reasons, md5(text) AS text_md5 FROM screened""",
)
def k6(spark, sf):
    return _flat(screening.apply_policy(documents(spark, sf), _policy()), "doc_id")


@check(
    "k6_apply_policy_output",
    f"""WITH {PROMPTS_SQL}, {screened_sql('prompts', 'conv_id, turn', 'output')}
    SELECT conv_id, turn, action, array_to_string(reasons, ',') AS reasons, md5(text) AS text_md5 FROM screened""",
)
def k6_output(spark, sf):
    return _flat(screening.apply_policy(_prompts(spark, sf), _policy(), "output"), "conv_id", "turn")


_SWAPPED = tuple((t, "BLOCK" if a == "ANONYMIZE" else "ANONYMIZE") for t, a in rules.PII_ACTIONS)
_PATTERN_OF = {**{t: p for t, p, _ in rules.MASKS}, **rules.BLOCK_PATTERNS}
_NOW_BLOCKED = [t for t, a in _SWAPPED if a == "BLOCK"]
_NOW_MASKED = [t for t, a in _SWAPPED if a == "ANONYMIZE"]
_FOUND_SQL = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(text, {_quoted(_PATTERN_OF[t])}) THEN 'pii:{t}' END" for t in _NOW_BLOCKED) + "], lambda x: x IS NOT NULL)"


def _swapped_mask(text: str) -> str:
    for kind, pattern, replacement in rules.MASKS:
        if kind in _NOW_MASKED:
            text = f"regexp_replace({text}, {_quoted(pattern)}, {_quoted(replacement.replace('$1', chr(92) + '1'))}, 'g')"
    return text


@check(
    "k6_policy_tables",
    f"""WITH texts AS (SELECT doc_id, text || CASE WHEN doc_id % 3 = 0 THEN chr(10) || 'SSN 123-45-' || lpad((doc_id % 10000)::VARCHAR, 4, '0') ELSE '' END AS text FROM documents),
    judged AS (SELECT doc_id, text, {_FOUND_SQL} AS why, {_swapped_mask('text')} AS masked FROM texts)
    SELECT doc_id, CASE WHEN len(why) > 0 THEN 'blocked' WHEN masked <> text THEN 'masked' ELSE 'none' END AS action, array_to_string(why, ',') AS why,
    md5(CASE WHEN len(why) > 0 THEN {_quoted(rules.BLOCKED_INPUT)} ELSE masked END) AS text_md5 FROM judged""",
)
def k6_tables(spark, sf):
    """A policy read from tables, every action the other way round."""
    tail = F.lpad((F.col("doc_id") % 10000).cast("string"), 4, "0")
    text = F.concat("text", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("\nSSN 123-45-"), tail)).otherwise(""))
    policy = rules.policy_from_tables(
        spark.createDataFrame([("HATE", "NONE", "NONE")], "category string, input_strength string, output_strength string"),
        spark.createDataFrame([], "name string, definition string, examples array<string>"),
        spark.createDataFrame(_SWAPPED, "type string, action string"),
    )
    done = screening.apply_policy(documents(spark, sf).select("doc_id", text.alias("text")), policy)
    why = F.when(F.col("action") == "blocked", F.array_join("reasons", ",")).otherwise("")
    return done.select("doc_id", "action", why.alias("why"), _md5("text").alias("text_md5"))


@check(
    "k7_guarded_invoke",
    f"""WITH {PROMPTS_SQL}, {screened_sql('prompts', 'conv_id, turn', 'input')},
    called AS (SELECT conv_id, turn, CASE WHEN action = 'blocked' THEN text ELSE '[stub] ' || trim(text, E' \\n') END AS reply, action AS first FROM screened),
    {screened_sql('called', 'conv_id, turn, first', 'output', 'reply', '2')}
    SELECT conv_id, turn, CASE WHEN first = 'blocked' THEN 'blocked' ELSE action END AS action,
    md5(CASE WHEN first = 'blocked' THEN {_quoted(rules.BLOCKED_INPUT)} ELSE text END) AS answer_md5 FROM screened2""",
)
def k7(spark, sf):
    done = screening.guarded_invoke(_prompts(spark, sf), make_stub, payload_messages, first_text, _policy())
    return done.select("conv_id", "turn", "action", _md5("answer").alias("answer_md5"))


_FINDINGS = [
    f"SELECT doc_id, '{k}' AS type, '{a}' AS action, "
    + (f"len(regexp_extract_all(text, {_quoted(_BLOCKS[k])}))" if a == "BLOCK" else _added(k))
    + " AS n FROM prepared"
    for k, a in _policy().pii
]


@check(
    "k8_policy_findings",
    f"""WITH prepared AS (SELECT doc_id, text, {mask_sql('text')} AS masked FROM documents)
    SELECT doc_id, type, action, n FROM ({' UNION ALL '.join(_FINDINGS)}) WHERE n > 0""",
)
def k8(spark, sf):
    return screening.policy_findings(documents(spark, sf), _policy()).withColumn("n", F.col("n").cast("long"))


def _places(name: str, pattern: str) -> str:
    """Matches of a pattern and where they start, from what lies between them."""
    quoted = _quoted(pattern)
    return f"""{name} AS (SELECT doc_id, hit, sum(length(gap)) OVER w + sum(length(hit)) OVER w - length(hit) AS start FROM (
      SELECT doc_id, unnest(string_split_regex(text, {quoted})) AS gap, unnest(list_append(regexp_extract_all(text, {quoted}), '')) AS hit,
        unnest(range(len(string_split_regex(text, {quoted})))) AS i FROM documents) WINDOW w AS (PARTITION BY doc_id ORDER BY i))"""


# Written out here, so that a wrong pattern of the library is not wrong on both sides.
_PLACES = {
    "emails": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "phones": r"(?:\+?[0-9] )?(?:\([0-9]{3}\) ?|[0-9]{3}-)[0-9]{3}-[0-9]{4}",
    "plates": r"Plate: [A-Z0-9][A-Z0-9-]*",
    "streets": r"[0-9]+ (?:[A-Z][a-z]+ )+(?:Street|Avenue|Road|Lane|Drive)",
    "names": r"(?:^|\n)[A-Za-z ]*Name: [^\n{]+",
    "numbers": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "drivers": r"Driver(?: License)?(?: ID)?: ",
    "cards": r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}",
    "tokens": r"token = .[0-9a-f]{40}",
    "runs": r"[A-Za-z0-9]+",
    "words": r"[\p{L}0-9]+",
    "phrases": r"[^.!?\n]+[.!?]*",
}


def _found(place: str, kind: str, action: str, label: str = "0", where: str = "hit <> ''") -> str:
    return f"SELECT doc_id, 'pii' AS policy, '{kind}' AS type, '{action}' AS action, start + {label} AS start, start + length(hit) AS end_at FROM {place} WHERE {where}"


_LEXICON_ROWS = ", ".join(f"({_quoted(w)}, '{c}', '{'NONE' if c == 'PROMPT_ATTACK' else 'BLOCK'}')" for c, ws in rules.LEXICON.items() for w in ws)
_TRACE_ROWS = " UNION ALL ".join(
    [
        _found("emails", "EMAIL", "ANONYMIZE"),
        _found("phones", "PHONE", "ANONYMIZE"),
        _found("plates", "LICENSE_PLATE", "ANONYMIZE", "7"),
        _found("streets", "ADDRESS", "ANONYMIZE"),
        _found("names", "NAME", "ANONYMIZE", "length(regexp_extract(hit, '\\n?[A-Za-z ]*Name: '))"),
        _found("numbers", "US_SOCIAL_SECURITY_NUMBER", "BLOCK"),
        _found("drivers", "DRIVER_ID", "BLOCK"),
        _found("cards", "CARD_NUMBER", "BLOCK"),
        _found("tokens", "ACCESS_TOKEN", "BLOCK"),
        _found("runs", "VEHICLE_IDENTIFICATION_NUMBER", "ANONYMIZE", where="regexp_full_match(hit, '[A-HJ-NPR-Z0-9]{17}')"),
        f"SELECT doc_id, 'filter', category, action, start, start + length(hit) FROM words JOIN (VALUES {_LEXICON_ROWS}) AS v(word, category, action) ON lower(hit) = word",
    ]
    + [
        f"SELECT doc_id, 'topic', '{n}', 'BLOCK', start + length(hit) - length(ltrim(hit, ws)), start + length(rtrim(hit, ws)) FROM sets WHERE {_topic_score_sql(ex)} >= 0.6"
        for n, _, ex in rules.TOPICS
    ]
)


@check(
    "k8_policy_trace",
    f"""WITH {', '.join(_places(n, p) for n, p in _PLACES.items())},
    sets AS (SELECT *, [list_distinct({TERMS_SQL.format('hit')})] AS sets FROM phrases, (SELECT {_quoted(WHITESPACE)} AS ws) WHERE len({TERMS_SQL.format('hit')}) > 0)
    SELECT doc_id, policy, type, action, start::BIGINT AS start, end_at::BIGINT AS end_at FROM ({_TRACE_ROWS})""",
)
def k8_trace(spark, sf):
    """Every finding with its place, as of the output side."""
    found = screening.policy_trace(documents(spark, sf), _policy(), "output")
    return found.select("doc_id", "policy", "type", "action", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end_at"))


_PLANTED = "You IDIOT! Is this policy contract enforceable? Mail a.b@example.org, SSN 123-45-6789."


def _planted(policy: str, kind: str, action: str, what: str) -> str:
    """One expected row: where a planted string stands for the first time."""
    return f"SELECT doc_id, '{policy}' AS policy, '{kind}' AS type, '{action}' AS action, strpos(text, {what}) - 1 AS start, strpos(text, {what}) - 1 + length({what}) AS end_at FROM said"


@check(
    "k8_trace_claims",
    f"""WITH {CLAIMS_SQL}, said AS (SELECT doc_id, text || {_quoted(_PLANTED)} AS text, regexp_extract(text, 'Claimant Name: ([^\n]+)', 1) AS name,
      regexp_extract(text, 'Patient Name: ([^\n]+)', 1) AS patient FROM claims),
    expected AS ({_planted('filter', 'HATE', 'BLOCK', "'IDIOT'")}
      UNION ALL {_planted('topic', 'LegalAdvice', 'BLOCK', "'Is this policy contract enforceable?'")}
      UNION ALL {_planted('pii', 'EMAIL', 'ANONYMIZE', "'a.b@example.org'")}
      UNION ALL {_planted('pii', 'US_SOCIAL_SECURITY_NUMBER', 'BLOCK', "'123-45-6789'")}
      UNION ALL SELECT doc_id, 'pii', 'PHONE', 'ANONYMIZE', strpos(text, '+1 614-') - 1, strpos(text, '+1 614-') + 14 FROM said
      UNION ALL SELECT doc_id, 'pii', 'NAME', 'ANONYMIZE', 15, 15 + length(name) FROM said
      UNION ALL SELECT doc_id, 'pii', 'NAME', 'ANONYMIZE', strpos(text, 'Patient Name: ') + 13, strpos(text, 'Patient Name: ') + 13 + length(patient) FROM said)
    SELECT doc_id, policy, type, action, start::BIGINT AS start, end_at::BIGINT AS end_at FROM expected""",
)
def k8_claims(spark, sf):
    """Planted findings of every kind, their places told without a pattern."""
    found = screening.policy_trace(claims(spark, sf).withColumn("text", F.concat("text", F.lit(_PLANTED))))
    return found.select("doc_id", "policy", "type", "action", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end_at"))


@check(
    "k9_retrieve_guarded",
    f"""WITH {HITS_SQL}, {screened_sql('asked', 'query_id', 'input', 'question')}
    SELECT query_id, rank, chunk_id, score, md5({mask_sql('c.text')}) AS text_md5 FROM hits JOIN chunks c USING (chunk_id)
    WHERE query_id IN (SELECT query_id FROM screened WHERE action <> 'blocked')""",
)
def k9(spark, sf):
    hits = retrieve_guarded(questions(spark, sf), document_index(spark, sf), 3, _policy())
    return hits.select("query_id", "rank", "chunk_id", "score", _md5("text").alias("text_md5"))


@check(
    "k10_screening_report",
    f"""WITH {screened_sql('documents', 'doc_id', 'input')},
    each AS (SELECT action, unnest(CASE WHEN len(reasons) = 0 THEN ['-'] ELSE reasons END) AS reason FROM screened)
    SELECT action, reason, count(*) AS n_docs FROM each GROUP BY ALL""",
)
def k10(spark, sf):
    return screening.screening_report(screening.apply_policy(documents(spark, sf), _policy()))


_ASKED = "asked AS (SELECT item_id AS query_id, text AS question FROM benchmark)"
_PASSED = f"""asked_raw AS (SELECT item_id AS query_id, text AS question FROM benchmark), {screened_sql('asked_raw', 'query_id', 'input', 'question')},
  asked AS (SELECT query_id, text AS question FROM screened WHERE action <> 'blocked')"""


@check(
    "r8_answer_defaults",
    f"""WITH {ANSWERS_SQL.replace(_ASKED, _PASSED)}, {screened_sql('answers', 'query_id, n_citations, cited', 'output', 'answer', '2')}
    SELECT query_id, text AS answer, n_citations, cited, action FROM screened2
    UNION ALL SELECT query_id, text, 0, '', action FROM screened WHERE action = 'blocked'""",
)
def r8(spark, sf):
    """The question form: its own token budget, a policy, no explicit k."""
    done = answer(questions(spark, sf), document_index(spark, sf), make_stub, max_tokens=256, policy=_policy())
    return _flat_answers(done).join(done.select("query_id", "action"), "query_id")


def make_form_client():
    """Says back what the form asked for: temperature, token budget, prompt."""

    def client(model_id, payload, policy):
        asked = payload["inferenceConfig"]
        text = f"{asked['temperature']}|{asked['maxTokens']}|" + payload["messages"][0]["content"][0]["text"].strip(" \n")
        return {"content": [{"text": text}]}

    return client


@check(
    "r8_question_form",
    f"""WITH {ANSWERS_SQL.replace("'[stub] ' ||", "CASE WHEN query_id % 3 = 0 THEN '0.5|512|' ELSE '0.25|' || (100 + query_id) || '|' END ||")}
    SELECT query_id, answer, n_citations, cited FROM answers""",
)
def r8_form(spark, sf):
    """Questions with a temperature and token budget of their own, or none."""
    own = F.col("query_id") % 3 != 0
    form = questions(spark, sf).withColumns(
        {"temperature": F.when(own, F.lit(" 0.25")), "max_tokens": F.when(own, F.concat((100 + F.col("query_id")).cast("string"), F.lit(" ")))}
    )
    asked = question_params(form)
    done = answer(asked, document_index(spark, sf), make_form_client, max_tokens=F.col("max_tokens"), temperature=F.col("temperature"))
    return _flat_answers(done)
