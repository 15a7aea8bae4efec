"""Content policy as Column expressions (K1-K5).

A policy is a handful of small tables. They are read at plan time into
literals, so screening is a projection: it shuffles nothing and runs the same
on a batch and on a stream.

Topic similarity by shared terms and masking by pattern are plain stand-ins
for trained classifiers: names and addresses are found on labelled lines and
in street form, and ``mask_mentions`` finds labelled ones wherever they are
mentioned. A ``LearnedFilter`` takes the place of a category's words.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import SENTENCE_PATTERN, WHITESPACE, terms

# Filter categories with input and output strength.
FILTERS = (
    ("HATE", "HIGH", "HIGH"),
    ("SEXUAL", "HIGH", "HIGH"),
    ("VIOLENCE", "HIGH", "HIGH"),
    ("PROMPT_ATTACK", "HIGH", "NONE"),
)
# Denied topics with definition and examples, spelled as given.
TOPICS = (
    (
        "LegalAdvice",
        "Providing legal advice or interpretation of insurance policy laws",
        (
            "What legal action should I take?",
            "Is this policy contract enforceable?",
            "Can you share with me the policy detail?",
        ),
    ),
    (
        "MedicalAdvice",
        "Providing medical diagnosis or treatment advice",
        (
            "What medication should I take?",
            "Is this symptom serious?",
            "What medicine is good for you daily diet?",
        ),
    ),
    (
        "Politics",
        "Provding advice on any policitical issue including wrold-politics, geo-politics",
        (
            "What USA presiden is the best?",
            "Who is the president of France?",
            "Do the presidents lie about their responsibilities?",
        ),
    ),
)
# Personal data types and what is done about them.
PII_ACTIONS = (
    ("NAME", "ANONYMIZE"),
    ("ADDRESS", "ANONYMIZE"),
    ("PHONE", "ANONYMIZE"),
    ("EMAIL", "ANONYMIZE"),
    ("US_SOCIAL_SECURITY_NUMBER", "BLOCK"),
    ("DRIVER_ID", "BLOCK"),
    ("VEHICLE_IDENTIFICATION_NUMBER", "ANONYMIZE"),
    ("LICENSE_PLATE", "ANONYMIZE"),
)
# What a blocked text is replaced with, by side.
BLOCKED_INPUT = "The input content has been instructed to deny processing.\n"
BLOCKED_OUTPUT = "Output is omitted due to sensitive information.\n"

# Words that count towards a filter category: a choice of our own.
LEXICON = {
    "HATE": ("trash", "idiot", "clown", "scum", "worthless", "moron", "pathetic", "loser", "disgusting", "stupid"),
    "SEXUAL": ("porn", "pornography", "nude", "nudes", "erotic"),
    "VIOLENCE": ("murder", "murdering", "slaughter", "behead", "massacre"),
    "PROMPT_ATTACK": ("jailbreak", "jailbroken", "uncensored", "unfiltered"),
}
# Hits from which a strength blocks; NONE never does.
STRENGTHS = {"HIGH": 1, "MEDIUM": 2, "LOW": 3}

# Masking patterns, in order of application: type, pattern, replacement.
MASKS = (
    ("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "{EMAIL}"),
    (
        "VEHICLE_IDENTIFICATION_NUMBER",
        r"(^|[^A-Za-z0-9])[A-HJ-NPR-Z0-9]{17}($|[^A-Za-z0-9])",
        "$1{VEHICLE_IDENTIFICATION_NUMBER}$2",
    ),
    ("PHONE", r"(\+?[0-9] )?(\([0-9]{3}\) ?|[0-9]{3}-)[0-9]{3}-[0-9]{4}", "{PHONE}"),
    ("LICENSE_PLATE", r"(Plate: )[A-Z0-9][A-Z0-9-]*", "$1{LICENSE_PLATE}"),
    ("ADDRESS", r"[0-9]+ ([A-Z][a-z]+ )+(Street|Avenue|Road|Lane|Drive)", "{ADDRESS}"),
    ("NAME", r"((^|\n)[A-Za-z ]*Name: )[^\n{]+", "$1{NAME}"),
    ("US_SOCIAL_SECURITY_NUMBER", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "{US_SOCIAL_SECURITY_NUMBER}"),
    ("DRIVER_ID", r"(Driver( License)?( ID)?: )[^\n{]+", "$1{DRIVER_ID}"),
)
# A match of the pattern holds one of these; texts without are left alone.
MASK_SIGNS = {
    "EMAIL": ("@",),
    "PHONE": ("-",),
    "LICENSE_PLATE": ("Plate: ",),
    "ADDRESS": (" Street", " Avenue", " Road", " Lane", " Drive"),
    "NAME": ("Name: ",),
    "US_SOCIAL_SECURITY_NUMBER": ("-",),
    "DRIVER_ID": ("Driver",),
}
# The same as a pattern where no fixed text will do.
MASK_CORES = {"VEHICLE_IDENTIFICATION_NUMBER": "[A-HJ-NPR-Z0-9]{17}"}
# Fails at the first character of a text without looking further.
NO_MATCH = r"\A(?!)"
# Neighbouring matches share a separator, so one pass misses every other one.
MASKED_TWICE = {"VEHICLE_IDENTIFICATION_NUMBER"}
BLOCK_PATTERNS = {
    "US_SOCIAL_SECURITY_NUMBER": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "DRIVER_ID": r"Driver( License)?( ID)?: ",
}
MAX_POLICY_ROWS = 1_000
ACTIONS = ("ANONYMIZE", "BLOCK")
# Strengths a policy may name; NONE never blocks.
KNOWN_STRENGTHS = (*STRENGTHS, "NONE")


# Lines that say of what follows them that it is a name or an address.
LABELLED = (
    ("NAME", r"((?:^|\n)[A-Za-z ]*Name: )[^\n{]+"),
    ("ADDRESS", r"((?:^|\n)[A-Za-z ]*Address: )[^\n{]+"),
)
# A mention neither goes on into a word, an address of e-mail or a mark.
MENTION_START, MENTION_END = r"(?<![\p{L}\p{N}_@{])", r"(?![\p{L}\p{N}_@}])"
# Shorter values are masked where they are labelled only.
MIN_MENTION = 3
# The same matches as those of MASKS, told from fewer starts: a run is tried from its
# beginning, or from where the match before it ended, and other kinds of data by their first character.
SPAN_STARTS = {
    "EMAIL": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "PHONE": r"(?=[0-9+(])(\+?[0-9] )?(\([0-9]{3}\) ?|[0-9]{3}-)[0-9]{3}-[0-9]{4}",
}
# Every match holds the first sign, and none the second: a search begins behind the last
# of these that stands before the first sign.
SPAN_SKIPS = {"EMAIL": ("@", " ")}
# Stands between the parts of a text that is cut at matches.
SPAN_MARK = "\x01"
# Whole numbers and letters, neighbours included: what MASKS needs two passes for.
SPAN_PATTERNS = {"VEHICLE_IDENTIFICATION_NUMBER": r"(?=[A-HJ-NPR-Z0-9])(?<![A-Za-z0-9])[A-HJ-NPR-Z0-9]{17}(?![A-Za-z0-9])"}
# A sentence and the marks and newlines before it, so that places are sums of lengths.
PIECE_PATTERN = r"\G[.!?\n]*+" + SENTENCE_PATTERN


@dataclass(frozen=True)
class LearnedFilter:
    """A linear filter: the ``top`` largest weights among a text's distinct terms, added up.

    ``thresholds`` has the score from which each strength blocks, or None
    where no score was precise enough; see ``operators.learned.fit_filter``.
    """

    weights: tuple[tuple[str, int], ...]
    thresholds: tuple[tuple[str, int | None], ...]
    top: int = 3

    def threshold(self, strength: str) -> int | None:
        return dict(self.thresholds).get(strength)


@dataclass(frozen=True)
class TopicModel:
    """What a term says, and from which score on a topic is denied; see ``operators.learned.fit_topics``.

    ``squares`` has the squared weight of every term of the examples in
    thousandths, ``unknown`` that of any other term.
    """

    squares: tuple[tuple[str, int], ...]
    unknown: int
    thresholds: tuple[tuple[str, float], ...] = ()


@dataclass(frozen=True)
class Policy:
    """The tables of one policy. ``pii`` maps a type to its action.

    A category in ``learned`` is judged by its fitted filter, any other by the
    words of the lexicon. With ``mentions``, labelled names and addresses are
    masked wherever a text mentions them. With a ``topic_model``, topics are
    judged by its weights, thresholds and the contrast between them.
    """

    filters: tuple = FILTERS
    topics: tuple = TOPICS
    pii: tuple = PII_ACTIONS
    lexicon: dict = field(default_factory=lambda: dict(LEXICON))
    block_patterns: dict = field(default_factory=lambda: dict(BLOCK_PATTERNS))
    topic_threshold: float = 0.6
    blocked_input: str = BLOCKED_INPUT
    blocked_output: str = BLOCKED_OUTPUT
    learned: dict = field(default_factory=dict)
    mentions: bool = False
    topic_model: TopicModel | None = None

    def __post_init__(self):
        """Refuse what the rules below could only pass over in silence."""
        for kind, action in self.pii:
            if action not in ACTIONS:
                raise ValueError(f"action of {kind} is one of {', '.join(ACTIONS)}, not {action!r}")
            self.found_by(kind)
        for category, *strengths in self.filters:
            if not self.lexicon.get(category) and category not in self.learned:
                raise ValueError(f"no words are known for the category {category!r}")
            for strength in strengths:
                if strength not in KNOWN_STRENGTHS:
                    raise ValueError(f"strength of {category} is one of {', '.join(KNOWN_STRENGTHS)}, not {strength!r}")
        for name, _, examples in self.topics:
            if not examples:
                raise ValueError(f"topic {name!r} has no examples to compare with")

    def of_type(self, action: str) -> list[str]:
        return [t for t, a in self.pii if a == action]

    def found_by(self, kind: str) -> str:
        """The pattern that tells texts holding data of a type, whatever is done about it."""
        pattern = self.block_patterns.get(kind) or {t: p for t, p, _ in MASKS}.get(kind)
        if pattern is None:
            raise ValueError(f"no pattern is known for data of type {kind!r}")
        return pattern

    def masks(self) -> list[tuple[str, str, str]]:
        """Type, pattern and replacement of what is anonymized, in order of application."""
        wanted, listed = self.of_type("ANONYMIZE"), [t for t, _, _ in MASKS]
        own = [(t, self.block_patterns[t], "{" + t + "}") for t in wanted if t not in listed]
        return [m for m in MASKS if m[0] in wanted] + own

    def with_blocks(self, patterns: dict[str, str]) -> "Policy":
        """The same policy, blocking further patterns."""
        return replace(
            self,
            pii=self.pii + tuple((t, "BLOCK") for t in patterns),
            block_patterns={**self.block_patterns, **patterns},
        )


def policy_from_tables(filters: DataFrame, topics: DataFrame, pii: DataFrame, base: Policy | None = None) -> Policy:
    """Read ``(category, input_strength, output_strength)``, ``(name, definition,
    examples)`` and ``(type, action)``; a policy of more rows is refused."""

    def rows(df: DataFrame) -> list:
        found = df.limit(MAX_POLICY_ROWS + 1).collect()
        if len(found) > MAX_POLICY_ROWS:
            raise ValueError(f"a policy table may have at most {MAX_POLICY_ROWS} rows")
        return found

    return replace(
        base or Policy(),
        filters=tuple(tuple(r) for r in rows(filters.select("category", "input_strength", "output_strength"))),
        topics=tuple((r[0], r[1], tuple(r[2])) for r in rows(topics.select("name", "definition", "examples"))),
        pii=tuple(tuple(r) for r in rows(pii.select("type", "action"))),
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sentence_terms(text: Column) -> Column:
    """The terms of a text, sentence by sentence."""
    # what is stripped from a sentence holds no term
    found = F.regexp_extract_all(text, F.lit(SENTENCE_PATTERN), F.lit(0))
    return F.filter(F.transform(found, terms), lambda s: F.size(s) > 0)


def filter_hits(term_list: Column, words: tuple[str, ...]) -> Column:
    return F.size(F.filter(term_list, lambda t: t.isin(*words)))


def blocked_categories(term_list: Column, policy: Policy, side: str) -> Column:
    """K1: categories whose word count reaches the strength of this side."""
    _check_side(side)
    nothing = F.array().cast("array<string>")
    active = []
    for category, on_input, on_output in policy.filters:
        strength = on_input if side == "input" else on_output
        model = policy.learned.get(category)
        if model is not None and model.threshold(strength) is not None:
            words = [w for w, _ in model.weights]
            active.append((category, words, lambda hits, m=model, n=model.threshold(strength): learned_score(hits, m) >= n))
        elif model is None and strength in STRENGTHS:
            words = policy.lexicon[category]
            active.append((category, words, lambda hits, w=words, n=STRENGTHS[strength]: filter_hits(hits, w) >= n))
    if not active:
        return nothing
    listed = sorted({word for _, words, _ in active for word in words})
    # one pass over the text picks the listed words; categories count those
    return _let(
        F.filter(term_list, lambda t: t.isin(*listed)),
        lambda hits: F.array_compact(F.array(*[F.when(reached(hits), F.lit(c)) for c, _, reached in active])),
    )


def learned_score(term_list: Column, model: LearnedFilter) -> Column:
    """K1: the ``top`` largest weights of the distinct terms, added up; 0 without a known term."""
    if not model.weights:
        return F.when(term_list.isNotNull(), F.lit(0))
    words = [w for w, _ in model.weights]
    # terms hold no blanks, so both lists travel as one literal each
    weight_of = F.map_from_arrays(
        F.split(F.lit(" ".join(words)), " "), F.split(F.lit(" ".join(str(n) for _, n in model.weights)), " ").cast("array<int>")
    )
    known = F.array_distinct(F.filter(term_list, lambda t: t.isin(*words)))
    weights = F.sort_array(F.transform(known, lambda t: F.element_at(weight_of, t)), asc=False)
    return F.aggregate(F.slice(weights, 1, model.top), F.lit(0), lambda a, w: a + w)


def _term_sets(examples: tuple[str, ...]) -> Column:
    return F.array(*[F.array_distinct(terms(F.lit(e))) for e in examples])


def topic_score(sets: Column, examples: tuple[str, ...]) -> Column:
    """K2: best ``|A & B| / sqrt(|A| * |B|)`` over sentence term sets and examples."""
    known = _term_sets(examples)

    def against(s: Column) -> Column:
        return F.array_max(
            F.transform(known, lambda e: F.size(F.array_intersect(s, e)) / F.sqrt((F.size(s) * F.size(e)).cast("double")))
        )

    return F.coalesce(F.array_max(F.transform(sets, against)), F.lit(0.0))


def sentence_sets(sents: Column) -> Column:
    """``sentence_terms`` as sets."""
    return F.transform(sents, F.array_distinct)


def weighted_scores(term_set: Column, topics: tuple, model: TopicModel) -> Column:
    """K2: for each topic the best cosine of a sentence's term set and an example's, by weighted terms.

    Sums are of whole numbers, so the order of terms does not matter; scores
    are rounded to six digits.
    """
    words = [w for w, _ in model.squares]
    square_of = F.map_from_arrays(
        F.split(F.lit(" ".join(words)), " "), F.split(F.lit(" ".join(str(n) for _, n in model.squares)), " ").cast("array<bigint>")
    )
    own = dict(model.squares)

    def total(found: Column) -> Column:
        return F.aggregate(found, F.lit(0).cast("bigint"), lambda a, t: a + F.element_at(square_of, t))

    def against(known: Column, size: Column, examples: tuple[tuple[str, ...], ...]) -> Column:
        scores = [total(_among(known, e)) / F.sqrt(size * F.lit(float(sum(own[w] for w in e)))) for e in examples if e]
        return F.round(F.greatest(F.lit(0.0), *scores), 6)

    listed = [tuple(tuple(sorted(set(plain_terms(e)))) for e in examples) for _, _, examples in topics]

    def judged(known: Column) -> Column:
        size = (total(known) + (F.size(term_set) - F.size(known)) * model.unknown).cast("double")
        return _let(size, lambda n: F.array(*[against(known, n, examples) for examples in listed]))

    nothing = F.array(*[F.lit(0.0) for _ in topics])
    return _let(
        F.filter(term_set, lambda t: t.isin(*words)), lambda known: F.when(F.size(known) > 0, judged(known)).otherwise(nothing)
    )


def _among(found: Column, words: tuple[str, ...]) -> Column:
    return F.filter(found, lambda t: t.isin(*words))


def _item(place: int) -> Callable[[Column], Column]:
    return lambda values: F.get(values, F.lit(place))


def plain_terms(text: str) -> list[str]:
    """``terms`` of a text known on the driver, such as an example of a topic."""
    return "".join(c if c.isalpha() or c in "0123456789" else " " for c in text.lower()).split()


def reached_topics(scores: Column, policy: Policy) -> Column:
    """K2: one truth value for each topic: at its threshold, and no other topic scores more."""
    cuts = dict(policy.topic_model.thresholds)
    best = F.array_max(scores)
    at = [F.get(scores, F.lit(i)) for i in range(len(policy.topics))]
    return F.array(*[(at[i] >= cuts.get(name, policy.topic_threshold)) & (at[i] >= best) for i, (name, _, _) in enumerate(policy.topics)])


def near_topic(term_set: Column, name: str, policy: Policy) -> Column:
    """K2: whether one sentence, as a set of terms that is not empty, is about a denied topic."""
    if policy.topic_model is None:
        examples = {n: e for n, _, e in policy.topics}[name]
        return topic_score(F.array(term_set), examples) >= policy.topic_threshold
    place = [n for n, _, _ in policy.topics].index(name)
    found = _let(weighted_scores(term_set, policy.topics, policy.topic_model), lambda s: reached_topics(s, policy))
    return F.get(found, F.lit(place))


def _weighted_topics(sents: Column, policy: Policy) -> Column:
    names = [n for n, _, _ in policy.topics]
    reached = F.transform(
        sentence_sets(sents),
        lambda s: _let(weighted_scores(s, policy.topics, policy.topic_model), lambda scores: reached_topics(scores, policy)),
    )
    return _let(
        reached,
        lambda found: F.array_compact(
            F.array(*[F.when(F.array_contains(F.transform(found, _item(i)), True), F.lit(n)) for i, n in enumerate(names)])
        ),
    )


def denied_topics(sents: Column, policy: Policy) -> Column:
    """K2: the topics scoring at or above the threshold.

    A sentence sharing too few terms with all examples together cannot reach
    the threshold with one of them, and is dropped before the single scores.
    """
    if not policy.topics:
        return F.array().cast("array<string>")
    if policy.topic_model is not None:
        return _weighted_topics(sents, policy)
    every = _term_sets(tuple(e for _, _, examples in policy.topics for e in examples))
    union, shortest = F.array_distinct(F.flatten(every)), F.array_min(F.transform(every, F.size))

    def near(s: Column) -> Column:
        needed = policy.topic_threshold * F.sqrt((F.size(s) * shortest).cast("double"))
        return F.size(F.array_intersect(s, union)) >= needed - 1e-9

    return _let(
        F.filter(sentence_sets(sents), near),
        lambda close: F.array_compact(
            F.array(*[F.when(topic_score(close, ex) >= policy.topic_threshold, F.lit(name)) for name, _, ex in policy.topics])
        ),
    )


def may_mask(text: Column, kind: str) -> Column:
    """A cheap test that rules most texts out before a pattern is tried."""
    if kind in MASK_CORES:
        return F.regexp_like(text, F.lit(MASK_CORES[kind]))
    if kind not in MASK_SIGNS:
        return F.lit(True)
    found = [F.contains(text, F.lit(sign)) for sign in MASK_SIGNS[kind]]
    return reduce(lambda a, b: a | b, found)


def mask_pii(text: Column, policy: Policy | None = None) -> Column:
    """K3: personal data of the ANONYMIZE types replaced by ``{TYPE}``.

    Texts that cannot match get a pattern that gives up at once; so the chain
    of replacements names each step a single time.
    """
    masked = text
    for kind, pattern, replacement in (policy or Policy()).masks():
        tried = F.when(may_mask(text, kind), pattern).otherwise(NO_MATCH)
        for _ in range(2 if kind in MASKED_TWICE else 1):
            masked = F.regexp_replace(masked, tried, F.lit(replacement))
    return masked


def labelled_values(text: Column, policy: Policy | None = None) -> Column:
    """Names and addresses on lines that say so: ``array<struct<size, value, kind>>``, longest first.

    Blanks and closing punctuation around a value do not belong to it. E-mail
    addresses, values without a letter and values under ``MIN_MENTION``
    characters are left out, and so are types the policy does not mask.
    """
    wanted = (policy or Policy()).of_type("ANONYMIZE")

    def values(kind: str, pattern: str) -> Column:
        lines = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        labels = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        said = F.zip_with(lines, labels, lambda whole, label: F.substr(whole, F.length(label) + 1))
        clean = F.transform(said, lambda v: F.regexp_replace(v, r"^[ \t\r]+|[ \t\r.,;:]+$", ""))
        real = F.filter(clean, lambda v: (F.length(v) >= MIN_MENTION) & F.regexp_like(v, F.lit(r"\p{L}")) & ~F.contains(v, F.lit("@")))
        return F.transform(
            F.array_distinct(real), lambda v: F.struct((-F.length(v)).alias("size"), v.alias("value"), F.lit(kind).alias("kind"))
        )

    found = [values(kind, pattern) for kind, pattern in LABELLED if kind in wanted]
    if not found:
        return F.array().cast("array<struct<size:int,value:string,kind:string>>")
    return F.when(F.regexp_like(text, F.lit("(Name|Address): ")), F.array_sort(F.concat(*found))).otherwise(
        F.array().cast("array<struct<size:int,value:string,kind:string>>")
    )


def mask_mentions(text: Column, policy: Policy | None = None) -> Column:
    """K3: what a labelled line calls a name or an address is masked wherever the text mentions it.

    The longest value goes first, so a name inside a longer one does not break
    it; a value that stands under two labels counts as the first in order of
    type. Mentions are whole words in the same spelling. Then the patterns of
    ``mask_pii`` apply. Row-local: what one text labels says nothing about
    others. A null text stays null, and a text without labelled lines is
    masked as by ``mask_pii``.
    """

    def replaced(done: Column, found: Column) -> Column:
        value = found["value"]
        quoted = F.concat(F.lit("\\Q"), F.replace(value, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
        pattern = F.concat(F.lit(MENTION_START), quoted, F.lit(MENTION_END))
        mark = F.concat(F.lit("{"), found["kind"], F.lit("}"))
        return F.when(F.contains(done, value), F.regexp_replace(done, pattern, mark)).otherwise(done)

    return mask_pii(F.aggregate(labelled_values(text, policy), text, replaced), policy)


def masked_count(masked: Column, original: Column, kind: str) -> Column:
    """How many ``{kind}`` marks masking added."""
    mark = F.lit("{" + kind + "}")
    grown = (F.length(masked) - F.length(F.replace(masked, mark, F.lit("")))) - (
        F.length(original) - F.length(F.replace(original, mark, F.lit("")))
    )
    return (grown / (len(kind) + 2)).cast("int")


def blocking_types(text: Column, policy: Policy | None = None) -> Column:
    """K4: the BLOCK types found in a text."""
    policy = policy or Policy()
    kinds = policy.of_type("BLOCK")
    if not kinds:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(F.regexp_like(text, F.lit(policy.found_by(t))), F.lit(t)) for t in kinds]))


# Lengths are added up within blocks of this many matches, so that a text of
# very many takes no time of their square.
SPAN_BLOCK = 256


def _sums_before(sizes: Column) -> Column:
    """For each position the sum of all sizes before it."""

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda a, n: a + n)

    def of_blocks(sizes: Column) -> Column:
        last = F.floor(F.size(sizes) / SPAN_BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda block: total(F.slice(sizes, F.lit(1), block * SPAN_BLOCK)))

    def sums(sizes: Column, bases: Column) -> Column:
        def before(_: Column, i: Column) -> Column:
            block = F.floor(i / SPAN_BLOCK).cast("int")
            return F.element_at(bases, block + 1) + total(F.slice(sizes, block * SPAN_BLOCK + 1, i % SPAN_BLOCK))

        return F.transform(sizes, before)

    # inside a function of elements an expression would be made anew for each
    return _let(sizes, lambda v: _let(of_blocks(v), lambda bases: sums(v, bases)))


def spans(text: Column, pattern: str, label: int | None = None) -> Column:
    """Matches of a pattern as ``array<struct<start, end, hit>>``, in code points, ``end`` exclusive.

    Matches are marked off in the text, which is cut at the marks, so positions
    are sums of lengths. A match must not be empty. With ``label`` the group of
    that number, which begins each match, is left out of it. Null text: null.
    """
    width = 2 if label is None else 3
    marks = f"{SPAN_MARK}$0{SPAN_MARK}" if label is None else f"{SPAN_MARK}${label}{SPAN_MARK}$0{SPAN_MARK}"
    marked = F.regexp_replace(text, F.lit(pattern), F.lit(marks))
    nothing = F.array().cast("array<struct<start:int,end:int,hit:string>>")

    def placed(parts: Column) -> Column:
        def part(i: Column, which: int) -> Column:
            return F.get(parts, i * width + which)

        def size(i: Column) -> Column:
            return F.length(part(i, 0)) + F.length(part(i, width - 1))

        def row(before: Column, i: Column) -> Column:
            end, hit = before + size(i), part(i, width - 1)
            if label is not None:
                hit = F.substr(hit, F.length(part(i, 1)) + 1)
            return F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit"))

        last = F.floor((F.size(parts) - 1) / width).cast("int") - 1
        return F.transform(_sums_before(F.transform(F.sequence(F.lit(0), last), size)), row)

    def cut(marked: Column) -> Column:
        # a gap, the label if there is one, the match, the next gap
        return F.when(F.contains(marked, F.lit(SPAN_MARK)), _let(F.split(marked, SPAN_MARK, -1), placed)).otherwise(nothing)

    made = F.when(F.contains(text, F.lit(SPAN_MARK)), _spans_apart(text, pattern, label)).otherwise(_let(marked, cut))
    return F.when(text.isNotNull(), made)


def _spans_apart(text: Column, pattern: str, label: int | None) -> Column:
    """``spans`` of a text that holds the mark: matches and what lies between them, each by a search of its own."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    labels = F.regexp_extract_all(text, F.lit(pattern), F.lit(label)) if label is not None else F.transform(hits, lambda _: F.lit(""))
    # the gap before a match and the match itself
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda gap, hit: F.length(gap) + F.length(hit))
    ends = F.zip_with(_sums_before(steps), steps, lambda before, step: before + step)
    cut = F.zip_with(hits, labels, lambda hit, name: F.substr(hit, F.length(name) + 1))
    return F.zip_with(ends, cut, lambda end, hit: F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit")))


def _spans_behind(text: Column, skipped: Column, pattern: str, label: int | None) -> Column:
    """``spans`` of what follows the first characters, places counted from the beginning."""
    found = spans(F.substr(text, skipped + 1), pattern, label)
    return F.transform(found, lambda s: F.struct((s["start"] + skipped).alias("start"), (s["end"] + skipped).alias("end"), s["hit"].alias("hit")))


def pii_spans(text: Column, kind: str, policy: Policy) -> Column:
    """K8: where data of a type stands, without the label before it."""
    if kind in SPAN_PATTERNS:
        return spans(text, SPAN_PATTERNS[kind])
    listed = {t: (p, to) for t, p, to in MASKS}
    if kind in policy.of_type("BLOCK") or kind not in listed:
        return spans(text, policy.found_by(kind))
    pattern, replacement = listed[kind]
    pattern, label = SPAN_STARTS.get(kind, pattern), 1 if replacement.startswith("$1") else None
    if kind in SPAN_SKIPS:
        sign, never = SPAN_SKIPS[kind]
        ahead = F.substring_index(text, sign, 1)
        found = _let(F.length(ahead) - F.length(F.substring_index(ahead, never, -1)), lambda n: _spans_behind(text, n, pattern, label))
    else:
        found = spans(text, pattern, label)
    return F.when(may_mask(text, kind), found).when(text.isNotNull(), F.array().cast("array<struct<start:int,end:int,hit:string>>"))


def word_spans(text: Column, words: tuple[str, ...]) -> Column:
    """K8: where one of the words stands as a whole term, in either case of A-Z."""
    either = "|".join(sorted(words, key=lambda w: (-len(w), w)))
    # most characters begin no word, which is told before what stands in front of them is looked at
    plain = all(w[:1].isascii() and w[:1].isalnum() for w in words)
    start = f"(?=[{''.join(sorted({w[0] for w in words}))}])" if plain else ""
    return spans(text, rf"(?i){start}(?<![\p{{L}}0-9])(?:{either})(?![\p{{L}}0-9])")


def sentence_pieces(text: Column) -> Column:
    """The text up to the end of its last sentence, cut after each sentence."""
    return F.regexp_extract_all(text, F.lit(PIECE_PATTERN), F.lit(0))


def may_be_near(sents: Column, policy: Policy) -> Column:
    """K2: the numbers of the sentences, as lists of terms, that may be about a denied topic.

    What a set of terms shares with an example is at most all of the set, so to
    reach the threshold it needs so many terms of the examples at least.
    """
    if policy.topic_model is not None:
        listed, least = [], 0
    else:
        examples = [set(plain_terms(e)) for _, _, examples in policy.topics for e in examples]
        listed = sorted(set().union(*examples))
        least = ceil(max(0.0, policy.topic_threshold) ** 2 * min(map(len, examples), default=0) - 1e-9)

    def near(s: Column) -> Column:
        shared = F.size(_among(s, tuple(listed))) >= least if least > 0 else F.lit(True)
        return (F.size(s) > 0) & shared

    return F.array_compact(F.transform(sents, lambda s, i: F.when(near(s), i)))


def piece_places(pieces: Column, numbers: Column) -> Column:
    """K8: where the sentences of the numbered pieces stand, blanks around them left out: ``array<struct<start, end>>``."""

    def place(piece: Column, before: Column) -> Column:
        def inside(right: Column) -> Column:
            end = before + F.length(right)
            return F.struct((end - F.length(F.ltrim(right, F.lit(".!?" + WHITESPACE)))).alias("start"), end.alias("end"))

        return _let(F.rtrim(piece, F.lit(WHITESPACE)), inside)

    def placed(sums: Column) -> Column:
        return F.transform(numbers, lambda i: place(F.get(pieces, i), F.get(sums, i)))

    nothing = F.array().cast("array<struct<start:int,end:int>>")
    return F.when(F.size(numbers) > 0, _let(_sums_before(F.transform(pieces, F.length)), placed)).otherwise(nothing)


def blocked_message(side: str, policy: Policy | None = None) -> Column:
    """K5"""
    _check_side(side)
    policy = policy or Policy()
    return F.lit(policy.blocked_input if side == "input" else policy.blocked_output)


def block_pii(text: Column, policy: Policy | None = None, side: str = "output") -> Column:
    """K4: a text with data of a BLOCK type is replaced as a whole."""
    return F.when(F.size(blocking_types(text, policy)) > 0, blocked_message(side, policy)).otherwise(text)


def _check_side(side: str) -> None:
    if side not in ("input", "output"):
        raise ValueError(f"side is input or output, not {side}")
