"""Reading model responses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.policy import _let

# Metrics of both quality prompts, with the names models give them.
METRICS = {
    "clarity": "clarity",
    "completeness": "completeness",
    "organization": "organization",
    "conciseness": "conciseness",
    "tone": "tone",
    "professional_tone": "tone",
    "overall": "overall",
    "overall_quality": "overall",
    "overall_score": "overall",
}
MAX_METRIC = 5.0
SCORE_PATTERN = r"(?i)score[^:=\n]*[:=][ \t]*(-?[0-9]*\.?[0-9]+)"
# bullets and numbered lines, but not those that name the score or head the list
BULLET_PATTERN = r"(?mi)^[ \t]*(?:[-*]|[0-9]{1,3}[.)])[ \t]+(?!(?:accuracy )?score\b[^:=\n]*[:=]|(?:any |specific )?inaccuracies\b[^:\n]*:)([^\n]+)"


def first_text(body: Column) -> Column:
    """``content[0].text``; null when the body is no such JSON."""
    return F.get_json_object(body, "$.content[0].text")


def completion_text(body: Column) -> Column:
    """The older ``completion`` field."""
    return F.get_json_object(body, "$.completion")


def parse_accuracy(answer: Column) -> Column:
    """``struct<score, inaccuracies>``; a score outside 0-1 is null.

    Inaccuracies are the bulleted and the numbered lines; a numbered score or
    heading is none.
    """
    score = F.nullif(F.regexp_extract(answer, SCORE_PATTERN, 1), F.lit("")).try_cast("double")
    return F.struct(
        F.when(score.between(0.0, 1.0), score).alias("score"),
        F.regexp_extract_all(answer, F.lit(BULLET_PATTERN), F.lit(1)).alias("inaccuracies"),
    )


def parse_quality(answer: Column) -> Column:
    """``map<metric, struct<score, why>>`` of the known metrics within 0-5.

    The JSON object is cut out of the surrounding prose first; a metric may be
    a bare number or an object with a score and a justification.
    """
    raw = F.from_json(F.regexp_extract(answer, r"(?s)(\{.*\})", 1), "map<string,string>")
    names = F.create_map(*[F.lit(x) for pair in METRICS.items() for x in pair])

    def entry(e: Column) -> Column:
        value = e["value"]
        score = F.coalesce(value.try_cast("double"), F.get_json_object(value, "$.score").try_cast("double"))
        # a bare number is not parsed once more
        why = F.when(F.contains(value, F.lit("{")), F.coalesce(F.get_json_object(value, "$.justification"), F.get_json_object(value, "$.why")))
        name = F.element_at(names, F.replace(F.lower(F.trim(e["key"])), F.lit(" "), F.lit("_")))
        return F.struct(name.alias("key"), F.struct(score.alias("score"), why.alias("why")).alias("value"))

    entries = F.filter(
        F.transform(F.map_entries(raw), entry),
        lambda e: e["key"].isNotNull() & e["value"]["score"].between(0.0, MAX_METRIC),
    )

    def firsts(found: Column, keys: Column) -> Column:
        # two spellings of one metric: the first one stands
        return F.map_from_entries(F.filter(found, lambda e, i: F.array_position(keys, e["key"]) == i + 1))

    # inside a function of elements the answer would be read anew for each
    return _let(entries, lambda found: _let(F.transform(found, lambda e: e["key"]), lambda keys: firsts(found, keys)))
