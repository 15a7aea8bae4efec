from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paperloom.functions import fields, responses
from paperloom.operators import evaluation

CLAIM = """Claimant Name: Ana Ruiz
Phone Number: +1 614-555-0117
Policy Number: ZZ-10-7
License Plate: QWE 12
Incident Date: March 3, 2024
Claim Amount: $1,234.50
Incident Description: Hail dented the roof.

Coverage:
- Kind: Personal
- Injury: $10,000 per person / $30,000 per accident
- Collision: Deductible: $500
- Towing: Included
"""
POLICY = """Policy Number: P-1

---
SECTION 1: HOLDER
Name: Ana Ruiz

---
SECTION 2: COVERAGES
Liability Coverage:
  Bodily Injury: $10,000 per person / $30,000 per accident
  Property Damage: $9,000 per accident
Collision Coverage:
  Deductible: $500
"""


def test_extract_claim(value):
    got = value(fields.extract_claim(F.col("t")), "t string", CLAIM)
    assert got.asDict() == {
        "claimant": "Ana Ruiz",
        "patient": None,
        "signer": None,
        "policy_number": "ZZ-10-7",
        "claim_amount": Decimal("1234.50"),
        "incident_date": date(2024, 3, 3),
        "description": "Hail dented the roof.",
    }


def test_patient_only_if_different(value):
    same = value(fields.extract_claim(F.col("t")), "t string", CLAIM + "Patient Name: Ana Ruiz\r\n")
    other = value(fields.extract_claim(F.col("t")), "t string", CLAIM + "Patient Name:  Leo Ruiz \nSigned By:\n")
    assert same["patient"] is None and other["patient"] == "Leo Ruiz" and other["signer"] is None


@pytest.mark.parametrize(
    "text, want", [("2025-12-20", date(2025, 12, 20)), ("January 1, 2025", date(2025, 1, 1)), ("Foo 1, 2025", None), ("2025-02-30", None), ("", None)]
)
def test_parse_date(value, text, want):
    assert value(fields.parse_date(F.col("t")), "t string", text) == want


@pytest.mark.parametrize("text, want", [("$4,850.00", "4850.00"), ("40", "40.00"), ("none", None)])
def test_parse_money(value, text, want):
    got = value(fields.parse_money(F.col("t")), "t string", text)
    assert got == (Decimal(want) if want else None)


def test_coverage_rows(spark):
    docs = spark.createDataFrame([(1, CLAIM), (2, POLICY)], "doc_id long, text string")
    rows = [tuple(r) for r in fields.coverage_rows(docs).orderBy("doc_id", "pos").collect()]
    d = Decimal
    assert rows == [
        (1, 0, "Kind", None, None, None, None, "Personal"),
        (1, 1, "Injury", None, None, d(10000), d(30000), "$10,000 per person / $30,000 per accident"),
        (1, 2, "Collision", None, d(500), None, None, "Deductible: $500"),
        (1, 3, "Towing", None, None, None, None, "Included"),
        (2, 0, "Liability Coverage", "Bodily Injury", None, d(10000), d(30000), "$10,000 per person / $30,000 per accident"),
        (2, 1, "Liability Coverage", "Property Damage", None, None, d(9000), "$9,000 per accident"),
        (2, 2, "Collision Coverage", "Deductible", d(500), None, None, "$500"),
    ]


def test_policy_sections(spark):
    numbered = "MOTOR POLICY\n1. Contents Page\n\n1. FIRST PART\nBody “one”.\n2. SECOND – PART\nBody two."
    docs = spark.createDataFrame([(1, POLICY), (2, numbered), (3, "1. ONLY\n")], "doc_id long, text string")
    rows = [tuple(r) for r in fields.policy_sections(docs).orderBy("doc_id", "section_idx").collect()]
    assert [r[:3] for r in rows] == [
        (1, 0, None),
        (1, 1, "SECTION 1: HOLDER"),
        (1, 2, "SECTION 2: COVERAGES"),
        (2, 0, None),
        (2, 1, "1. FIRST PART"),
        (2, 2, "2. SECOND – PART"),
        (3, 1, "1. ONLY"),
    ]
    assert rows[0][3] == "Policy Number: P-1" and rows[1][3] == "Name: Ana Ruiz" and rows[4][3] == "Body “one”."


def test_summary_leaves_out_missing(value):
    assert value(fields.summarise_fields(fields.extract_claim(F.lit("Claimant Name: A B")))) == "Claim by A B."


@pytest.mark.parametrize(
    "body, text", [('{"content": [{"text": "a\\n"}, {"text": "b"}]}', "a\n"), ('{"content": []}', None), ("oops", None), (None, None)]
)
def test_first_text(value, body, text):
    assert value(responses.first_text(F.col("b")), "b string", body) == text


@pytest.mark.parametrize(
    "answer, score, wrong",
    [
        ("Score: 0.85\n- date is off\n* name", 0.85, ["date is off", "name"]),
        ("The accuracy score (0-1) is: 1", 1.0, []),
        ("score = 1.5", None, []),
        ("1. Score: 0.7\n2. Inaccuracies:\n1. date is off\n 12) name", 0.7, ["date is off", "name"]),
        ("Score: 1\n2024.5 is no point\n3.scores are no list\n- the score was misquoted: 5", 1.0, ["the score was misquoted: 5"]),
        ("no verdict", None, []),
    ],
)
def test_parse_accuracy(value, answer, score, wrong):
    assert tuple(value(responses.parse_accuracy(F.col("a")), "a string", answer)) == (score, wrong)


def test_parse_quality(value):
    answer = 'Sure: {"Clarity": 4, "Professional Tone": {"score": "2", "why": "flat"}, "overall": 7, "humour": 1, "conciseness": -1} done'
    got = value(responses.parse_quality(F.col("a")), "a string", answer)
    assert {k: tuple(v) for k, v in got.items()} == {"clarity": (4.0, None), "tone": (2.0, "flat")}
    twice = value(responses.parse_quality(F.col("a")), "a string", '{"overall": 1, "overall_score": 2}')
    assert {k: v["score"] for k, v in twice.items()} == {"overall": 1.0}
    assert value(responses.parse_quality(F.col("a")), "a string", "no json") is None


def test_grounding(spark):
    rows = [
        (1, CLAIM, "Policy ZZ-10-7, $1234.50 on 2024-03-03."),
        (2, CLAIM, "Policy ZZ-10-8 for $1,234.50."),
        (3, CLAIM, "Nothing to check."),
    ]
    df = evaluation.grounding(spark.createDataFrame(rows, "doc_id long, text string, summary string")).orderBy("doc_id")
    assert [(r["score"], r["inaccuracies"]) for r in df.collect()] == [(1.0, []), (0.5, ["ZZ-10-8"]), (1.0, [])]


def test_quality_scores_stay_in_range(value):
    long = "word " * 70 + "."
    got = value(evaluation.quality_scores(F.lit("x" * 10), F.lit(long), F.lit(0), 7))
    assert got["completeness"] == 1.0 and got["conciseness"] == 1.0 and got["clarity"] == 1.0
    best = value(evaluation.quality_scores(F.lit("x" * 1000), F.lit("Short."), F.lit(7), 7))
    assert best["completeness"] == 5.0 and best["clarity"] == 5.0


def test_a_quality_answer_is_read_once(spark):
    """However many metrics it names; a text under a metric has its reasons, a number none."""
    rows = spark.createDataFrame([('{"Tone": " {\\"score\\": 3, \\"why\\": \\"x\\"}", "clarity": 4, "professional tone": 1, "overall": {"score": 2, "justification": "y"}}',), (None,)], "a string")
    read = rows.select(responses.parse_quality(F.col("a")).alias("q"))
    assert [r["q"] and {k: tuple(v) for k, v in r["q"].items()} for r in read.collect()] == [{"tone": (3.0, "x"), "clarity": (4.0, None), "overall": (2.0, "y")}, None]
    assert read._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
