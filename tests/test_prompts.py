import json

import pytest
from pyspark.sql import functions as F

from paperloom.functions import payloads, prompts


def test_unknown_or_empty_template():
    with pytest.raises(prompts.UnknownTemplate, match="nothing"):
        prompts.get_template("nothing")
    with pytest.raises(prompts.UnknownTemplate):
        prompts.get_template("e", {"e": ""})


def test_template_text_fails_per_row(value):
    assert value(prompts.template_text(F.col("n")), "n string", "generate_summary") == prompts.TEMPLATES["generate_summary"]
    with pytest.raises(Exception, match="no template is named x"):
        value(prompts.template_text(F.col("n")), "n string", "x")


def test_render_is_single_pass(value):
    column = prompts.render("{{a}} {a} {b}", a=F.col("a"), b=F.col("b"), extra=F.lit(1))
    assert value(column, "a string, b string", "{b}", "{a}{") == "{a} {b} {a}{"


def test_render_matches_python_format(value):
    for name, template in prompts.TEMPLATES.items():
        words = {w: f"<{w}>" for w in ("document_text", "extracted_text", "extracted_info", "claim_text", "summary_text")}
        column = prompts.render(template, **{k: F.lit(v) for k, v in words.items()})
        assert value(column) == template.format(**words), name


def test_render_missing_and_null(value):
    with pytest.raises(KeyError):
        prompts.render("{a}", b=F.lit(1))
    with pytest.raises(ValueError):
        prompts.render("{a:>3}", a=F.lit(1))
    assert value(prompts.render("x {a}", a=F.col("a")), "a string", None) is None


def _json(value, column):
    return json.loads(value(column))


def test_payload_messages(value):
    got = _json(value, payloads.payload_messages(F.lit("hi"), top_k=3))
    assert got == {
        "anthropic_version": "bedrock-2023-05-31",
        "temperature": 0.2,
        "max_tokens": 512,
        "messages": [{"role": "user", "content": [{"type": "text", "text": "hi"}]}],
        "system": payloads.MESSAGES_SYSTEM,
    }
    assert _json(value, payloads.payload_messages(F.lit("hi"), "", 0.0, 9))["system"] == ""


def test_payload_completion_keeps_nulls(value):
    got = _json(value, payloads.payload_completion(F.lit("hi")))
    assert got == {
        "prompt": "\n\nHuman:hi\n\nAssistant:",
        "temperature": 0.2,
        "top_p": 0.9,
        "top_k": None,
        "max_tokens_to_sample": None,
        "stop_sequences": ["\n\nHuman:"],
    }


def test_payload_nova(value):
    got = _json(value, payloads.payload_nova(F.lit("hi"), "sys", stop_sequences=["X"]))
    assert got["inferenceConfig"] == {"maxTokens": 512, "temperature": 0.2, "topP": 0.9, "stopSequences": ["X"]}
    assert got["system"] == [{"text": "sys"}] and got["schemaVersion"] == "messages-v1"
    assert "stopSequences" not in _json(value, payloads.payload_nova(F.lit("hi")))["inferenceConfig"]


@pytest.mark.parametrize(
    "pid, version, trace, block",
    [
        ("g", "1", True, {"guardrailIdentifier": "g", "guardrailVersion": "1", "trace": "enabled"}),
        ("g", "1", False, {"guardrailIdentifier": "g", "guardrailVersion": "1"}),
        ("g", None, True, None),
        ("", "1", True, None),
    ],
)
def test_payload_converse(value, pid, version, trace, block):
    got = _json(value, payloads.payload_converse("m", F.lit("hi"), policy_id=pid, policy_version=version, trace=trace))
    assert got.get("guardrailConfig") == block
    assert got["modelId"] == "m" and "system" not in got


def test_unknown_payload_style():
    with pytest.raises(ValueError, match="unknown payload style"):
        payloads.payload("none", F.lit("x"))


def test_with_policy_needs_both(spark):
    rows = spark.createDataFrame([("a", "1"), ("a", ""), (None, "1")], "i string, v string")
    got = payloads.with_policy(rows, F.col("i"), F.col("v")).select("policy_id", "policy_version").collect()
    assert [tuple(r) for r in got] == [("a", "1"), (None, None), (None, None)]


def test_question_params(spark):
    rows = spark.createDataFrame([(None, None), (" 0.25 ", "64")], "temperature string, max_tokens string")
    assert [tuple(r) for r in payloads.question_params(rows).collect()] == [(0.5, 512), (0.25, 64)]
    for bad in [("warm", "1"), ("0.1", "1.5")]:
        with pytest.raises(Exception, match="not a"):
            payloads.question_params(spark.createDataFrame([bad], rows.schema)).collect()
