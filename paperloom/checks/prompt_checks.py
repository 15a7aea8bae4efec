"""Prompts and payloads (P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.checks.base import check, claims, documents, table, CLAIMS_SQL
from paperloom.functions import payloads, prompts
from paperloom.functions.fields import extract_claim, summarise_fields


def _md5(c):
    return F.md5(c.cast("binary"))


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_render(template: str, **values: str) -> str:
    """The SQL concatenation of a template whose placeholders are columns."""
    out = _sql(template)
    for name, column in values.items():
        out = out.replace("{" + name + "}", f"' || {column} || '")
    return out


@check(
    "p1_get_template",
    f"""SELECT item_id, CASE item_id % 3 WHEN 0 THEN md5({_sql(prompts.TEMPLATES['extract_info'])})
    WHEN 1 THEN md5({_sql(prompts.TEMPLATES['generate_summary'])}) END AS template_md5 FROM benchmark""",
)
def p1(spark, sf):
    kind = F.col("item_id") % 3
    name = F.when(kind == 0, "extract_info").when(kind == 1, "generate_summary").otherwise("no_such_template")
    return table(spark, sf, "benchmark").select("item_id", _md5(prompts.template_text(name, fail=False)).alias("template_md5"))


@check(
    "p2_render",
    "SELECT doc_id, md5('{' || lang || '} ' || '{lang}' || text || ' of ' || source || '.') AS prompt_md5 FROM documents",
)
def p2(spark, sf):
    rendered = prompts.render(
        "{{{lang}}} {body} of {source}.",
        lang=F.col("lang"),
        body=F.concat(F.lit("{lang}"), "text"),
        source=F.col("source"),
        unused=F.lit("x"),
    )
    return documents(spark, sf, "lang", "source").select("doc_id", _md5(rendered).alias("prompt_md5"))


@check(
    "p3_extraction_prompt",
    f"""SELECT doc_id, md5({_sql_render(prompts.TEMPLATES['extract_info'], document_text='text')}) AS prompt_md5,
    md5({_sql_render(prompts.TEMPLATES['extract_info_five'], document_text='text')}) AS older_md5 FROM documents""",
)
def p3(spark, sf):
    text = F.col("text")
    return documents(spark, sf).select(
        "doc_id", _md5(prompts.extraction_prompt(text)).alias("prompt_md5"), _md5(prompts.extraction_prompt(text, older=True)).alias("older_md5")
    )


@check(
    "p4_summary_prompt",
    f"""SELECT doc_id, md5({_sql_render(prompts.TEMPLATES['generate_summary'], extracted_text='text')}) AS prompt_md5,
    md5({_sql_render(prompts.TEMPLATES['generate_summary_five'], extracted_info='text')}) AS older_md5 FROM documents""",
)
def p4(spark, sf):
    text = F.col("text")
    return documents(spark, sf).select(
        "doc_id", _md5(prompts.summary_prompt(text)).alias("prompt_md5"), _md5(prompts.summary_prompt(text, older=True)).alias("older_md5")
    )


def _turns(spark, sf):
    return table(spark, sf, "conversations")


def _md5_sql(expr: str) -> str:
    return f"SELECT conv_id, turn, md5(({expr})::VARCHAR) AS payload_md5 FROM conversations"


def _payload(df, column):
    return df.select("conv_id", "turn", _md5(column).alias("payload_md5"))


@check(
    "p5_payload_messages",
    _md5_sql(
        f"""json_object('anthropic_version', {_sql(payloads.MESSAGES_VERSION)}, 'temperature', 0.2::DOUBLE, 'max_tokens', 512,
        'messages', json_array(json_object('role', 'user', 'content', json_array(json_object('type', 'text', 'text', text)))),
        'system', CASE WHEN role = 'system' THEN 'Be brief.' ELSE {_sql(payloads.MESSAGES_SYSTEM)} END)"""
    ),
)
def p5(spark, sf):
    system = F.when(F.col("role") == "system", "Be brief.")
    return _payload(_turns(spark, sf), payloads.payload_messages(F.col("text"), system, top_k=5))


@check(
    "p6_payload_completion",
    _md5_sql(
        """json_object('prompt', chr(10) || chr(10) || 'Human:' || text || chr(10) || chr(10) || 'Assistant:', 'temperature', 0.2::DOUBLE,
        'top_p', 0.9::DOUBLE, 'top_k', NULL, 'max_tokens_to_sample', NULL, 'stop_sequences', json_array(chr(10) || chr(10) || 'Human:'))"""
    ),
)
def p6(spark, sf):
    return _payload(_turns(spark, sf), payloads.payload("text_completion_api", F.col("text")))


@check(
    "p7_payload_nova",
    _md5_sql(
        f"""json_object('schemaVersion', {_sql(payloads.NOVA_SCHEMA)},
        'messages', json_array(json_object('role', 'user', 'content', json_array(json_object('text', text)))),
        'inferenceConfig', json_object('maxTokens', 512, 'temperature', 0.2::DOUBLE, 'topP', 0.9::DOUBLE, 'stopSequences', json_array('END')),
        'system', json_array(json_object('text', {_sql(payloads.NOVA_SYSTEM)})))"""
    ),
)
def p7(spark, sf):
    return _payload(_turns(spark, sf), payloads.payload_nova(F.col("text"), stop_sequences=["END"]))


_CONVERSE = """json_object('modelId', 'model-a', 'messages', json_array(json_object('role', 'user', 'content', json_array(json_object('text', text)))),
 'inferenceConfig', json_object('maxTokens', 512, 'temperature', 0.2::DOUBLE, 'topP', 0.9::DOUBLE)"""
_GUARD = "'guardrailConfig', json_object('guardrailIdentifier', 'gr-1', 'guardrailVersion', '7', 'trace', 'enabled')"
_SYSTEM = "'system', json_array(json_object('text', 'Be brief.'))"


@check(
    "p8_payload_converse",
    _md5_sql(
        f"""CASE WHEN role = 'system' AND turn % 2 = 0 THEN {_CONVERSE}, {_SYSTEM}, {_GUARD})
        WHEN role = 'system' THEN {_CONVERSE}, {_SYSTEM}) WHEN turn % 2 = 0 THEN {_CONVERSE}, {_GUARD}) ELSE {_CONVERSE}) END"""
    ),
)
def p8(spark, sf):
    version = F.when(F.col("turn") % 2 == 0, "7").otherwise("")
    system = F.when(F.col("role") == "system", "Be brief.").otherwise("")
    column = payloads.payload_converse("model-a", F.col("text"), system, policy_id="gr-1", policy_version=version, trace=True)
    return _payload(_turns(spark, sf), column)


@check(
    "p9_with_policy",
    """SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN role END AS policy_id, CASE WHEN turn % 3 = 0 THEN '3' END AS policy_version
    FROM conversations""",
)
def p9(spark, sf):
    version = F.when(F.col("turn") % 3 == 0, "3").when(F.col("turn") % 3 == 1, "")
    return payloads.with_policy(_turns(spark, sf), F.col("role"), version).select("conv_id", "turn", "policy_id", "policy_version")


@check(
    "p10_question_params",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0.5 ELSE (props->>'k')::DOUBLE / 100 END AS temperature,
    CASE WHEN event_id % 2 = 0 THEN 512 ELSE (props->>'k')::INT END AS max_tokens FROM events""",
)
def p10(spark, sf):
    k = F.get_json_object("props", "$.k")
    raw = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 3 != 0, (k.cast("double") / 100).cast("string")).alias("temperature"),
        F.when(F.col("event_id") % 2 != 0, k).alias("max_tokens"),
    )
    return payloads.question_params(raw)


_SUMMARY = """'Claim by ' || regexp_extract(text, 'Claimant Name: ([^\\n]+)', 1) || ', ' ||
 CASE WHEN doc_id % 2 = 1 THEN 'for patient ' || regexp_extract(text, 'Patient Name: ([^\\n]+)', 1) || ', ' ELSE '' END ||
 'under policy QX-' || doc_id || ', for $' || replace(regexp_extract(text, 'Claim Amount: .([^\\n]+)', 1), ',', '') ||
 ', incident on ' || strftime(day, '%Y-%m-%d') || ', ' || regexp_extract(text, 'Description: ([^\\n]+)', 1) || '.'"""
SUMMARIES_SQL = f"summaries AS (SELECT doc_id, text, {_SUMMARY} AS summary FROM (SELECT c.*, o_orderdate AS day FROM claims c JOIN orders ON doc_id = o_orderkey))"


def summaries(spark, sf):
    return claims(spark, sf).withColumn("_c", extract_claim(F.col("text"))).select("doc_id", "text", "_c", summarise_fields(F.col("_c")).alias("summary"))


@check(
    "p11_accuracy_prompt",
    f"""WITH {CLAIMS_SQL}, {SUMMARIES_SQL} SELECT doc_id,
    md5({_sql_render(prompts.TEMPLATES['judge_accuracy'], claim_text='text', summary_text='summary')}) AS prompt_md5 FROM summaries""",
)
def p11(spark, sf):
    return summaries(spark, sf).select("doc_id", _md5(prompts.accuracy_prompt(F.col("text"), F.col("summary"))).alias("prompt_md5"))


@check(
    "p12_quality_prompt",
    f"""WITH {CLAIMS_SQL}, {SUMMARIES_SQL} SELECT doc_id,
    md5({_sql_render(prompts.TEMPLATES['judge_quality'], summary_text='summary')}) AS prompt_md5 FROM summaries""",
)
def p12(spark, sf):
    return summaries(spark, sf).select("doc_id", _md5(prompts.quality_prompt(F.col("summary"))).alias("prompt_md5"))


@check("m4_summarise_fields", f"WITH {CLAIMS_SQL}, {SUMMARIES_SQL} SELECT doc_id, summary FROM summaries")
def m4(spark, sf):
    return summaries(spark, sf).select("doc_id", "summary")
