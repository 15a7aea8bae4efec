"""Model request payloads as JSON columns (P5-P10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Version tags, framing and default system prompts of the
# request formats. The run of blanks is part of the default prompts.
MESSAGES_VERSION = "bedrock-2023-05-31"
NOVA_SCHEMA = "messages-v1"
HUMAN = "\n\nHuman:"
ASSISTANT = "\n\nAssistant:"
MESSAGES_SYSTEM = (
    "You are Claude, an AI assistant created by Anthropic to be helpful, harmless,                  "
    "and honest. Your goal is to provide informative and substantive response to                  "
    "queries while avoiding potential harms."
)
NOVA_SYSTEM = (
    "You are Nova, an AI assistant created by Amazon to be helpful, harmless,              "
    "and honest. Your goal is to provide informative and substantive response to              "
    "queries while avoiding potential harms."
)

Value = Column | str | float | int | None


def _lit(value: Value, kind: str) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast(kind)


def _texts(text: Column) -> Column:
    return F.array(F.struct(text.alias("text")))


def _stops(stops: list[str] | None) -> Column:
    if not stops:
        return F.lit(None).cast("array<string>")
    return F.array(*[F.lit(s) for s in stops])


def payload_messages(
    prompt: Column, system: Value = None, temperature: Value = 0.2, max_tokens: Value = 512, top_p: Value = 0.9, top_k: Value = None
) -> Column:
    """P5: messages payload. ``top_p`` and ``top_k`` are accepted, not emitted."""
    block = F.struct(F.lit("text").alias("type"), prompt.alias("text"))
    return F.to_json(
        F.struct(
            F.lit(MESSAGES_VERSION).alias("anthropic_version"),
            _lit(temperature, "double").alias("temperature"),
            _lit(max_tokens, "int").alias("max_tokens"),
            F.array(F.struct(F.lit("user").alias("role"), F.array(block).alias("content"))).alias("messages"),
            F.coalesce(_lit(system, "string"), F.lit(MESSAGES_SYSTEM)).alias("system"),
        )
    )


def payload_completion(
    prompt: Column, temperature: Value = 0.2, top_p: Value = 0.9, top_k: Value = None, max_tokens_to_sample: Value = None
) -> Column:
    """Text-completion payload; unset values stay as JSON null."""
    return F.to_json(
        F.struct(
            F.concat(F.lit(HUMAN), prompt, F.lit(ASSISTANT)).alias("prompt"),
            _lit(temperature, "double").alias("temperature"),
            _lit(top_p, "double").alias("top_p"),
            _lit(top_k, "int").alias("top_k"),
            _lit(max_tokens_to_sample, "int").alias("max_tokens_to_sample"),
            F.array(F.lit(HUMAN)).alias("stop_sequences"),
        ),
        {"ignoreNullFields": "false"},
    )


def _inference(max_tokens: Value, temperature: Value, top_p: Value, stops: list[str] | None) -> Column:
    return F.struct(
        _lit(max_tokens, "int").alias("maxTokens"),
        _lit(temperature, "double").alias("temperature"),
        _lit(top_p, "double").alias("topP"),
        _stops(stops).alias("stopSequences"),
    )


def _user_message(prompt: Column) -> Column:
    return F.array(F.struct(F.lit("user").alias("role"), _texts(prompt).alias("content")))


def payload_nova(
    prompt: Column,
    system: Value = None,
    temperature: Value = 0.2,
    top_p: Value = 0.9,
    max_tokens: Value = 512,
    stop_sequences: list[str] | None = None,
) -> Column:
    """Stop sequences go where the format wants them, in ``inferenceConfig``."""
    return F.to_json(
        F.struct(
            F.lit(NOVA_SCHEMA).alias("schemaVersion"),
            _user_message(prompt).alias("messages"),
            _inference(max_tokens, temperature, top_p, stop_sequences).alias("inferenceConfig"),
            _texts(F.coalesce(_lit(system, "string"), F.lit(NOVA_SYSTEM))).alias("system"),
        )
    )


def _both(policy_id: Column, policy_version: Column) -> Column:
    return (F.length(policy_id) > 0) & (F.length(policy_version) > 0)


def payload_converse(
    model_id: Value,
    prompt: Column,
    system: Value = None,
    max_tokens: Value = 512,
    temperature: Value = 0.2,
    top_p: Value = 0.9,
    stop_sequences: list[str] | None = None,
    policy_id: Value = None,
    policy_version: Value = None,
    trace: bool = False,
) -> Column:
    """The policy block needs id and version; the trace flag sits inside it."""
    system, policy_id, policy_version = (_lit(v, "string") for v in (system, policy_id, policy_version))
    policy = F.struct(
        policy_id.alias("guardrailIdentifier"),
        policy_version.alias("guardrailVersion"),
        F.lit("enabled" if trace else None).cast("string").alias("trace"),
    )
    return F.to_json(
        F.struct(
            _lit(model_id, "string").alias("modelId"),
            _user_message(prompt).alias("messages"),
            _inference(max_tokens, temperature, top_p, stop_sequences).alias("inferenceConfig"),
            F.when(F.length(system) > 0, _texts(system)).alias("system"),
            F.when(_both(policy_id, policy_version), policy).alias("guardrailConfig"),
        )
    )


PAYLOAD_STYLES = {
    "messages_api": payload_messages,
    "text_completion_api": payload_completion,
    "nova": payload_nova,
}


def payload(style: str, prompt: Column, **options: Value) -> Column:
    """The payload of a named style; an unknown style is an error."""
    if style not in PAYLOAD_STYLES:
        raise ValueError(f"unknown payload style {style}")
    return PAYLOAD_STYLES[style](prompt, **options)


def with_policy(df: DataFrame, policy_id: Value, policy_version: Value) -> DataFrame:
    """Attach a policy to requests only when both parts are there."""
    pid, version = _lit(policy_id, "string"), _lit(policy_version, "string")
    both = _both(pid, version)
    return df.withColumn("policy_id", F.when(both, pid)).withColumn("policy_version", F.when(both, version))


def _number(raw: Column, kind: str, default: float) -> Column:
    parsed = F.trim(raw).try_cast(kind)
    malformed = F.raise_error(F.concat(F.lit(f"not a {kind}: "), raw)).cast(kind)
    return F.when(raw.isNull(), F.lit(default).cast(kind)).when(parsed.isNotNull(), parsed).otherwise(malformed)


def question_params(df: DataFrame, temperature: str = "temperature", max_tokens: str = "max_tokens") -> DataFrame:
    """P10: absent values get their default, malformed ones are an error."""
    return df.withColumn("temperature", _number(F.col(temperature).cast("string"), "double", 0.5)).withColumn(
        "max_tokens", _number(F.col(max_tokens).cast("string"), "int", 512)
    )
