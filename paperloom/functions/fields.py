"""Typed facts out of claim and policy texts (X3-X6, M4). All row-local."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels of the claim form lines, in form order.
CLAIM_LABELS = {
    "claimant": "Claimant Name",
    "patient": "Patient Name",
    "signer": "Signed By",
    "policy_number": "Policy Number",
    "claim_amount": "Claim Amount",
    "incident_date": "Incident Date",
    "description": "Incident Description",
}
MONEY_PATTERN = r"\$?([0-9][0-9,]*(\.[0-9]+)?)"
ISO_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
WRITTEN_DATE = r"([A-Z][a-z]+) ([0-9]{1,2}),? ([0-9]{4})"
# Month names of written dates, in order.
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
SECTION_HEADING = r"(SECTION [0-9]+: [^\n]+|[0-9]+\. [A-Z][A-Z0-9 ,/&–-]+)"


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, or null; evaluates ``text`` once."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(1))


def labelled(text: Column, label: str) -> Column:
    """The rest of the first line starting with ``label:``, or null."""
    return first_match(text, rf"(?m)^[ \t]*{label}:[ \t]*([^\n]*\S)")


def parse_money(text: Column) -> Column:
    """``$4,850.00`` as decimal(18,2)."""
    return F.replace(F.regexp_extract(text, MONEY_PATTERN, 1), F.lit(","), F.lit("")).try_cast("decimal(18,2)")


def written_date(text: Column) -> Column:
    """``January 1, 2025`` (comma optional) as a date, or null."""
    numbers = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (m, f"{i:02d}")])
    month = F.try_element_at(numbers, F.regexp_extract(text, WRITTEN_DATE, 1))
    day = F.lpad(F.regexp_extract(text, WRITTEN_DATE, 2), 2, "0")
    return F.concat(F.regexp_extract(text, WRITTEN_DATE, 3), F.lit("-"), month, F.lit("-"), day).try_cast("date")


def parse_date(text: Column) -> Column:
    """``2025-12-20`` or ``January 1, 2025`` as a date."""
    return F.coalesce(F.regexp_extract(text, ISO_DATE, 0).try_cast("date"), written_date(text))


def phone_digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def extract_claim(text: Column) -> Column:
    """The seven facts of a claim form as one typed struct.

    The patient is given only when different from the claimant.
    """
    raw = {name: labelled(text, label) for name, label in CLAIM_LABELS.items()}
    return F.struct(
        raw["claimant"].alias("claimant"),
        F.nullif(raw["patient"], raw["claimant"]).alias("patient"),
        raw["signer"].alias("signer"),
        raw["policy_number"].alias("policy_number"),
        parse_money(raw["claim_amount"]).alias("claim_amount"),
        parse_date(raw["incident_date"]).alias("incident_date"),
        raw["description"].alias("description"),
    )


def summarise_fields(claim: Column) -> Column:
    """M4: one sentence of lead facts; facts not found are left out."""
    return F.concat(
        F.concat_ws(
            ", ",
            F.concat(F.lit("Claim by "), claim["claimant"]),
            F.concat(F.lit("for patient "), claim["patient"]),
            F.concat(F.lit("under policy "), claim["policy_number"]),
            F.concat(F.lit("for $"), claim["claim_amount"].cast("string")),
            F.concat(F.lit("incident on "), claim["incident_date"].cast("string")),
            claim["description"],
        ),
        F.lit("."),
    )


def _money_before(value: Column, words: str) -> Column:
    return parse_money(F.regexp_extract(value, rf"(\$[0-9][0-9,]*(\.[0-9]+)?) {words}", 1))


def coverage_rows(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per coverage line.

    Two layouts: ``- Coverage: value`` bullets, and ``Coverage:`` headings
    followed by indented ``Item: value`` lines.
    """
    no_item = F.lit(None).cast("string")
    bullets = F.transform(
        F.regexp_extract_all(text, F.lit(r"(?m)^- ([^:\n]+: [^\n]+)"), F.lit(1)),
        lambda line: F.struct(no_item.alias("head"), line.alias("line")),
    )
    blocks = F.regexp_extract_all(text, F.lit(r"(?m)^([A-Z][^:\n]*:\n(?:[ \t]+[^\n]+\n?)+)"), F.lit(1))
    nested = F.flatten(
        F.transform(
            blocks,
            lambda block: F.transform(
                F.regexp_extract_all(block, F.lit(r"\n[ \t]+([^:\n]+: [^\n]+)"), F.lit(1)),
                lambda line: F.struct(F.substring_index(block, ":", 1).alias("head"), line.alias("line")),
            ),
        )
    )
    label, note = F.substring_index("line", ":", 1), F.regexp_extract("line", r"^[^:]+:[ ]*(.+)$", 1)
    rows = df.select(doc, F.posexplode(F.concat(bullets, nested)).alias("pos", "_c")).select(doc, "pos", "_c.*")
    return rows.select(
        doc,
        "pos",
        F.coalesce("head", label).alias("coverage"),
        F.when(F.col("head").isNotNull(), label).alias("item"),
        parse_money(F.regexp_extract("line", r"Deductible: (\$[0-9][0-9,]*(\.[0-9]+)?)", 1)).alias("deductible"),
        _money_before(F.col("line"), "per person").alias("per_person"),
        _money_before(F.col("line"), "per accident").alias("per_accident"),
        note.alias("note"),
    )


def policy_sections(df: DataFrame, heading: str = SECTION_HEADING, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(section_idx, title, body)``; what stands before the first heading
    is section 0 without title. ``heading`` matches one whole heading line."""
    title = rf"^({heading})(?:\n|$)"
    pieces = F.split(F.col(text), rf"(?m)^(?=(?:{heading})$)")
    # a text starting with a heading has no section 0
    first = F.when(F.regexp_like(F.col(text), F.lit(title)), 1).otherwise(0)
    body = F.regexp_replace(F.regexp_replace("_piece", title, ""), r"(?m)^---$", "")
    return (
        df.select(doc, first.alias("_first"), F.posexplode(F.filter(pieces, lambda p: p != "")).alias("_i", "_piece"))
        .select(
            doc,
            (F.col("_i") + F.col("_first")).alias("section_idx"),
            F.nullif(F.regexp_extract("_piece", title, 1), F.lit("")).alias("title"),
            F.trim(body, F.lit(" \t\r\n")).alias("body"),
        )
    )
