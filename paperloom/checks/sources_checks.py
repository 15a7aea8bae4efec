"""Sources, typing, decoding, field extraction (S, T, X)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.checks.base import CLAIMS_SQL, PAIRS_SQL, check, claims, documents, pairs, table, write_files
from paperloom.functions.fields import coverage_rows, extract_claim, labelled, parse_date, parse_money, phone_digits, policy_sections
from paperloom.functions.prompts import render
from paperloom.functions.responses import completion_text, first_text, parse_accuracy, parse_quality
from paperloom.functions.text import WHITESPACE, flatten_json, strip
from paperloom.sources import feedback as feedback_log
from paperloom.sources import objects
from paperloom.staging import stage_path

TRIMMED = f"trim(text, '{WHITESPACE}')"


def _text_files(spark: SparkSession, df: DataFrame, column: str) -> str:
    path = stage_path(spark, "files")
    df.select(F.col(column).alias("value")).write.text(path)
    return path


def _named_files(spark: SparkSession, df: DataFrame, key: str, column: str) -> str:
    """Each row as a text file, in a folder named by its key."""
    path = stage_path(spark, "files")
    write_files(df.select(key, F.col(column).alias("value")), key, path)
    return path


def _key_in(path: str, key: str):
    return F.regexp_extract(path, f"{key}=(-?[0-9]+)", 1).cast("long").alias(key)


@check("s1_read_objects", "SELECT page_id, (strlen(html) + 1)::BIGINT AS length, md5(html || chr(10)) AS content_md5 FROM pages")
def s1(spark, sf):
    path = _named_files(spark, table(spark, sf, "pages"), "page_id", "html")
    return objects.read_objects(spark, path, "*.txt").select(_key_in("key", "page_id"), "length", F.md5("content").alias("content_md5"))


@check("s2_list_keys", "SELECT page_id, url FROM pages WHERE starts_with(url, 'https://')")
def s2(spark, sf):
    return objects.list_keys(table(spark, sf, "pages").select("page_id", "url"), "https://", "url")


@check("s2_listing_notice", "SELECT 0::BIGINT AS n_keys, 'Content is empty' AS notice FROM pages WHERE starts_with(url, 'nowhere/') HAVING count(*) = 0")
def s2_notice(spark, sf):
    return objects.listing_notice(objects.list_keys(table(spark, sf, "pages"), "nowhere/", "url"))


@check(
    "s3_include_prefixes",
    "SELECT doc_id, source, md5(text) AS text_md5 FROM documents WHERE starts_with(source, 'src1') OR starts_with(source, 'src2')",
)
def s3(spark, sf):
    kept = objects.include_prefixes(table(spark, sf, "documents"), ["src1", "src2"], "source")
    return kept.select("doc_id", "source", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@check(
    "s4_land_files",
    """SELECT 'pages' AS prefix, page_id, (strlen(html) + 1)::BIGINT AS length, md5(html || chr(10)) AS content_md5,
    true AS keyed, count(*) OVER () AS n_keys FROM pages""",
)
def s4(spark, sf):
    """Files of one name in many folders keep keys of their own."""
    landed = stage_path(spark, "landed")
    objects.land_files(spark, _named_files(spark, table(spark, sf, "pages"), "page_id", "html"), landed, "pages/")
    found = spark.read.parquet(landed)
    n_keys = found.select("key").distinct().agg(F.count("*").alias("n_keys"))
    keyed = F.col("key").rlike("^pages/page_id=[0-9]+/part-").alias("keyed")
    return found.select("prefix", _key_in("key", "page_id"), "length", F.md5("content").alias("content_md5"), keyed).join(F.broadcast(n_keys), how="cross")


@check(
    "s5_default_key",
    "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'landing/' || page_id ELSE url END AS key FROM pages WHERE starts_with(url, 'https://')",
)
def s5(spark, sf):
    files = table(spark, sf, "pages").select(
        "page_id",
        F.col("url").alias("file_name"),
        F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("landing/"), "page_id")).alias("key"),
        F.when(F.col("url").startswith("https://"), F.col("html").cast("binary")).alias("content"),
    )
    uploaded, _ = objects.upload_outcome(files)
    return uploaded.select("page_id", "key")


@check(
    "s6_append_feedback",
    f"""WITH {PAIRS_SQL} SELECT md5(question) AS question_md5, md5(answer) AS answer_md5,
    CASE WHEN turn % 2 = 0 THEN 'up' ELSE 'down' END AS rating, count(*) * 2 AS n FROM pairs GROUP BY ALL""",
)
def s6(spark, sf):
    path = stage_path(spark, "feedback")
    clicks = pairs(spark, sf).withColumn("rating", F.when(F.col("turn") % 2 == 0, "up").otherwise("down"))
    feedback_log.append_feedback(clicks, path)
    feedback_log.append_feedback(clicks, path)
    log = feedback_log.read_feedback(spark, path)
    return log.groupBy(
        F.md5(F.col("question").cast("binary")).alias("question_md5"), F.md5(F.col("answer").cast("binary")).alias("answer_md5"), "rating"
    ).agg(F.count("*").alias("n"))


@check(
    "s7_read_feedback",
    f"""WITH {PAIRS_SQL} SELECT CASE WHEN turn % 2 = 0 THEN md5(question) END AS question_md5,
    CASE WHEN turn % 2 = 0 THEN 'up' END AS rating, turn % 2 <> 0 AS corrupt FROM pairs""",
)
def s7(spark, sf):
    line = F.to_json(F.struct("question", "answer", F.lit("up").alias("rating")))
    # every second line is cut short and ends inside the rating
    lines = pairs(spark, sf).select(F.when(F.col("turn") % 2 == 0, line).otherwise(F.substring(line, F.lit(1), F.length(line) - 4)).alias("value"))
    path = stage_path(spark, "lines")
    lines.write.text(path)
    log = feedback_log.read_feedback(spark, path)
    return log.select(
        F.md5(F.col("question").cast("binary")).alias("question_md5"), "rating", F.col("_corrupt").isNotNull().alias("corrupt")
    )


@check("s8_plain_text_whole", "SELECT doc_id, md5(text || chr(10)) AS text_md5, (length(text) + 1)::BIGINT AS n_chars, NULL::VARCHAR AS error FROM documents")
def s8(spark, sf):
    path = _named_files(spark, documents(spark, sf), "doc_id", "text")
    found = objects.read_objects(spark, path, "*.txt").withColumn("content_type", F.lit(None).cast("string"))
    texts = objects.document_texts(found, mode="PERMISSIVE")
    return texts.select(_key_in("key", "doc_id"), F.md5(F.col("text").cast("binary")).alias("text_md5"), F.length("text").cast("long").alias("n_chars"), "error")


@check(
    "s9_binary_text",
    f"""SELECT doc_id::VARCHAR AS key, CASE WHEN doc_id % 7 <> 0 THEN md5({TRIMMED}) END AS text_md5,
    CASE WHEN doc_id % 7 = 0 THEN 'Failed to extract document content from ' || doc_id || ': Failed to open PDF document: ' || doc_id END AS error
    FROM documents""",
)
def s9(spark, sf):
    def pages(raw: bytes) -> list[str]:
        if raw.startswith(b"\x00"):
            raise ValueError("not a document")
        return raw.decode("utf-8").split("\n")

    broken = F.when(F.col("doc_id") % 7 == 0, F.unhex(F.lit("00"))).otherwise(F.lit("").cast("binary"))
    files = documents(spark, sf).select(F.col("doc_id").cast("string").alias("key"), F.concat(broken, F.col("text").cast("binary")).alias("content"))
    return objects.extract_binary_text(files, pages, "PERMISSIVE").select("key", F.md5(F.col("text").cast("binary")).alias("text_md5"), "error")


TYPED_SQL = """typed AS (
  SELECT page_id, CASE page_id % 3 WHEN 0 THEN url || '.PDF' WHEN 1 THEN url || '.log' ELSE url END AS key,
  CASE page_id % 4 WHEN 0 THEN 'Text/HTML' WHEN 1 THEN 'application/json' WHEN 2 THEN 'image/png' END AS content_type FROM pages)"""
ROUTED_SQL = """routed AS (SELECT *, CASE WHEN page_id % 3 = 0 THEN 'pdf'
  WHEN page_id % 4 IN (0, 1) OR page_id % 3 = 1 THEN 'text' ELSE 'unsupported' END AS route FROM typed)"""


def _typed(spark, sf):
    kind, suffix = F.col("page_id") % 4, F.col("page_id") % 3
    return table(spark, sf, "pages").select(
        "page_id",
        F.concat("url", F.when(suffix == 0, ".PDF").when(suffix == 1, ".log").otherwise("")).alias("key"),
        F.when(kind == 0, "Text/HTML").when(kind == 1, "application/json").when(kind == 2, "image/png").alias("content_type"),
        F.col("html").cast("binary").alias("content"),
    )


@check("t1_route_type", f"WITH {TYPED_SQL}, {ROUTED_SQL} SELECT page_id, route FROM routed")
def t1(spark, sf):
    return _typed(spark, sf).select("page_id", objects.route_type(F.col("key"), F.col("content_type")).alias("route"))


@check(
    "t2_decode_text",
    r"SELECT doc_id, md5(regexp_replace(text, '[^\x00-\xFF]', '', 'g')) AS text_md5 FROM documents",
)
def t2(spark, sf):
    narrow = F.regexp_replace("text", r"[^\x00-\xFF]", "")
    content = F.when(F.col("doc_id") % 2 == 0, F.encode(narrow, "ISO-8859-1")).otherwise(narrow.cast("binary"))
    decoded = objects.decode_text(F.col("content"))
    return documents(spark, sf).select("doc_id", content.alias("content")).select("doc_id", F.md5(decoded.cast("binary")).alias("text_md5"))


@check(
    "t3_unsupported",
    f"""WITH {TYPED_SQL}, {ROUTED_SQL} SELECT key, 'Failed to extract document content from ' || key ||
    ': Unsupported content type for text extraction: ' || coalesce(lower(content_type), 'unknown') || ' (key: ' || key || ')' AS error
    FROM routed WHERE route <> 'text'""",
)
def t3(spark, sf):
    return objects.rejects(objects.document_texts(_typed(spark, sf), mode="PERMISSIVE")).select("key", "error")


@check("t4_flatten_json", "SELECT doc_id, md5(to_json(replace(text, chr(10), ' '))::VARCHAR) AS text_md5 FROM documents")
def t4(spark, sf):
    return documents(spark, sf).select("doc_id", F.md5(flatten_json("text").cast("binary")).alias("text_md5"))


@check("t5_trim", f"SELECT doc_id, md5({TRIMMED}) AS text_md5, length({TRIMMED}) AS n_chars FROM documents")
def t5(spark, sf):
    trimmed = documents(spark, sf).select("doc_id", strip("text").alias("text"))
    return trimmed.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.length("text").cast("long").alias("n_chars"))


@check(
    "x1_first_text",
    """SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN md5(text) END AS text_md5 FROM conversations""",
)
def x1(spark, sf):
    blocks = F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("text")))
    whole = F.to_json(F.struct(blocks.alias("content")))
    kind = F.col("turn") % 3
    body = F.when(kind == 0, whole).when(kind == 1, F.lit('{"content": []}')).otherwise(F.concat(F.lit("no json: "), whole))
    read = table(spark, sf, "conversations").select("conv_id", "turn", first_text(body).alias("text"))
    return read.select("conv_id", "turn", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@check("x2_completion_text", "SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN md5(text) END AS text_md5 FROM conversations")
def x2(spark, sf):
    body = F.when(F.col("turn") % 2 == 0, F.to_json(F.struct(F.col("text").alias("completion")))).otherwise(F.lit("{}"))
    read = table(spark, sf, "conversations").select("conv_id", "turn", completion_text(body).alias("text"))
    return read.select("conv_id", "turn", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@check(
    "x3_extract_claim",
    """SELECT o_orderkey AS doc_id, c_name AS claimant, CASE WHEN o_orderkey % 2 = 1 THEN 'Patient ' || o_custkey END AS patient,
    c_name AS signer, 'QX-' || o_orderkey AS policy_number, o_totalprice::DECIMAL(18,2)::VARCHAR AS claim_amount,
    strftime(o_orderdate, '%Y-%m-%d') AS incident_date, c_mktsegment || ' collision at lot ' || o_orderkey || '.' AS description
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def x3(spark, sf):
    found = claims(spark, sf).select("doc_id", extract_claim(F.col("text")).alias("c")).select("doc_id", "c.*")
    return found.withColumns({c: F.col(c).cast("string") for c in ("claim_amount", "incident_date")})


@check(
    "x4_typed_values",
    f"""WITH {CLAIMS_SQL} SELECT doc_id,
    replace(regexp_extract(text, 'Claim Amount: .([0-9.,]+)', 1), ',', '') AS amount,
    strftime(coalesce(try_strptime(regexp_extract(text, 'Incident Date: ([^\\n]+)', 1), '%Y-%m-%d'),
                      try_strptime(regexp_extract(text, 'Incident Date: ([^\\n]+)', 1), '%B %-d, %Y')), '%Y-%m-%d') AS incident,
    regexp_replace(regexp_extract(text, 'Phone Number: ([^\\n]+)', 1), '[^0-9]', '', 'g') AS phone FROM claims""",
)
def x4(spark, sf):
    text = F.col("text")
    return claims(spark, sf).select(
        "doc_id",
        parse_money(labelled(text, "Claim Amount")).cast("string").alias("amount"),
        parse_date(labelled(text, "Incident Date")).cast("string").alias("incident"),
        phone_digits(labelled(text, "Phone Number")).alias("phone"),
    )


@check(
    "x5_coverage_rows",
    """SELECT o_orderkey AS doc_id, pos, coverage, CASE WHEN pos = 0 THEN (250 * (1 + o_orderkey % 5)) || '.00' END AS deductible,
    CASE WHEN pos = 1 THEN (25000 * (1 + o_orderkey % 7)) || '.00' END AS per_person,
    CASE WHEN pos = 1 THEN (50000 * (1 + o_orderkey % 7)) || '.00' END AS per_accident
    FROM orders JOIN customer ON o_custkey = c_custkey,
    (VALUES (0, 'Collision'), (1, 'Bodily Injury'), (2, 'Roadside Help')) AS c(pos, coverage)""",
)
def x5(spark, sf):
    rows = coverage_rows(claims(spark, sf))
    money = ("deductible", "per_person", "per_accident")
    return rows.select("doc_id", "pos", "coverage", *[F.col(c).cast("string").alias(c) for c in money])


@check(
    "x5_coverage_nested",
    """SELECT o_orderkey AS doc_id, pos, coverage, item, CASE WHEN item = 'Deductible' THEN (250 * (1 + o_orderkey % 5)) || '.00' END AS deductible,
    CASE WHEN item = 'Limit' THEN (25000 * (1 + o_orderkey % 7)) || '.00' END AS per_person,
    CASE item WHEN 'Deductible' THEN format('${:,}', 250 * (1 + o_orderkey % 5)) WHEN 'Limit' THEN format('${:,} per person', 25000 * (1 + o_orderkey % 7))
      WHEN 'Towing' THEN 'up to ' || (o_orderkey % 9) || ' miles' ELSE 'Included' END AS note
    FROM orders, (VALUES (0, 'Roadside Help', NULL), (1, 'Collision', 'Deductible'), (2, 'Collision', 'Limit'), (3, 'Extras', 'Towing')) AS c(pos, coverage, item)""",
)
def x5_nested(spark, sf):
    """Headings with indented items beside a bullet."""
    key = F.col("o_orderkey")
    form = render(
        "Coverage of {key}\nCollision:\n  Deductible: ${deductible}\n  Limit: ${person} per person\nExtras:\n\tTowing: up to {miles} miles\n- Roadside Help: Included\n",
        key=key,
        deductible=F.format_number(250 * (1 + key % 5), 0),
        person=F.format_number(25000 * (1 + key % 7), 0),
        miles=key % 9,
    )
    rows = coverage_rows(table(spark, sf, "orders").select(key.alias("doc_id"), form.alias("text")))
    money = [F.col(c).cast("string").alias(c) for c in ("deductible", "per_person")]
    return rows.select("doc_id", "pos", "coverage", "item", *money, "note")


@check(
    "x6_policy_sections_numbered",
    r"""SELECT doc_id, section_idx, CASE section_idx WHEN 1 THEN 'SECTION 1: Cover of ' || source WHEN 2 THEN '2. EXCLUSIONS, ' || upper(lang) END AS title,
    md5(CASE section_idx WHEN 0 THEN 'Policy ' || doc_id WHEN 1 THEN trim(text, E' \t\r\n') ELSE 'Nothing else.' END) AS body_md5
    FROM documents, (VALUES (0::BIGINT), (1), (2)) AS s(section_idx)""",
)
def x6_numbered(spark, sf):
    """The headings policies have, in both forms."""
    form = render(
        "Policy {key}\nSECTION 1: Cover of {source}\n{text}\n---\n2. EXCLUSIONS, {lang}\nNothing else.\n",
        key=F.col("doc_id"),
        source=F.col("source"),
        text=F.col("text"),
        lang=F.upper("lang"),
    )
    sections = policy_sections(documents(spark, sf, "lang", "source").select("doc_id", form.alias("text")))
    return sections.select("doc_id", F.col("section_idx").cast("long").alias("section_idx"), "title", F.md5(F.col("body").cast("binary")).alias("body_md5"))


# Documents have no numbered headings; a short line without end mark is one.
HEADING = r"[^.!?\n]{1,60}"


@check(
    "x6_policy_sections",
    r"""WITH lines AS (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
    numbered AS (SELECT *, regexp_full_match(line, '[^.!?\n]{1,60}') AS head,
      sum(CASE WHEN regexp_full_match(line, '[^.!?\n]{1,60}') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS section_idx FROM lines),
    grouped AS (SELECT doc_id, section_idx, max(line) FILTER (head) AS title,
      string_agg(CASE WHEN head THEN NULL WHEN line = '---' THEN '' ELSE line END, chr(10) ORDER BY n) AS body,
      count(*) FILTER (NOT head) AS n_plain, string_agg(line, chr(10) ORDER BY n) AS raw FROM numbered GROUP BY ALL)
    SELECT doc_id, section_idx::BIGINT AS section_idx, title, md5(coalesce(trim(body, E' \t\r\n'), '')) AS body_md5
    FROM grouped WHERE title IS NOT NULL OR raw <> ''""",
)
def x6(spark, sf):
    sections = policy_sections(documents(spark, sf), HEADING)
    return sections.select("doc_id", F.col("section_idx").cast("long").alias("section_idx"), "title", F.md5(F.col("body").cast("binary")).alias("body_md5"))


@check(
    "x7_parse_accuracy",
    """SELECT doc_id, CASE WHEN quality + 2 * toxic <= 1 THEN (quality + 2 * toxic)::DOUBLE * 0.5 END AS score,
    CASE WHEN toxic = 1 THEN 'wrong date|wrong amount ' || doc_id ELSE '' END AS inaccuracies FROM labels""",
)
def x7(spark, sf):
    score = (F.col("quality") + 2 * F.col("toxic")) * F.lit(0.5)
    score = F.when(F.col("quality") + 2 * F.col("toxic") <= 1, score).otherwise(F.lit(7.5))
    bullets = F.when(F.col("toxic") == 1, F.concat(F.lit("\n- wrong date\n* wrong amount "), "doc_id")).otherwise("")
    answer = F.concat(F.lit("Accuracy score (0-1): "), score.cast("string"), F.lit("\nFindings"), bullets)
    verdict = table(spark, sf, "labels").select("doc_id", parse_accuracy(answer).alias("v"))
    return verdict.select("doc_id", F.col("v.score").alias("score"), F.array_join("v.inaccuracies", "|").alias("inaccuracies"))


@check(
    "x7_parse_numbered",
    """SELECT doc_id, 0.5::DOUBLE AS score, CASE toxic WHEN 1 THEN 'wrong date|item ' || doc_id || ' is off' ELSE '' END AS inaccuracies FROM labels""",
)
def x7_numbered(spark, sf):
    """Answers that number their points, the score and the heading of the list among them."""
    points = F.when(F.col("toxic") == 1, F.concat(F.lit("\n1) wrong date\n  12. item "), "doc_id", F.lit(" is off"))).otherwise("")
    answer = F.concat(F.lit("1. Accuracy score: 0.5\n2. Inaccuracies found:"), points)
    verdict = table(spark, sf, "labels").select("doc_id", parse_accuracy(answer).alias("v"))
    return verdict.select("doc_id", F.col("v.score").alias("score"), F.array_join("v.inaccuracies", "|").alias("inaccuracies"))


@check(
    "x8_parse_quality",
    """SELECT doc_id, (1 + 3 * quality)::DOUBLE AS clarity, CASE WHEN toxic = 0 THEN 2.5::DOUBLE END AS tone,
    (doc_id % 6)::DOUBLE AS overall, 'note ' || doc_id AS why FROM labels""",
)
def x8(spark, sf):
    answer = F.concat(
        F.lit('Here it is: {"Clarity": {"score": '),
        (1 + 3 * F.col("quality")).cast("string"),
        F.lit(', "justification": "note '),
        F.col("doc_id").cast("string"),
        F.lit('"}, "Professional tone": '),
        F.when(F.col("toxic") == 0, "2.5").otherwise("9"),
        F.lit(', "overall_quality": "'),
        (F.col("doc_id") % 6).cast("string"),
        F.lit('", "humour": 3} as asked'),
    )
    q = table(spark, sf, "labels").select("doc_id", parse_quality(answer).alias("q"))
    at = lambda m, f: F.try_element_at("q", F.lit(m))[f]
    return q.select(
        "doc_id",
        at("clarity", "score").alias("clarity"),
        at("tone", "score").alias("tone"),
        at("overall", "score").alias("overall"),
        at("clarity", "why").alias("why"),
    )
