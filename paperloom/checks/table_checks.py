"""Lookups, joins, aggregates and model-free evaluation (F, J, G, V, M7, M8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.checks.base import CLAIMS_SQL, PAIRS_SQL, check, documents, pairs, table
from paperloom.checks.prompt_checks import SUMMARIES_SQL, summaries
from paperloom.operators import evaluation, lookups
from paperloom.operators.feedback import feedback_rates, join_feedback
from paperloom.operators.screening import cross_policies
from paperloom.staging import stage, stage_path


def _md5(c):
    return F.md5(F.col(c).cast("binary"))


@check("f1_lookup_first", "SELECT p_partkey, p_name, p_brand FROM part WHERE p_name = 'red widget' ORDER BY p_partkey LIMIT 1")
def f1(spark, sf):
    return lookups.lookup_first(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), "red widget", "p_name", "p_partkey")


REGISTRY_SQL = """registry AS (
  SELECT s_suppkey AS ordinal, '  Nation ' || s_nationkey || chr(9) AS name, 'id-' || s_suppkey AS id, (s_suppkey % 13)::VARCHAR AS version FROM supplier)"""


def _registry(spark, sf):
    """Policy versions out of suppliers: padded names, several rows per name."""
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("ordinal"),
        F.concat(F.lit("  Nation "), "s_nationkey", F.lit("\t")).alias("name"),
        F.concat(F.lit("id-"), "s_suppkey").alias("id"),
        (F.col("s_suppkey") % 13).cast("string").alias("version"),
    )


@check(
    "f2_lookup_policy",
    f"WITH {REGISTRY_SQL} SELECT id, version FROM registry WHERE trim(name, E' \\t') = 'Nation 15' ORDER BY ordinal LIMIT 1",
)
def f2(spark, sf):
    return lookups.lookup_policy(_registry(spark, sf), "Nation 15")


@check(
    "f3_exists_in",
    """SELECT n_nationkey, n_name, n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) AS there FROM nation""",
)
def f3(spark, sf):
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    known = table(spark, sf, "supplier").filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("n_nationkey"))
    there, absent = lookups.exists_in(nations, known, "n_nationkey")
    return there.withColumn("there", F.lit(True)).unionByName(absent.withColumn("there", F.lit(False)))


@check(
    "f4_drop_empty",
    """SELECT doc_id, len(regexp_extract_all(text, '[0-9]+'))::BIGINT AS n, regexp_extract_all(text, '[0-9]+')[1] AS first
    FROM documents WHERE regexp_matches(text, '[0-9]')""",
)
def f4(spark, sf):
    found = documents(spark, sf).select("doc_id", F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0)).alias("entry"))
    return lookups.drop_empty(found, "entry").select("doc_id", F.size("entry").cast("long").alias("n"), F.get("entry", 0).alias("first"))


@check("f5_filter_metadata", "SELECT doc_id, source, md5(text) AS text_md5 FROM documents WHERE lang = 'fr'")
def f5(spark, sf):
    return lookups.filter_metadata(table(spark, sf, "documents"), "lang", "fr").select("doc_id", "source", _md5("text").alias("text_md5"))


@check(
    "j1_cross_models",
    "SELECT doc_id, ordinal, model_id FROM documents, (VALUES (0, 'model-b'), (1, 'model-a'), (2, 'model-c')) AS m(ordinal, model_id)",
)
def j1(spark, sf):
    return evaluation.cross_models(documents(spark, sf), ["model-b", "model-a", "model-c"]).select("doc_id", "ordinal", "model_id")


@check(
    "j2_cross_policies",
    """SELECT doc_id, policy_id, policy_version, side FROM documents, (VALUES ('gr-1', '3'), ('gr-2', '1')) AS p(policy_id, policy_version),
    (VALUES ('input'), ('output')) AS s(side)""",
)
def j2(spark, sf):
    crossed = cross_policies(documents(spark, sf), [("gr-1", "3"), ("gr-2", "1")], ("input", "output"))
    return crossed.select("doc_id", "policy_id", "policy_version", "side")


@check("j3_join_summary", "SELECT doc_id, md5(text) AS text_md5, 'quality ' || quality AS summary FROM documents JOIN labels USING (doc_id)")
def j3(spark, sf):
    short = table(spark, sf, "labels").select("doc_id", F.concat(F.lit("quality "), "quality").alias("summary"))
    return evaluation.join_summary(documents(spark, sf), short).select("doc_id", _md5("text").alias("text_md5"), "summary")


@check(
    "j5_lookup_join",
    f"""WITH {REGISTRY_SQL}, firsts AS (SELECT trim(name, E' \\t') AS n, arg_min(id, ordinal) AS id, arg_min(version, ordinal) AS version FROM registry GROUP BY 1)
    SELECT c_custkey, id, version, id IS NULL AS not_found FROM customer LEFT JOIN firsts ON n = 'Nation ' || (c_nationkey + c_custkey % 2 * 10)""",
)
def j5(spark, sf):
    asked = F.concat(F.lit("Nation "), F.col("c_nationkey") + F.col("c_custkey") % 2 * 10, F.lit(" "))
    names = table(spark, sf, "customer").select("c_custkey", asked.alias("name"))
    return lookups.lookup_join(names, _registry(spark, sf)).select("c_custkey", "id", "version", "not_found")


@check("j6_ensure", "SELECT DISTINCT source FROM documents WHERE source NOT IN (SELECT 'src' || (s_suppkey % 11) FROM supplier)")
def j6(spark, sf):
    registered = table(spark, sf, "supplier").select(F.concat(F.lit("src"), F.col("s_suppkey") % 11).alias("source"))
    return lookups.ensure(table(spark, sf, "documents"), registered, "source")


@check(
    "j6_register",
    """WITH registry AS (SELECT 'src' || (s_suppkey % 11) AS source, min(s_suppkey) AS ordinal FROM supplier GROUP BY 1),
    fresh AS (SELECT DISTINCT source FROM documents WHERE source NOT IN (SELECT source FROM registry))
    SELECT source, ordinal FROM registry UNION ALL
    SELECT source, (SELECT max(ordinal) FROM registry) + row_number() OVER (ORDER BY source) FROM fresh""",
)
def j6_register(spark, sf):
    """Two rounds: what the first appended, the second finds."""
    registry = table(spark, sf, "supplier").groupBy(F.concat(F.lit("src"), F.col("s_suppkey") % 11).alias("source")).agg(F.min("s_suppkey").alias("ordinal"))
    path = stage_path(spark, "registry")
    registry.write.parquet(path)
    for _ in range(2):
        lookups.register(table(spark, sf, "documents"), path, "source")
    return spark.read.parquet(path)


CLICKS_SQL = """clicks AS (SELECT p.question, p.answer, CASE event_type WHEN 'click' THEN 'up' WHEN 'error' THEN 'down' ELSE event_type END AS rating
  FROM events e JOIN pairs p ON p.conv_id = e.user_id AND p.turn = (e.event_id % 4))"""


def _clicks(spark, sf):
    events = table(spark, sf, "events").select(
        F.col("user_id").alias("conv_id"), (F.col("event_id") % 4).alias("turn"), "ts", _rated()
    )
    return pairs(spark, sf).join(events, ["conv_id", "turn"])


@check(
    "j7_join_feedback",
    f"""WITH {PAIRS_SQL}, {CLICKS_SQL}, counted AS (SELECT question, answer, count(*) FILTER (rating = 'up') AS n_up,
      count(*) FILTER (rating = 'down') AS n_down, count(*) FILTER (rating NOT IN ('up', 'down')) AS n_other FROM clicks GROUP BY ALL)
    SELECT conv_id, turn, coalesce(n_up, 0) AS n_up, coalesce(n_down, 0) AS n_down, coalesce(n_other, 0) AS n_other
    FROM pairs LEFT JOIN counted USING (question, answer)""",
)
def j7(spark, sf):
    return join_feedback(pairs(spark, sf), _clicks(spark, sf)).select("conv_id", "turn", "n_up", "n_down", "n_other")


@check(
    "j8_ab_policy",
    """SELECT doc_id, quality::DOUBLE AS without_policy, quality * (1 - toxic * 0.5)::DOUBLE AS with_policy,
    quality * (1 - toxic * 0.5)::DOUBLE - quality AS change FROM labels""",
)
def j8(spark, sf):
    return evaluation.ab_policy(_both_policies(spark, sf))


def _both_policies(spark, sf):
    labels = table(spark, sf, "labels")
    plain = labels.select("doc_id", F.lit(False).alias("policy"), F.col("quality").cast("double").alias("accuracy"))
    guarded = labels.select("doc_id", F.lit(True).alias("policy"), (F.col("quality") * (1 - F.col("toxic") * F.lit(0.5))).alias("accuracy"))
    return plain.unionByName(guarded)


def _interval_sql(source: str, by: str = "") -> str:
    """Means by replicate from ``source(value, key, by)`` and where their middle lies."""
    keys = f"{by}, " if by else ""
    return f"""WITH src AS ({source}),
    drawn AS (SELECT {keys}value, b * 8 + j AS r, ('0x' || substr(md5('0:' || key || ':' || b), 1 + 4 * j, 4))::INT AS u FROM src, range(25) AS t(b), range(8) AS s(j)),
    weighed AS (SELECT {keys}value, r, len(list_filter([24109, 48219, 60273, 64292, 65296, 65497, 65531, 65535], lambda c: u >= c)) AS w FROM drawn),
    means AS (SELECT {keys}r, count(*) AS n, avg(value) AS plain, sum(value * w) / sum(w) AS m FROM weighed GROUP BY {keys}r)
    SELECT {keys}max(n) AS n, max(round(plain, 6)) AS mean, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high,
    round(avg((round(m, 9) <= 0)::INT), 6) AS share_not_above_zero FROM means {'GROUP BY ' + by if by else ''}"""


@check("j8_ab_interval", _interval_sql("SELECT quality * (1 - toxic * 0.5)::DOUBLE - quality AS value, doc_id AS key FROM labels"))
def j8_interval(spark, sf):
    return evaluation.ab_interval(_both_policies(spark, sf))


@check("g7_report_intervals", _interval_sql("SELECT 'model-' || (doc_id % 3) AS model, quality::DOUBLE AS value, doc_id AS key FROM labels", "model"))
def g7_intervals(spark, sf):
    evals = table(spark, sf, "labels").select("doc_id", F.concat(F.lit("model-"), F.col("doc_id") % 3).alias("model"), "quality")
    return evaluation.mean_interval(evals, "quality", "doc_id", "model")


@check(
    "g1_model_metrics",
    """SELECT doc_id, model_id, round(seconds, 6) AS time_seconds, n_blocks::INT AS n_blocks, n_chars, sample_md5 FROM (
      SELECT conv_id AS doc_id, role AS model_id, turn / 7.0::DOUBLE AS seconds, CASE WHEN turn % 3 = 2 THEN 0 ELSE 1 + turn % 3 END AS n_blocks,
      CASE WHEN turn % 3 = 2 THEN 0 ELSE length(text) END AS n_chars, md5(CASE WHEN turn % 3 = 2 THEN '' ELSE text END) AS sample_md5 FROM conversations)""",
)
def g1(spark, sf):
    block = F.struct(F.lit("text").alias("type"), F.col("text").alias("text"))
    blocks = F.array_repeat(block, ((F.col("turn") % 3 + 1) % 3).cast("int"))
    runs = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("doc_id"),
        F.col("role").alias("model_id"),
        F.to_json(F.struct(blocks.alias("content"))).alias("response"),
        (F.col("turn") / 7).alias("seconds"),
    )
    runs = evaluation.model_metrics(runs)
    return runs.select("doc_id", "model_id", "time_seconds", "n_blocks", F.col("n_chars").cast("long").alias("n_chars"), _md5("output_sample").alias("sample_md5"))


@check("g2_output_sample", "SELECT conv_id, turn, text[:100] || '...' AS sample, length(text) AS output_length FROM conversations")
def g2(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", evaluation.output_sample(F.col("text")).alias("sample"), F.length("text").cast("long").alias("output_length")
    )


MODELS = ["view", "click", "purchase", "signup", "error"]
_ORDINALS = "(VALUES " + ", ".join(f"({i}, '{m}')" for i, m in enumerate(MODELS)) + ") AS o(ordinal, model_id)"


def _runs(spark, sf):
    """Events as model runs: the type is the model, the value its seconds."""
    ordinal = F.array_position(F.array(*[F.lit(m) for m in MODELS]), F.col("event_type")) - 1
    return table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("model_id"), ordinal.cast("int").alias("ordinal"), F.col("value").alias("time_seconds")
    )


@check(
    "g3_model_table",
    f"""SELECT model_id, ordinal, count(*) AS n_runs, 0::BIGINT AS n_failed, round(avg(value), 6) AS avg_seconds, min(value) AS min_seconds, max(value) AS max_seconds,
    quantile_disc(value, 0.5) AS median_seconds, quantile_disc(value, 0.95) AS p95_seconds
    FROM events JOIN {_ORDINALS} ON event_type = model_id GROUP BY ALL""",
)
def g3(spark, sf):
    return evaluation.model_table(_runs(spark, sf))


@check(
    "g3_model_sketches",
    """SELECT event_type AS model_id, count(*)::BIGINT AS n_runs, 0::BIGINT AS n_failed, round(avg(value), 6) AS avg_seconds, min(value) AS min_seconds,
    max(value) AS max_seconds, TRUE AS median_holds, TRUE AS p95_holds FROM events GROUP BY ALL""",
)
def g3_sketches(spark, sf):
    """Sketches of each day's runs, merged; the percentiles' ranks are counted among all times.

    Sketches draw at random, so their values are not compared themselves.
    """
    events = table(spark, sf, "events")
    runs = events.select(F.to_date("ts").alias("run"), F.col("event_type").alias("model_id"), F.col("value").alias("time_seconds"))
    kept = stage(evaluation.time_sketches(runs, "run"), "sketches")
    made = stage(evaluation.model_table_of(kept), "model_table")
    error = evaluation.SKETCH_RANK_ERROR

    def holds(quantile, share):
        # sketches give one of the times, rounded as in the table
        below = F.avg((F.round("time_seconds", 6) < F.col(quantile)).cast("int"))
        upto = F.avg((F.round("time_seconds", 6) <= F.col(quantile)).cast("int"))
        return (below <= share + error) & (upto >= share - error)

    ranks = (
        runs.join(F.broadcast(made.select("model_id", "median_seconds", "p95_seconds")), "model_id")
        .groupBy("model_id")
        .agg(holds("median_seconds", 0.5).alias("median_holds"), holds("p95_seconds", 0.95).alias("p95_holds"))
    )
    return made.drop("median_seconds", "p95_seconds").join(ranks, "model_id")


@check("g4_last_per_model", "SELECT event_type AS model_id, max(event_id) AS event_id, arg_max(value, event_id) AS time_seconds FROM events GROUP BY ALL")
def g4(spark, sf):
    return evaluation.last_per_model(_runs(spark, sf), "model_id", "event_id", ["event_id", "time_seconds"])


def _rated():
    """Events as clicks: click is up, error is down, the rest is neither."""
    kind = F.col("event_type")
    return F.when(kind == "click", "up").when(kind == "error", "down").otherwise(kind).alias("rating")


RATES_SQL = """count(*) FILTER (event_type = 'click') AS n_up, count(*) FILTER (event_type = 'error') AS n_down,
  count(*) FILTER (event_type NOT IN ('click', 'error')) AS n_other,
  round(count(*) FILTER (event_type = 'click') / nullif(count(*) FILTER (event_type IN ('click', 'error')), 0), 6) AS helpful_share"""


@check("g5_feedback_rates", f"SELECT user_id, {RATES_SQL} FROM events GROUP BY ALL")
def g5(spark, sf):
    return feedback_rates(table(spark, sf, "events").select("user_id", _rated()), "user_id")


@check(
    "g7_eval_report",
    """SELECT model, policy, count(*) AS n_docs, round(avg(quality), 6) AS avg_accuracy, round(avg(1 - toxic), 6) AS avg_clarity
    FROM (SELECT *, 'model-' || (doc_id % 3) AS model, doc_id % 2 = 0 AS policy FROM labels) GROUP BY ROLLUP (model, policy)""",
)
def g7(spark, sf):
    evals = table(spark, sf, "labels").select(
        F.concat(F.lit("model-"), F.col("doc_id") % 3).alias("model"),
        (F.col("doc_id") % 2 == 0).alias("policy"),
        F.col("quality").alias("accuracy"),
        (1 - F.col("toxic")).alias("clarity"),
    )
    return evaluation.eval_report(evals, ["accuracy", "clarity"], "model", "policy")


@check("g8_concat_ordered", "SELECT conv_id, md5(string_agg(text, chr(10) ORDER BY turn)) AS text_md5 FROM conversations GROUP BY conv_id")
def g8(spark, sf):
    joined = evaluation.concat_ordered(table(spark, sf, "conversations"), "conv_id", "turn", block=4)
    return joined.select("conv_id", _md5("text").alias("text_md5"))


@check(
    "v2_latest_version",
    """SELECT name, id, version FROM (SELECT s_nationkey AS name, 'id-' || s_suppkey AS id, (s_suppkey % 13)::VARCHAR AS version FROM supplier)
    QUALIFY row_number() OVER (PARTITION BY name ORDER BY version::INT DESC, id DESC) = 1""",
)
def v2(spark, sf):
    versions = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("name"), F.format_string("id-%d", "s_suppkey").alias("id"), (F.col("s_suppkey") % 13).cast("string").alias("version")
    )
    return lookups.latest_version(versions)


_ALTERED = "CASE WHEN doc_id % 3 = 0 THEN replace(summary, 'for $', 'for $9') ELSE summary END"
_FACTS = """list_distinct(list_concat(
  list_filter(list_transform(regexp_extract_all(translate({t}, '$,', ''), '[A-Za-z0-9#][A-Za-z0-9./#-]*'), lambda w: regexp_replace(w, '[./#-]+$', '')),
              lambda w: regexp_matches(w, '[0-9]')),
  list_transform(list_filter(list_transform(regexp_extract_all({t}, '[A-Z][a-z]+ [0-9]{{1,2}}, [0-9]{{4}}'), lambda d: try_strptime(d, '%B %-d, %Y')),
                             lambda d: d IS NOT NULL), lambda d: strftime(d, '%Y-%m-%d'))))"""


def _altered(spark, sf):
    changed = F.when(F.col("doc_id") % 3 == 0, F.replace("summary", F.lit("for $"), F.lit("for $9"))).otherwise(F.col("summary"))
    return summaries(spark, sf).withColumn("summary", changed)


@check(
    "m7_grounding",
    f"""WITH {CLAIMS_SQL}, {SUMMARIES_SQL}, both_facts AS (
      SELECT doc_id, {_FACTS.format(t='text')} AS known, {_FACTS.format(t=f'({_ALTERED})')} AS said FROM summaries),
    checked AS (SELECT doc_id, said, list_filter(said, lambda f: NOT list_contains(known, f)) AS wrong FROM both_facts)
    SELECT doc_id, round(CASE WHEN len(said) = 0 THEN 1 ELSE 1 - len(wrong) / len(said) END, 6)::DOUBLE AS score,
    array_to_string(list_sort(wrong), '|') AS inaccuracies FROM checked""",
)
def m7(spark, sf):
    found = evaluation.grounding(_altered(spark, sf))
    return found.select("doc_id", "score", F.array_join(F.sort_array("inaccuracies"), "|").alias("inaccuracies"))


@check(
    "m8_quality_scores",
    f"""WITH {CLAIMS_SQL}, {SUMMARIES_SQL}, measured AS (
      SELECT doc_id, 1 + 4 * (CASE WHEN doc_id % 2 = 1 THEN 7 ELSE 6 END) / 7 AS completeness,
      5 - 4 * least(1.0, length(summary) / length(text))::DOUBLE AS conciseness,
      greatest(1.0, least(5.0, 5 - 4 * (len(regexp_extract_all(summary, '[^ \\t\\n\\r\\f]+')) /
        greatest(1, len(list_filter(regexp_extract_all(summary, '[^.!?\\n]+[.!?]*'), lambda s: trim(s) <> ''))) - 20) / 40))::DOUBLE AS clarity FROM summaries)
    SELECT doc_id, round(completeness, 6) AS completeness, round(conciseness, 6) AS conciseness, round(clarity, 6) AS clarity,
    round((completeness + conciseness + clarity) / 3, 6) AS overall FROM measured""",
)
def m8(spark, sf):
    fields = ("claimant", "patient", "signer", "policy_number", "claim_amount", "incident_date", "description")
    n_found = sum((F.col(f"_c.{f}").isNotNull().cast("int") for f in fields), F.lit(0))
    scored = summaries(spark, sf).select("doc_id", evaluation.quality_scores(F.col("text"), F.col("summary"), n_found, len(fields)).alias("q"))
    return scored.select("doc_id", "q.*")
