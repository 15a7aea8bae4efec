"""The registered queries of this package, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import language, merkle, mixing, neighbours, periods, pieces, secrets, sharding, simhash, token_files, urls, vector_copies, warc
from paperloom.shipping import ship_package
from paperloom.staging import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where an installed public vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


SHARDS = 16


@query("op1_sharding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = sharding.shard_rows(docs, "doc_id", SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op2_token_files")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = tokenizer_file("byte_bpe_50k.json")
    parts = token_files.write_tokens(table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"), tokenizer)
    return token_files.digest_tokens(parts, "<u2")


MIX_WEIGHTS = {
    ("web",): 5,
    ("books",): 3,
    ("code",): 2,
    **{(domain, "en"): 6 for domain in ("web", "books", "code")},
    **{(domain, lang): 2 for domain in ("web", "books", "code") for lang in ("de", "fr", "es")},
}
MIX_SEED = 7
MIX_BUDGET = 0.9
# The domains of sources that have a known one; all others belong to the default.
MIX_DOMAINS = {"src0": "web", **{f"src{i}": "code" for i in range(1, 20, 2)}}
MIX_DEFAULT = "books"


def mix_levels() -> list:
    """Domain, language and source of a document; the domain is that of its source."""
    known = F.create_map(*[F.lit(x) for pair in MIX_DOMAINS.items() for x in pair])
    return [F.coalesce(F.try_element_at(known, F.col("source")), F.lit(MIX_DEFAULT)), F.col("lang"), F.col("source")]


MIX_SQL = r"""
WITH docs AS (
  SELECT doc_id::VARCHAR AS id, doc_id,
    CASE WHEN source = 'src0' THEN 'web' WHEN source IN ('src1', 'src3', 'src5', 'src7', 'src9', 'src11', 'src13', 'src15', 'src17', 'src19') THEN 'code' ELSE 'books' END AS d,
    coalesce(lang, '') AS l, coalesce(source, '') AS s,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS tokens, left(md5(coalesce(text, '')), 15) AS h
  FROM documents),
supply AS (SELECT d, l, s, sum(tokens)::BIGINT AS supply, sum(tokens)::BIGINT * 4 AS cap FROM docs GROUP BY d, l, s),
total AS (SELECT least((sum(tokens)::DOUBLE * 0.9)::DOUBLE, 9e18) AS share, sum(tokens)::BIGINT * 4 AS most FROM docs),
d0 AS (
  SELECT d, CASE d WHEN 'web' THEN 5 WHEN 'books' THEN 3 ELSE 2 END::BIGINT AS w, sum(cap)::HUGEINT AS cap,
    (SELECT least(trunc(share)::BIGINT, most) FROM total)::HUGEINT AS b
  FROM supply GROUP BY d),
d1 AS (
  SELECT *, cap * (sum(w) OVER () - coalesce(sum(w) OVER q, 0)) <= (b - coalesce(sum(cap) OVER q, 0)) * w AS filled
  FROM d0 WINDOW q AS (ORDER BY cap::DOUBLE / w, d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
d2 AS (
  SELECT *, b - coalesce(sum(cap) FILTER (filled) OVER (), 0) AS rest, greatest(coalesce(sum(w) FILTER (NOT filled) OVER (), 0), 1) AS ow,
    coalesce(sum(w) FILTER (NOT filled) OVER (ORDER BY cap::DOUBLE / w, d ROWS UNBOUNDED PRECEDING), 0) AS hi
  FROM d1),
d3 AS (SELECT d, CASE WHEN filled THEN cap ELSE (hi * rest) // ow - ((hi - w) * rest) // ow END AS b FROM d2),
l0 AS (
  SELECT d, l, CASE l WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END::BIGINT AS w, sum(cap)::HUGEINT AS cap, any_value(b) AS b
  FROM supply JOIN d3 USING (d) GROUP BY d, l),
l1 AS (
  SELECT *, cap * (sum(w) OVER (PARTITION BY d) - coalesce(sum(w) OVER q, 0)) <= (b - coalesce(sum(cap) OVER q, 0)) * w AS filled
  FROM l0 WINDOW q AS (PARTITION BY d ORDER BY cap::DOUBLE / w, l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l2 AS (
  SELECT *, b - coalesce(sum(cap) FILTER (filled) OVER (PARTITION BY d), 0) AS rest,
    greatest(coalesce(sum(w) FILTER (NOT filled) OVER (PARTITION BY d), 0), 1) AS ow,
    coalesce(sum(w) FILTER (NOT filled) OVER (PARTITION BY d ORDER BY cap::DOUBLE / w, l ROWS UNBOUNDED PRECEDING), 0) AS hi
  FROM l1),
l3 AS (SELECT d, l, CASE WHEN filled THEN cap ELSE (hi * rest) // ow - ((hi - w) * rest) // ow END AS b FROM l2),
s1 AS (
  SELECT d, l, s, supply, 1::BIGINT AS w, cap::HUGEINT AS cap, b,
    cap * (count(*) OVER (PARTITION BY d, l) - coalesce(count(*) OVER q, 0)) <= (b - coalesce(sum(cap) OVER q, 0)) AS filled
  FROM supply JOIN l3 USING (d, l)
  WINDOW q AS (PARTITION BY d, l ORDER BY cap::DOUBLE, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s2 AS (
  SELECT *, b - coalesce(sum(cap) FILTER (filled) OVER (PARTITION BY d, l), 0) AS rest,
    greatest(coalesce(sum(w) FILTER (NOT filled) OVER (PARTITION BY d, l), 0), 1) AS ow,
    coalesce(sum(w) FILTER (NOT filled) OVER (PARTITION BY d, l ORDER BY cap::DOUBLE, s ROWS UNBOUNDED PRECEDING), 0) AS hi
  FROM s1),
leaves AS (
  SELECT d, l, s, (b // supply)::INTEGER AS epochs, (b % supply)::BIGINT AS room
  FROM (SELECT d, l, s, supply, (CASE WHEN filled THEN cap ELSE (hi * rest) // ow - ((hi - w) * rest) // ow END)::BIGINT AS b FROM s2)
  WHERE b > 0),
placed AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY d, l, s ORDER BY p, id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM (SELECT *, ('0x' || left(md5(concat_ws('|', '7', epochs::VARCHAR, id, h)), 15))::BIGINT AS p FROM docs JOIN leaves USING (d, l, s)))
SELECT doc_id, epoch::INTEGER AS epoch, tokens, tokens AS tokens_taken FROM placed, unnest(range(epochs)) AS t(epoch)
UNION ALL
SELECT doc_id, epochs AS epoch, tokens, least(tokens, room - ahead) AS tokens_taken FROM placed WHERE ahead < room
"""


@query("op3_mixing", MIX_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), mix_levels(), MIX_WEIGHTS, MIX_BUDGET, MIX_SEED, keep=["doc_id"])


@query("op4_sentencepiece")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.digest_pieces(docs, tokenizer_file("piece_bpe_32k.model"), keep=["doc_id"])


@query("op5_language")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", language.held_out())
    profiles = language.learn_profiles(docs.filter("NOT held_out"))
    return language.identify_language(docs, profiles, keep=["doc_id", "held_out"])


@query("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


@query("op8_secrets")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("secrets", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.col("secrets")).alias("spans"),
    )


URL_RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]

# Edges are taken from links that are absolute and quoted, as those written below are.
URL_SQL = r"""
WITH RECURSIVE rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
linked AS ({linked}),
seen AS (
  SELECT url AS source, regexp_replace(html, '(?is)<!--.*?(?:-->|$)|<script\b.*?(?:</script|$)|<style\b.*?(?:</style|$)', ' ', 'g') AS body
  FROM linked WHERE contains(lower(html), 'canonical') OR contains(lower(html), 'refresh')),
edges AS (
  SELECT source, unnest(list_concat(
    list_transform(
      list_filter(regexp_extract_all(body, '(?is)<link\b[^>]*>'), lambda t: list_contains(regexp_split_to_array(lower(regexp_extract(t, '(?is)\srel\s*=\s*"([^"]*)"', 1)), '\s+'), 'canonical')),
      lambda t: regexp_extract(t, '(?is)\shref\s*=\s*"([^"]*)"', 1)),
    list_transform(regexp_extract_all(body, '(?is)<meta\b[^>]*\shttp-equiv="refresh"[^>]*>'), lambda t: regexp_extract(t, '(?is)url\s*=\s*([^"]*)"', 1)))) AS target
  FROM seen),
spelled AS (
  SELECT url AS u FROM pages UNION SELECT target FROM edges WHERE target LIKE '%://%' UNION SELECT source FROM edges WHERE target LIKE '%://%'),
parts AS (
  SELECT u, lower(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1)) AS host, regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    CASE WHEN contains(u, '://') THEN lower(regexp_extract(u, '(?s)^(.*?)://', 1)) || '://' || lower(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1)) ||
      CASE WHEN regexp_extract(u, '(?s)^.*?://[^/?#]*([^#]*)', 1) LIKE '/%' THEN '' ELSE '/' END || regexp_extract(u, '(?s)^.*?://[^/?#]*([^#]*)', 1) END AS name
  FROM spelled),
ruled AS (
  SELECT u, any_value(p.host) AS host, any_value(p.path) AS path, any_value(name) AS name,
    arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM parts p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY u),
arcs AS (
  SELECT DISTINCT a.name AS x, b.name AS y FROM edges e JOIN ruled a ON a.u = e.source JOIN ruled b ON b.u = e.target WHERE a.name <> b.name),
ways AS (SELECT x, y FROM arcs UNION SELECT y, x FROM arcs),
reach(x, y) AS (SELECT name, name FROM ruled WHERE name IS NOT NULL UNION SELECT r.x, w.y FROM reach r JOIN ways w ON w.x = r.y),
said AS (
  SELECT r.x AS name, bool_or(coalesce(q.verdict = 'allow', FALSE)) AS allowed, bool_or(coalesce(q.verdict = 'block', FALSE)) AS blocked
  FROM reach r JOIN ruled q ON q.name = r.y GROUP BY r.x)
SELECT page_id, coalesce(q.host, '') AS host, coalesce(q.path, '') AS path, q.rule,
  coalesce(q.verdict, CASE WHEN s.allowed THEN 'allow' WHEN s.blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM pages LEFT JOIN ruled q ON q.u = url LEFT JOIN said s ON s.name = q.name
"""


def judged(pages: DataFrame) -> DataFrame:
    return urls.judge_urls(pages.select("page_id", "url"), URL_RULES, urls.page_edges(pages)).select("page_id", "host", "path", "rule", "verdict")


@query("op7_urls", URL_SQL.replace("{linked}", "SELECT url, html FROM pages"))
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))


# The given pages name no other name of theirs. Here a quarter names two, of which
# the second may be ruled out, and another quarter goes on to its secure form.
ALIASED = """CASE page_id % 4
  WHEN 0 THEN concat(html, '<!--<link rel="canonical" href="">--><link rel="alternate Canonical" href="', regexp_replace(url, '/[a-z]+/', '/es/'),
    '"><link rel="canonical" href="', replace(regexp_replace(url, '/[a-z]+/', '/es/'), 'example.org', 'example.net'), '">')
  WHEN 1 THEN concat(html, '<meta http-equiv="refresh" content="0; url=', replace(url, 'http://', 'https://'), '"><script>"<link rel=canonical href=http://a.net/fr/>"</script>')
  ELSE html END"""


@query("op7_urls_aliases", URL_SQL.replace("{linked}", f"SELECT url, {ALIASED} AS html FROM pages"))
def op7_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages").withColumn("html", F.expr(ALIASED)))


@query("op9_neighbours")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, rows.filter("vec_id % 20 = 0"), 20)


# All pairs, as the small tables allow; the operator finds its pairs in leaves.
COPIES_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x), lowest AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings LEFT JOIN counts ON counts.x = vec_id JOIN lowest ON lowest.x = vec_id
"""


@query("op10_vector_copies", COPIES_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_copies.vector_components(table(spark, sf_dir, "embeddings"))


# The given vectors hold no copies and few rows. Here every row has near copies, one
# label's rows have more, and leaves are small, so that the trees split and spill.
NEAR = "list_transform(embedding, lambda x, i: (x * (1 + 0.001 * ((i * 7 + copy * 13) % 11 - 5)))::FLOAT)"
PLANTED_SQL = f"""
planted AS (
  SELECT vec_id * 100 + copy AS vec_id, CASE WHEN vec_id % 50 = 0 AND copy = 1 THEN NULL ELSE {NEAR} END AS embedding
  FROM (SELECT vec_id, embedding, unnest(range(CASE WHEN label = 3 THEN 9 ELSE 3 END)) AS copy FROM embeddings)),"""


@query("op10_vector_copies_planted", COPIES_SQL.replace("embeddings", "planted").replace("WITH RECURSIVE", "WITH RECURSIVE" + PLANTED_SQL))
def op10_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = F.explode(F.sequence(F.lit(0), F.when(F.col("label") == 3, 8).otherwise(2)))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", copies.alias("copy"))
    share = lambda i: 1 + F.lit(0.001).cast("decimal(4,3)") * (((i + 1) * 7 + F.col("copy") * 13) % 11 - 5)
    near = F.transform("embedding", lambda x, i: (x.cast("double") * share(i).cast("double")).cast("float"))
    given = F.when((F.col("vec_id") % 50 != 0) | (F.col("copy") != 1), near)
    planted = rows.select((F.col("vec_id") * 100 + F.col("copy")).alias("vec_id"), given.alias("embedding"))
    return vector_copies.vector_components(planted, leaf=64, sample=2_000)


# Trees by plain grouping and a climb for each row; crc32 bit by bit.
MERKLE_SQL = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') ||
      coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS body,
    coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS other,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: [ascii(substring(doc_id::VARCHAR, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384))) AS crc
  FROM documents),
leaves AS (SELECT doc_id, lang, sha256(head || body) AS leaf, CASE WHEN crc % 3 = 0 THEN sha256(head || other) ELSE sha256(head || body) END AS claimed FROM fields),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes(lang, level, pos, hash, n) AS (
  SELECT lang, 0, pos, leaf, n FROM placed
  UNION ALL SELECT lang, level + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)), (n + 7) // 8 FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 8, n),
subroots AS (SELECT lang, hash, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(level, pos, hash, n) AS (
  SELECT 0, pos, hash, n FROM subroots
  UNION ALL SELECT level + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)), (n + 7) // 8 FROM tops WHERE n > 1 GROUP BY level, pos // 8, n),
runs AS (SELECT lang, level, pos // 8 AS run, list(hash ORDER BY pos) AS h FROM nodes WHERE n > 1 GROUP BY ALL),
top_runs AS (SELECT level, pos // 8 AS run, list(hash ORDER BY pos) AS h FROM tops WHERE n > 1 GROUP BY ALL),
climb(id, lang, level, pos, n, cur, sib) AS (
  SELECT pos || '/' || coalesce(lang, '/'), lang, 0, pos, n, claimed, '' FROM placed
  UNION ALL
  SELECT c.id, c.lang, c.level + 1, c.pos // 8, (c.n + 7) // 8, sha256(array_to_string(h[1:c.pos % 8], '') || cur || array_to_string(h[c.pos % 8 + 2:], '')),
    sib || array_to_string(h[1:c.pos % 8], '') || array_to_string(h[c.pos % 8 + 2:], '')
  FROM climb c JOIN runs r ON r.lang IS NOT DISTINCT FROM c.lang AND r.level = c.level AND r.run = c.pos // 8),
over(id, level, pos, n, cur, sib) AS (
  SELECT id, 0, s.pos, s.n, cur, sib FROM climb c JOIN subroots s ON s.lang IS NOT DISTINCT FROM c.lang WHERE c.n = 1
  UNION ALL
  SELECT c.id, c.level + 1, c.pos // 8, (c.n + 7) // 8, sha256(array_to_string(h[1:c.pos % 8], '') || cur || array_to_string(h[c.pos % 8 + 2:], '')),
    sib || array_to_string(h[1:c.pos % 8], '') || array_to_string(h[c.pos % 8 + 2:], '')
  FROM over c JOIN top_runs r ON r.level = c.level AND r.run = c.pos // 8),
root AS (SELECT hash AS root FROM tops WHERE n = 1)
SELECT p.doc_id, p.leaf, s.hash AS subroot, root, sha256(o.sib) AS proof_sha256, o.cur AS folded_root, o.cur = root AS verified
FROM placed p JOIN over o ON o.id = p.pos || '/' || coalesce(p.lang, '/') JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang, root
WHERE o.n = 1
"""


@query("op12_merkle", MERKLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf_hash([*fields[:4], lowered]))
    manifest = merkle.build_manifest(docs, merkle.leaf_hash(fields), claimed=tampered)
    root = F.lit(None if manifest.root is None else manifest.root.hex()).cast("string")
    return merkle.prove(manifest).select(
        F.col("key").alias("doc_id"),
        merkle.digits(F.col("leaf")).alias("leaf"),
        merkle.digits(F.col("subroot")).alias("subroot"),
        root.alias("root"),
        F.sha2(merkle.digits(F.col("siblings")), 256).alias("proof_sha256"),
        merkle.digits(F.col("folded")).alias("folded_root"),
        "verified",
    )


@query("op13_periods")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    planted = periods.with_planted_periods(docs.select("doc_id", "text"))
    found = periods.periodic_runs(planted, keep=["doc_id"])
    top, lines = periods.longest(F.col("runs")), periods.listed(F.col("runs"))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[top[c].alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * top["length"] / top["period"]).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# A digest's bits in groups of five, each from two hex digits.
WARC_SQL = """
WITH payloads AS (SELECT page_id, {payload} AS payload FROM pages),
digests AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS h, min(page_id) OVER (PARTITION BY payload) AS holder FROM payloads)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substring(h, (5 * i // 4 + 1)::INT, 2))::INT >> (3 - 5 * i % 4)::INT) & 31) + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> holder THEN holder END AS refers_to
FROM digests
"""


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Pages written, found again by their urls and read back."""
    archive = warc.write_archive(pages, scratch_path(spark, "archive"))
    captures = warc.find_captures(archive, pages)
    records = warc.resolve_revisits(warc.read_records(archive, captures, payload=False))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op11_warc", WARC_SQL.format(payload="coalesce(html, '')"))
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(spark, table(spark, sf_dir, "pages"))


# The given pages all differ: here a third is null and a fifth of the rest is its url's scheme and host.
@query(
    "op11_warc_revisits",
    WARC_SQL.format(payload=r"CASE WHEN page_id % 3 = 0 THEN '' WHEN page_id % 5 = 0 THEN regexp_extract(url, '^[a-z]*://[^/]*') ELSE coalesce(html, '') END"),
)
def op11_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.when(F.col("page_id") % 5 == 0, F.regexp_extract("url", "^[a-z]*://[^/]*", 0)).otherwise(F.col("html"))
    return archived(spark, table(spark, sf_dir, "pages").withColumn("html", F.when(F.col("page_id") % 3 != 0, host)))
