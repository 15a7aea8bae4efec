"""Chunks, vectors, ingestion and retrieval (C, E, J4, V, R, G6)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from paperloom.checks.base import check, document_index, documents, questions, table
from paperloom.functions.text import WHITESPACE
from paperloom.operators import answers as answering
from paperloom.operators import chunking, embedding, retrieval
from paperloom.operators.coded import build_coded, recall
from paperloom.operators.ingest import diff_ingest, ingest, ingest_report, refresh_chunks, refresh_index, to_rebuild
from paperloom.operators.invoke import make_stub
from paperloom.operators.search import top_k
from paperloom.operators.segments import add_segment, compact, load_segments, remove_unused
from paperloom.staging import stage, stage_path

TOKENS_SQL = r"regexp_extract_all({}, '[^ \t\n\r\f]+')"
TERMS_SQL = r"regexp_extract_all(lower({}), '[\p{{L}}0-9]+')"
BUCKET_SQL = "(('0x' || substr(md5({}), 1, 8))::BIGINT % {})"


def _pieces_sql(name: str, source: str, keys: str, tokens: str, size: int, overlap: int, idx: str) -> str:
    step = size - overlap
    return f"""{name} AS (SELECT {keys}, {idx}::INT AS {idx}, {tokens}[{idx} * {step} + 1 : {idx} * {step} + {size}] AS toks FROM (
      SELECT *, unnest(range(greatest(1, ceil((len({tokens}) - {overlap}) / {step}.0))::BIGINT)) AS {idx} FROM {source} WHERE len({tokens}) > 0))"""


CHUNKS_SQL = (
    f"doc_tokens AS (SELECT doc_id, lang, {TOKENS_SQL.format('text')} AS t FROM documents), "
    + _pieces_sql("pieces", "doc_tokens", "doc_id, lang", "t", 300, 15, "chunk_idx")
    + ", chunks AS (SELECT *, doc_id || '#' || chunk_idx AS chunk_id, array_to_string(toks, ' ') AS text, len(toks)::INT AS n_tokens FROM pieces)"
)
IDF_SQL = f"""tf AS (SELECT chunk_id, term, count(*) AS tf FROM (SELECT chunk_id, unnest({TERMS_SQL.format('text')}) AS term FROM chunks) GROUP BY ALL),
  idf AS (SELECT term, df, ln(1 + ((SELECT count(*) FROM chunks) - df + 0.5) / (df + 0.5)) AS idf FROM (SELECT term, count(*) AS df FROM tf GROUP BY term))"""


def _unit_sql(name: str, source: str, key: str) -> str:
    return f"""{name} AS (SELECT {key}, bucket, (w / sqrt(sum(w * w) OVER (PARTITION BY {key})))::FLOAT::DOUBLE AS w FROM (
      SELECT {key}, {BUCKET_SQL.format('term', 1024)} AS bucket, sum(tf * idf) AS w FROM {source} JOIN idf USING (term) GROUP BY ALL))"""


QUESTIONS_SQL = f"""asked AS (SELECT item_id AS query_id, text AS question FROM benchmark),
  asked_tf AS (SELECT query_id, term, count(*) AS tf FROM (SELECT query_id, unnest({TERMS_SQL.format('question')}) AS term FROM asked) GROUP BY ALL)"""
SCORES_SQL = f"""{CHUNKS_SQL}, {IDF_SQL}, {QUESTIONS_SQL}, {_unit_sql('chunk_vec', 'tf', 'chunk_id')}, {_unit_sql('asked_vec', 'asked_tf', 'query_id')},
  scores AS (SELECT query_id, chunk_id, round(sum(a.w * c.w), 6) AS score FROM asked_vec a JOIN chunk_vec c USING (bucket) GROUP BY ALL)"""


def _hits_sql(name: str, k: int, scores: str = "scores", where: str = "true") -> str:
    return f"""{name} AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id))::INT AS rank, chunk_id, score
      FROM {scores} WHERE score > 0 AND {where} QUALIFY rank <= {k})"""


HITS_SQL = f"{SCORES_SQL}, {_hits_sql('hits', 3)}"


def _md5(c):
    return F.md5(F.col(c).cast("binary"))


def _long(df, *names):
    return df.withColumns({n: F.col(n).cast("long") for n in names})


@check(
    "c1_chunk_fixed",
    f"WITH {CHUNKS_SQL} SELECT doc_id, chunk_idx, chunk_id, md5(text) AS text_md5, n_tokens FROM chunks",
)
def c1(spark, sf):
    return chunking.chunk_fixed(documents(spark, sf)).select("doc_id", "chunk_idx", "chunk_id", _md5("text").alias("text_md5"), "n_tokens")


@check(
    "c2_chunk_hierarchical",
    f"""WITH doc_tokens AS (SELECT doc_id, {TOKENS_SQL.format('text')} AS t FROM documents),
    {_pieces_sql('parents', 'doc_tokens', 'doc_id', 't', 1000, 50, 'parent_idx')},
    {_pieces_sql('children', 'parents', 'doc_id, parent_idx', 'toks', 500, 50, 'child_idx')}
    SELECT doc_id || '#' || parent_idx AS parent_id, child_idx, md5(array_to_string(toks, ' ')) AS text_md5, len(toks)::INT AS n_tokens FROM children""",
)
def c2(spark, sf):
    return chunking.chunk_hierarchical(documents(spark, sf)).select("parent_id", "child_idx", _md5("text").alias("text_md5"), "n_tokens")


SENTENCES_SQL = (
    "list_filter(list_transform(regexp_extract_all({t}, '[^.!?\\n]+[.!?]*'), lambda s: trim(s, '" + WHITESPACE + "')), lambda s: s <> '')"
)
DISTANCES_SQL = f"""sents AS (SELECT doc_id, unnest(l) AS sentence, generate_subscripts(l, 1) - 1 AS sent FROM (
    SELECT doc_id, {SENTENCES_SQL.format(t='text')} AS l FROM documents)),
  counts AS (SELECT doc_id, sent, {BUCKET_SQL.format('term', 1024)} AS bucket, count(*) AS n FROM (
    SELECT doc_id, sent, unnest({TERMS_SQL.format('sentence')}) AS term FROM sents) GROUP BY ALL),
  buffered AS (SELECT doc_id, sent + o AS sent, bucket, sum(n)::BIGINT AS n FROM counts, (VALUES (-1), (0), (1)) AS v(o) GROUP BY ALL),
  squares AS (SELECT doc_id, sent, sum(n * n)::DOUBLE AS sq FROM buffered GROUP BY ALL),
  products AS (SELECT a.doc_id, a.sent, sum(a.n * b.n)::DOUBLE AS p FROM buffered a
    JOIN buffered b ON a.doc_id = b.doc_id AND a.bucket = b.bucket AND b.sent = a.sent + 1 GROUP BY ALL),
  distances AS (SELECT s.doc_id, s.sent, s.sentence, CASE WHEN n.sent IS NOT NULL THEN
      round(1 - coalesce(p / (sqrt(q1.sq) * sqrt(q2.sq)), 0), 6) END AS distance
    FROM sents s LEFT JOIN sents n ON n.doc_id = s.doc_id AND n.sent = s.sent + 1
    LEFT JOIN squares q1 ON q1.doc_id = s.doc_id AND q1.sent = s.sent LEFT JOIN squares q2 ON q2.doc_id = s.doc_id AND q2.sent = s.sent + 1
    LEFT JOIN products p ON p.doc_id = s.doc_id AND p.sent = s.sent)"""


@check("v3_sentence_distances", f"WITH {DISTANCES_SQL} SELECT doc_id, sent::INT AS sent, md5(sentence) AS sentence_md5, distance FROM distances")
def v3(spark, sf):
    return chunking.sentence_distances(documents(spark, sf)).select("doc_id", "sent", _md5("sentence").alias("sentence_md5"), "distance")


@check(
    "c3_chunk_semantic",
    f"""WITH {DISTANCES_SQL},
    marked AS (SELECT doc_id, sent, sentence, coalesce((distance > round(quantile_cont(distance, 0.9) OVER (PARTITION BY doc_id), 6)
      AND count(*) OVER (PARTITION BY doc_id) >= 3)::INT, 0) AS breaks FROM distances),
    placed AS (SELECT *, coalesce(sum(breaks) OVER (PARTITION BY doc_id ORDER BY sent ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS segment FROM marked),
    segments AS (SELECT doc_id, segment, {TOKENS_SQL.format("string_agg(sentence, ' ' ORDER BY sent)")} AS t FROM placed GROUP BY ALL),
    {_pieces_sql('parts', 'segments', 'doc_id, segment', 't', 300, 0, 'part')}
    SELECT doc_id, segment::INT AS segment, part, md5(array_to_string(toks, ' ')) AS text_md5, len(toks)::INT AS n_tokens FROM parts""",
)
def c3(spark, sf):
    return chunking.chunk_semantic(documents(spark, sf)).select("doc_id", "segment", "part", _md5("text").alias("text_md5"), "n_tokens")


def make_count_model():
    """A tiny embedding model: how often some letters occur."""

    def model(texts):
        return [[float(t.lower().count(c)) for c in "etaoinsr"] for t in texts]

    return model


_COUNTS_SQL = "[" + ", ".join(f"(length(t) - length(replace(t, '{c}', '')))::DOUBLE" for c in "etaoinsr") + "]"


@check(
    "c3_chunk_model",
    f"""WITH sents AS (SELECT doc_id, unnest(l) AS sentence, generate_subscripts(l, 1) - 1 AS sent FROM (SELECT doc_id, {SENTENCES_SQL.format(t='text')} AS l FROM documents)),
    vectors AS (SELECT doc_id, sent, sentence, {_COUNTS_SQL} AS v FROM (SELECT *, lower(string_agg(sentence, ' ') OVER
      (PARTITION BY doc_id ORDER BY sent ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)) AS t FROM sents)),
    pairs AS (SELECT *, lead(v) OVER (PARTITION BY doc_id ORDER BY sent) AS w FROM vectors),
    distances AS (SELECT doc_id, sent, sentence, CASE WHEN w IS NOT NULL THEN round(1 - coalesce(list_inner_product(v, w) /
      nullif(sqrt(list_inner_product(v, v)) * sqrt(list_inner_product(w, w)), 0), 0), 6) END AS distance FROM pairs),
    marked AS (SELECT doc_id, sent, sentence, coalesce((distance > round(quantile_cont(distance, 0.9) OVER (PARTITION BY doc_id), 6)
      AND count(*) OVER (PARTITION BY doc_id) >= 3)::INT, 0) AS breaks FROM distances),
    placed AS (SELECT *, coalesce(sum(breaks) OVER (PARTITION BY doc_id ORDER BY sent ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS segment FROM marked),
    segments AS (SELECT doc_id, segment, {TOKENS_SQL.format("string_agg(sentence, ' ' ORDER BY sent)")} AS t FROM placed GROUP BY ALL),
    {_pieces_sql('parts', 'segments', 'doc_id, segment', 't', 300, 0, 'part')}
    SELECT doc_id, segment::INT AS segment, part, md5(array_to_string(toks, ' ')) AS text_md5, len(toks)::INT AS n_tokens FROM parts""",
)
def c3_model(spark, sf):
    """Semantic chunks by the vectors of an injected model."""
    cut = chunking.chunk_semantic(documents(spark, sf), make_model=make_count_model)
    return cut.select("doc_id", "segment", "part", _md5("text").alias("text_md5"), "n_tokens")


def make_length_model():
    """A tiny embedding model: character and word counts."""

    def model(texts):
        return [[float(len(t)), float(len(t.split(" "))), 1.0] for t in texts]

    return model


@check(
    "e1_embed_model",
    f"""WITH {CHUNKS_SQL} SELECT chunk_id, length(text)::DOUBLE AS n_chars, (length(text) - length(replace(text, ' ', '')) + 1)::DOUBLE AS n_words,
    3::BIGINT AS dim FROM chunks""",
)
def e1(spark, sf):
    made = embedding.embed(chunking.chunk_fixed(documents(spark, sf)).select("chunk_id", "text"), make_length_model)
    at = lambda i: F.col("embedding")[i].cast("double")
    return made.select("chunk_id", at(0).alias("n_chars"), at(1).alias("n_words"), F.size("embedding").cast("long").alias("dim"))


@check(
    "e2_embed_hash",
    f"WITH {CHUNKS_SQL}, {IDF_SQL}, {_unit_sql('chunk_vec', 'tf', 'chunk_id')} SELECT chunk_id, bucket, round(w, 6) AS weight FROM chunk_vec",
)
def e2(spark, sf):
    vectors = document_index(spark, sf).vectors
    entries = vectors.select("chunk_id", F.explode(F.arrays_zip("buckets", "weights")).alias("e"))
    weight = F.round(F.col("e.weights").cast("double"), 6)
    return entries.select("chunk_id", F.col("e.buckets").cast("long").alias("bucket"), weight.alias("weight"))


@check(
    "e2_term_idf",
    f"WITH {CHUNKS_SQL}, {IDF_SQL} SELECT term, df, round(idf, 6) AS idf FROM idf",
)
def e2_idf(spark, sf):
    return document_index(spark, sf).terms.select("term", "df", F.round("idf", 6).alias("idf"))


@check(
    "e3_validate_vectors",
    """SELECT vec_id, CASE vec_id % 11 WHEN 1 THEN 'missing' WHEN 2 THEN 'wrong size' WHEN 3 THEN 'not finite' WHEN 4 THEN 'zero norm'
    WHEN 5 THEN 'null value' ELSE 'accepted' END AS fault FROM embeddings""",
)
def e3(spark, sf):
    kind, v = F.col("vec_id") % 11, F.col("embedding")
    nothing = F.lit(None).cast("float")
    damaged = (
        F.when(kind == 2, F.slice(v, 1, 63))
        .when(kind == 3, F.transform(v, lambda x, i: F.when(i == 7, F.lit(float("nan")).cast("float")).otherwise(x)))
        .when(kind == 4, F.transform(v, lambda x: F.lit(0.0).cast("float")))
        .when(kind == 5, F.transform(v, lambda x, i: F.when(i == 7, nothing).otherwise(x)))
        .when(kind != 1, v)
    )
    good, bad = embedding.validate_vectors(table(spark, sf, "embeddings").select("vec_id", damaged.alias("embedding")), 64)
    return good.select("vec_id", F.lit("accepted").alias("fault")).unionByName(bad.select("vec_id", "fault"))


CENTERS_SQL = "centers AS (SELECT label, list_transform(range(64), lambda i: 0.0 + (label * 31 + i * 17) % 23 - 11) AS center FROM (SELECT DISTINCT label FROM embeddings))"


def _against_center(spark, sf):
    """Each vector beside a fixed direction of its label."""
    label = F.col("label")
    center = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: ((label * 31 + i * 17) % 23 - 11).cast("double"))
    return table(spark, sf, "embeddings").withColumn("center", center)


@check(
    "e4_cosine",
    f"""WITH {CENTERS_SQL} SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], center::DOUBLE[]), 6) AS score FROM embeddings JOIN centers USING (label)""",
)
def e4(spark, sf):
    return _against_center(spark, sf).select("vec_id", F.round(embedding.cosine(F.col("embedding"), F.col("center")), 6).alias("score"))


@check(
    "e5_euclidean",
    f"""WITH {CENTERS_SQL} SELECT vec_id, round(list_distance(embedding::DOUBLE[], center::DOUBLE[]), 6) AS distance FROM embeddings JOIN centers USING (label)""",
)
def e5(spark, sf):
    return _against_center(spark, sf).select("vec_id", F.round(embedding.euclidean(F.col("embedding"), F.col("center")), 6).alias("distance"))


@check(
    "e6_ingest",
    f"""WITH {CHUNKS_SQL}, {IDF_SQL}, {_unit_sql('chunk_vec', 'tf', 'chunk_id')}, sizes AS (SELECT chunk_id, count(*) AS n_entries FROM chunk_vec GROUP BY 1)
    SELECT chunk_id, lang, md5(text) AS text_md5, n_tokens, coalesce(n_entries, 0) AS n_entries FROM chunks LEFT JOIN sizes USING (chunk_id)""",
)
def e6(spark, sf):
    """Every chunk with its vector's size."""
    index = ingest(documents(spark, sf, "lang"), stage_path(spark, "index"), metadata=("lang",), partition_by="lang")
    sizes = index.vectors.select("chunk_id", F.size("buckets").cast("long").alias("n_entries"))
    return index.chunks.select("chunk_id", "lang", _md5("text").alias("text_md5"), "n_tokens").join(sizes, "chunk_id", "left").fillna(0, ["n_entries"])


DIFF_SQL = """old_docs AS (SELECT doc_id, text FROM documents WHERE source <> 'src1'),
  new_docs AS (SELECT doc_id, CASE WHEN source = 'src3' THEN text || '!' ELSE text END AS text FROM documents WHERE source <> 'src2'),
  diff AS (SELECT doc_id, CASE WHEN o.doc_id IS NULL THEN 'new' WHEN n.doc_id IS NULL THEN 'removed' WHEN o.text <> n.text THEN 'changed'
    ELSE 'unchanged' END AS status FROM old_docs o FULL JOIN new_docs n USING (doc_id))"""


def _diff(spark, sf):
    """One source came, one went, one was edited."""
    docs, source = documents(spark, sf, "source"), F.col("source")
    edited = F.when(source == "src3", F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    old = docs.filter(source != "src1").select("doc_id", "text")
    new = docs.filter(source != "src2").select("doc_id", edited.alias("text"))
    return old, new, diff_ingest(old, new)


@check("e7_diff_ingest", f"WITH {DIFF_SQL} SELECT doc_id, status FROM diff")
def e7(spark, sf):
    return _diff(spark, sf)[2]


@check("e7_to_rebuild", f"WITH {DIFF_SQL} SELECT doc_id, md5(n.text) AS text_md5 FROM diff JOIN new_docs n USING (doc_id) WHERE status IN ('new', 'changed')")
def e7_rebuild(spark, sf):
    _, new, diff = _diff(spark, sf)
    return to_rebuild(new, diff).select("doc_id", _md5("text").alias("text_md5"))


@check(
    "e7_refresh_chunks",
    f"""WITH {DIFF_SQL}, doc_tokens AS (SELECT doc_id, {TOKENS_SQL.format('text')} AS t FROM new_docs),
    {_pieces_sql('pieces', 'doc_tokens', 'doc_id', 't', 300, 15, 'chunk_idx')}
    SELECT doc_id, chunk_idx, md5(array_to_string(toks, ' ')) AS text_md5 FROM pieces""",
)
def e7_refresh(spark, sf):
    old, new, diff = _diff(spark, sf)
    chunks = stage(chunking.chunk_fixed(old), "chunks")
    return refresh_chunks(chunks, new, stage(diff, "diff")).select("doc_id", "chunk_idx", _md5("text").alias("text_md5"))


@check(
    "e7_refresh_index",
    f"""WITH {DIFF_SQL}, {SCORES_SQL.replace("SELECT doc_id, lang, " + TOKENS_SQL.format('text') + " AS t FROM documents", "SELECT doc_id, '' AS lang, " + TOKENS_SQL.format('text') + " AS t FROM new_docs")},
    {_hits_sql('hits', 3)} SELECT query_id, rank, chunk_id, score, md5(text) AS text_md5 FROM hits JOIN chunks USING (chunk_id)""",
)
def e7_refresh_all(spark, sf):
    """Questions to a refreshed index find what they find in one built anew."""
    old, new, diff = _diff(spark, sf)
    index = refresh_index(ingest(old, stage_path(spark, "index")), new, diff, stage_path(spark, "index"))
    hits = stage(retrieval.retrieve(questions(spark, sf), index, 3), "hits")
    return retrieval.with_texts(hits, index).select("query_id", "rank", "chunk_id", "score", _md5("text").alias("text_md5"))


@check(
    "e7_segments",
    f"""WITH {DIFF_SQL}, {SCORES_SQL.replace("SELECT doc_id, lang, " + TOKENS_SQL.format('text') + " AS t FROM documents", "SELECT doc_id, '' AS lang, " + TOKENS_SQL.format('text') + " AS t FROM new_docs")},
    {_hits_sql('hits', 3)} SELECT query_id, rank, chunk_id, score, md5(text) AS text_md5 FROM hits JOIN chunks USING (chunk_id)""",
)
def e7_segments(spark, sf):
    """Questions to an index of two segments, one of them with tombstones, find what they find in one built anew."""
    old, new, _ = _diff(spark, sf)
    folder = stage_path(spark, "segments")
    add_segment(spark, folder, old)
    add_segment(spark, folder, new, removed=old.join(new, "doc_id", "left_anti"))
    index = load_segments(spark, folder)
    hits = stage(retrieval.retrieve(questions(spark, sf), index, 3), "hits")
    return retrieval.with_texts(hits, index).select("query_id", "rank", "chunk_id", "score", _md5("text").alias("text_md5"))


@check("e7_compacted", f"WITH {DIFF_SQL}, doc_tokens AS (SELECT doc_id, {TOKENS_SQL.format('text')} AS t FROM new_docs), {_pieces_sql('pieces', 'doc_tokens', 'doc_id', 't', 300, 15, 'chunk_idx')}, terms AS (SELECT DISTINCT doc_id, chunk_idx, unnest({TERMS_SQL.format("array_to_string(toks, ' ')")}) AS term FROM pieces) SELECT term, count(*) AS df FROM terms GROUP BY term")
def e7_compacted(spark, sf):
    """Document frequencies of a compacted index: no trace of what was changed or removed."""
    old, new, _ = _diff(spark, sf)
    folder = stage_path(spark, "segments")
    add_segment(spark, folder, old)
    add_segment(spark, folder, new, removed=old.join(new, "doc_id", "left_anti"))
    compact(spark, folder)
    remove_unused(spark, folder)
    return load_segments(spark, folder).terms.select("term", "df")


def make_letter_model():
    """A small embedding model; texts of less than twenty characters break the contract."""

    def model(texts):
        found = [[float(t.lower().count(c)) for c in "etaoinsr"] for t in texts]
        return [v if len(t) >= 20 else [float("nan")] * 8 for v, t in zip(found, texts)]

    return model


_LETTERS_SQL = "[" + ", ".join(f"(length({{t}}) - length(replace({{t}}, '{c}', '')))::DOUBLE" for c in "etaoinsr") + "]"
MODEL_SQL = f"""{CHUNKS_SQL}, model_vectors AS (SELECT chunk_id, lang, length(text) AS n, {_LETTERS_SQL.format(t='lower(text)')} AS v FROM chunks),
  accepted AS (SELECT * FROM model_vectors WHERE n >= 20 AND list_sum(v) > 0),
  asked_model AS (SELECT item_id AS query_id, {_LETTERS_SQL.format(t='lower(text)')} AS v FROM benchmark WHERE length(text) >= 20),
  model_scores AS (SELECT query_id, chunk_id, round(list_cosine_similarity(a.v, c.v), 6) AS score FROM asked_model a, accepted c),
  model_hits AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id))::INT AS rank, chunk_id, score FROM model_scores QUALIFY rank <= 3)"""


def _model_index(spark, sf):
    return ingest(documents(spark, sf, "lang"), stage_path(spark, "index"), metadata=("lang",), partition_by="lang", dim=8, make_model=make_letter_model)


@check("e6_ingest_model", f"WITH {MODEL_SQL} SELECT chunk_id, lang, array_to_string(list_transform(v, lambda x: x::BIGINT), ',') AS vector FROM accepted")
def e6_model(spark, sf):
    vectors = _model_index(spark, sf).vectors
    return vectors.select("chunk_id", "lang", F.array_join(F.transform("embedding", lambda x: x.cast("long").cast("string")), ",").alias("vector"))


@check("e6_rejects", f"WITH {MODEL_SQL} SELECT chunk_id, CASE WHEN n < 20 THEN 'not finite' ELSE 'zero norm' END AS fault FROM model_vectors WHERE n < 20 OR list_sum(v) = 0")
def e6_rejects(spark, sf):
    return _model_index(spark, sf).rejects.select("chunk_id", "fault")


@check("r1_retrieve_model", f"WITH {MODEL_SQL} SELECT query_id, rank, chunk_id, score, md5(text) AS text_md5 FROM model_hits JOIN chunks USING (chunk_id)")
def r1_model(spark, sf):
    index = _model_index(spark, sf)
    hits = stage(retrieval.retrieve(questions(spark, sf), index, 3), "hits")
    return retrieval.with_texts(hits, index).select("query_id", "rank", "chunk_id", "score", _md5("text").alias("text_md5"))


@check("e8_ingest_report", f"WITH {DIFF_SQL} SELECT status, count(*) AS n_docs FROM diff GROUP BY status")
def e8(spark, sf):
    return ingest_report(_diff(spark, sf)[2])


def _nearest_sql(score: str, order: str) -> str:
    return f"""SELECT query_id, rank, vec_id, score FROM (SELECT q.vec_id AS query_id, c.vec_id, round({score}, 6) AS score,
      (row_number() OVER (PARTITION BY q.vec_id ORDER BY round({score}, 6) {order}, c.vec_id))::INT AS rank FROM
      (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) q, (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) c) WHERE rank <= 3"""


COSINE_SQL = _nearest_sql("list_cosine_similarity(q.v, c.v)", "DESC")


def _as_queries(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")


@check("j4_topk_retrieve", COSINE_SQL)
def j4(spark, sf):
    return top_k(table(spark, sf, "embeddings"), _as_queries(spark, sf), 3, id_col="vec_id")


@check("j4_topk_euclidean", _nearest_sql("list_distance(q.v, c.v)", "ASC"))
def j4_euclidean(spark, sf):
    return top_k(table(spark, sf, "embeddings"), _as_queries(spark, sf), 3, "euclidean", id_col="vec_id")


@check("v4_topk_grid", COSINE_SQL)
def v4(spark, sf):
    """The same search by the block grid that serves any number of questions."""
    return top_k(table(spark, sf, "embeddings"), _as_queries(spark, sf), 3, id_col="vec_id", max_queries=64)


@check("r4_retrieve_cells", COSINE_SQL)
def r4(spark, sf):
    cells = retrieval.Cells.build(table(spark, sf, "embeddings"), stage_path(spark, "cells"), 16, "vec_id")
    return cells.search(_as_queries(spark, sf), 3)


@check("r4_retrieve_coded", COSINE_SQL)
def r4_coded(spark, sf):
    """All lists looked into and as many codes scored again as the small table has rows: the exact hits."""
    coded = build_coded(table(spark, sf, "embeddings").select("vec_id", "embedding"), stage_path(spark, "coded"), id_col="vec_id", n_lists=16)
    return coded.search(_as_queries(spark, sf), 3, n_probe=16, rescored=200)


@check("r4_recall", f"SELECT count(DISTINCT query_id) AS n_questions, true AS enough FROM ({COSINE_SQL})")
def r4_recall(spark, sf):
    """Of the exact hits at least nine in ten are found by looking into three quarters of the lists."""
    vectors, asked = table(spark, sf, "embeddings").select("vec_id", "embedding"), _as_queries(spark, sf)
    coded = build_coded(vectors, stage_path(spark, "coded"), id_col="vec_id")
    found = coded.search(asked, 3, n_probe=round(0.75 * len(coded.book.centers)), rescored=40)
    measured = recall(found, top_k(vectors, asked, 3, id_col="vec_id"), id_col="vec_id")
    return measured.agg(F.count("*").alias("n_questions"), (F.sum("n_found") / F.sum("n_exact") >= 0.9).alias("enough"))


@check("j4_text_retrieve", f"WITH {HITS_SQL} SELECT query_id, rank, chunk_id, score FROM hits")
def j4_text(spark, sf):
    return retrieval.retrieve(questions(spark, sf), document_index(spark, sf), 3)


@check(
    "r1_retrieve_semantic",
    f"WITH {SCORES_SQL}, {_hits_sql('hits', 5)} SELECT query_id, rank, chunk_id, score, md5(text) AS text_md5 FROM hits JOIN chunks USING (chunk_id)",
)
def r1(spark, sf):
    index = document_index(spark, sf)
    hits = stage(retrieval.retrieve(questions(spark, sf), index, 5), "hits")
    return retrieval.with_texts(hits, index).select("query_id", "rank", "chunk_id", "score", _md5("text").alias("text_md5"))


@check(
    "f5_retrieve_filtered",
    f"""WITH {SCORES_SQL}, in_lang AS (SELECT s.* FROM scores s JOIN chunks USING (chunk_id) WHERE lang = 'en'),
    {_hits_sql('hits', 3, 'in_lang')} SELECT query_id, rank, chunk_id, score FROM hits""",
)
def f5_filtered(spark, sf):
    return retrieval.retrieve(questions(spark, sf), document_index(spark, sf), 3, where=F.col("lang") == "en")


@check(
    "v5_retrieve_one",
    f"""WITH {HITS_SQL} SELECT rank, chunk_id, score FROM hits
    WHERE query_id = (SELECT item_id FROM benchmark ORDER BY length(text) DESC, item_id LIMIT 1)""",
)
def v5(spark, sf):
    longest = questions(spark, sf).orderBy(F.length("question").desc(), "query_id").first()["question"]
    return retrieval.retrieve_one(document_index(spark, sf), longest).select("rank", "chunk_id", "score")


HIERARCHY_SQL = f"""doc_tokens AS (SELECT doc_id, {TOKENS_SQL.format('text')} AS t FROM documents),
  {_pieces_sql('parents', 'doc_tokens', 'doc_id', 't', 1000, 50, 'parent_idx')},
  {_pieces_sql('children', 'parents', 'doc_id, parent_idx', 'toks', 500, 50, 'child_idx')},
  chunks AS (SELECT doc_id || '#' || parent_idx || '#' || child_idx AS chunk_id, array_to_string(toks, ' ') AS text FROM children)"""


@check(
    "c2_retrieve_parents",
    f"""WITH {SCORES_SQL.replace(CHUNKS_SQL, HIERARCHY_SQL)},
    parent_scores AS (SELECT query_id, array_to_string(string_split(chunk_id, '#')[:2], '#') AS chunk_id, max(score) AS score FROM scores GROUP BY ALL),
    {_hits_sql('hits', 3, 'parent_scores')} SELECT query_id, rank, chunk_id AS parent_id, score FROM hits""",
)
def c2_parents(spark, sf):
    index = ingest(documents(spark, sf), stage_path(spark, "index"), chunker=chunking.chunk_hierarchical)
    return retrieval.retrieve_parents(questions(spark, sf), index, 3)


SMALL_HIERARCHY_SQL = f"""doc_tokens AS (SELECT doc_id, {TOKENS_SQL.format('text')} AS t FROM documents),
  {_pieces_sql('parents', 'doc_tokens', 'doc_id', 't', 400, 0, 'parent_idx')},
  {_pieces_sql('children', 'parents', 'doc_id, parent_idx', 'toks', 20, 0, 'child_idx')},
  chunks AS (SELECT doc_id || '#' || parent_idx || '#' || child_idx AS chunk_id, array_to_string(toks, ' ') AS text FROM children)"""


@check(
    "c2_retrieve_parents_small",
    f"""WITH {SCORES_SQL.replace(CHUNKS_SQL, SMALL_HIERARCHY_SQL)},
    parent_scores AS (SELECT query_id, array_to_string(string_split(chunk_id, '#')[:2], '#') AS chunk_id, max(score) AS score FROM scores GROUP BY ALL),
    {_hits_sql('hits', 3, 'parent_scores')} SELECT query_id, rank, chunk_id AS parent_id, score FROM hits""",
)
def c2_parents_small(spark, sf):
    """Parents of twenty children each."""
    chunker = partial(chunking.chunk_hierarchical, parent_tokens=400, child_tokens=20, overlap=0)
    return retrieval.retrieve_parents(questions(spark, sf), ingest(documents(spark, sf), stage_path(spark, "index"), chunker=chunker), 3)


BM25_SQL = """lengths AS (SELECT chunk_id, sum(tf) AS n FROM tf GROUP BY 1),
  all_lengths AS (SELECT chunk_id, coalesce(n, 0) AS n FROM chunks LEFT JOIN lengths USING (chunk_id)),
  lexical AS (SELECT query_id, chunk_id, round(sum(idf * tf.tf * 2.2 / (tf.tf + 1.2 * (0.25 + 0.75 * n / (SELECT avg(n) FROM all_lengths)))), 6) AS score
    FROM asked_tf JOIN idf USING (term) JOIN tf USING (term) JOIN lengths USING (chunk_id) GROUP BY ALL)"""


@check("r2_retrieve_lexical", f"WITH {SCORES_SQL}, {BM25_SQL}, {_hits_sql('hits', 3, 'lexical')} SELECT query_id, rank, chunk_id, score FROM hits")
def r2_lexical(spark, sf):
    return retrieval.retrieve_lexical(questions(spark, sf), document_index(spark, sf), 3)


@check("r2_retrieve_pruned", f"WITH {SCORES_SQL}, {BM25_SQL}, {_hits_sql('hits', 3, 'lexical')} SELECT query_id, rank, chunk_id, score FROM hits")
def r2_pruned(spark, sf):
    return retrieval.retrieve_lexical(questions(spark, sf), document_index(spark, sf), 3, direct=0)


@check(
    "r2_retrieve_hybrid",
    f"""WITH {SCORES_SQL}, {BM25_SQL}, {_hits_sql('near', 30)}, {_hits_sql('words', 30, 'lexical')},
    fused AS (SELECT query_id, chunk_id, round(sum(1 / (60 + rank)), 6) AS score FROM (FROM near UNION ALL FROM words) GROUP BY ALL),
    {_hits_sql('hits', 3, 'fused')} SELECT query_id, rank, chunk_id, score FROM hits""",
)
def r2(spark, sf):
    return retrieval.retrieve_hybrid(questions(spark, sf), document_index(spark, sf), 3)


def _overlap_sql(question: str, text: str) -> str:
    q, t = f"list_distinct({TERMS_SQL.format(question)})", f"list_distinct({TERMS_SQL.format(text)})"
    return f"round(CASE WHEN len({q}) > 0 THEN len(list_intersect({q}, {t})) / len({q}) ELSE 0 END, 6)"


@check(
    "r3_rerank",
    f"""WITH {SCORES_SQL}, {_hits_sql('near', 12)}, scored AS (SELECT query_id, chunk_id, {_overlap_sql('question', 'text')} AS score
      FROM near JOIN chunks USING (chunk_id) JOIN asked USING (query_id))
    SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id))::INT AS rank, chunk_id, score FROM scored QUALIFY rank <= 3""",
)
def r3(spark, sf):
    index = document_index(spark, sf)
    asked = questions(spark, sf)
    hits = stage(retrieval.retrieve(asked, index, 12), "hits")
    candidates = retrieval.with_texts(hits, index).drop("rank", "score").join(asked, "query_id")
    return retrieval.rerank(candidates, 3).select("query_id", "rank", "chunk_id", "score")


def _contained_sql(question: str, text: str) -> str:
    q = f"list_distinct({TERMS_SQL.format(question)})"
    return f"round(CASE WHEN len({q}) > 0 THEN len(list_filter({q}, lambda t: contains(lower({text}), t))) / len({q}) ELSE 0 END, 6)"


@check(
    "r3_rerank_model",
    f"""WITH {SCORES_SQL}, {_hits_sql('near', 12)}, scored AS (SELECT query_id, chunk_id, {_contained_sql('question', 'text')} AS score
      FROM near JOIN chunks USING (chunk_id) JOIN asked USING (query_id))
    SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id))::INT AS rank, chunk_id, score FROM scored QUALIFY rank <= 3""",
)
def r3_model(spark, sf):
    """Candidates scored in batches by a model made once in a task."""
    index = document_index(spark, sf)
    asked = questions(spark, sf)
    hits = stage(retrieval.retrieve(asked, index, 12), "hits")
    candidates = retrieval.with_texts(hits, index).drop("rank", "score").join(asked, "query_id")
    return retrieval.rerank(candidates, 3, make_scorer=retrieval.make_term_scorer).select("query_id", "rank", "chunk_id", "score")


CONTEXT_SQL = f"""{HITS_SQL}, contexts AS (SELECT query_id, 'Answer clearly using the citations.' || chr(10) || chr(10) ||
  string_agg('[' || rank || '] ' || text, chr(10) ORDER BY rank) AS prompt, count(*) AS n_citations, string_agg(chunk_id, ',' ORDER BY rank) AS cited
  FROM hits JOIN chunks USING (chunk_id) GROUP BY query_id)"""


@check("r5_build_context", f"WITH {CONTEXT_SQL} SELECT query_id, md5(prompt) AS prompt_md5, cited FROM contexts")
def r5(spark, sf):
    index = document_index(spark, sf)
    hits = stage(retrieval.retrieve(questions(spark, sf), index, 3), "hits")
    contexts = answering.build_context(retrieval.with_texts(hits, index))
    return contexts.select("query_id", _md5("prompt").alias("prompt_md5"), F.array_join("citations.chunk_id", ",").alias("cited"))


ANSWERS_SQL = f"""{CONTEXT_SQL}, answers AS (SELECT query_id, question, '[stub] ' || trim(coalesce(prompt, '') || chr(10) || chr(10) || 'Question: ' || question, E' \\n') AS answer,
  coalesce(n_citations, 0) AS n_citations, coalesce(cited, '') AS cited FROM asked LEFT JOIN contexts USING (query_id))"""


def _flat_answers(df):
    return answering.n_citations(df).select(
        "query_id", "answer", F.col("n_citations").cast("long").alias("n_citations"), F.array_join("citations.chunk_id", ",").alias("cited")
    )


@check("r6_answer", f"WITH {ANSWERS_SQL} SELECT query_id, answer, n_citations, cited FROM answers")
def r6(spark, sf):
    return _flat_answers(answering.answer(questions(spark, sf), document_index(spark, sf), make_stub))


@check("g6_n_citations", f"WITH {ANSWERS_SQL} SELECT n_citations, count(*) AS n_answers FROM answers GROUP BY 1")
def g6(spark, sf):
    counted = answering.n_citations(answering.answer(questions(spark, sf), document_index(spark, sf), make_stub))
    return counted.groupBy(F.col("n_citations").cast("long").alias("n_citations")).agg(F.count("*").alias("n_answers"))


@check(
    "r7_answer_extractive",
    f"""WITH {HITS_SQL}, sents AS (SELECT query_id, question, rank, chunk_id, unnest(l) AS answer, generate_subscripts(l, 1) - 1 AS pos FROM (
      SELECT *, {SENTENCES_SQL.format(t='text')} AS l FROM hits JOIN chunks USING (chunk_id) JOIN asked USING (query_id))),
    scored AS (SELECT *, {_overlap_sql('question', 'answer')} AS score FROM sents)
    SELECT query_id, rank, chunk_id, pos::INT AS pos, answer, score FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, rank, pos) = 1""",
)
def r7(spark, sf):
    index = document_index(spark, sf)
    asked = questions(spark, sf)
    hits = retrieval.with_texts(stage(retrieval.retrieve(asked, index, 3), "hits"), index)
    return answering.answer_extractive(asked, hits.drop("score"))
