"""From documents to token ids: one corpus pipeline of five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written and read again as the next one's ``docs``; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import language, mixing, pieces, secrets, simhash
from paperloom.llm.queries import MIX_BUDGET, MIX_SEED, MIX_WEIGHTS, mix_levels, table, tokenizer_file
from paperloom.llm.rows import packed, quoted
from paperloom.staging import stage


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; null texts and texts without a letter go.

    Profiles are learned from the documents' own labels, and a null label is
    filled with the language found. All columns come back as they are, whatever
    their names; texts of any length are read whole, repeated rows stay, and an
    empty table gives an empty one.
    """
    profiles = language.learn_profiles(docs.filter(~language.held_out()))
    others = [c for c in docs.columns if c != "text"]
    told = language.identify_language(docs.select(packed(docs, others), "text"), profiles, keep=["_row", "text"])
    back = {c: F.col(f"_row.{quoted(c)}") for c in others} | {"text": F.col("text"), "lang": F.coalesce("_row.lang", "lang_pred").alias("lang")}
    return told.filter(F.col("lang_pred") != language.UNKNOWN).select(*[back[c] for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of the smallest id.

    Texts without words (null, empty, blank) are one group. Of rows that repeat
    an id one stays, and one of a group of null ids. All columns come back,
    whatever their names; texts of any length are read whole, and an empty
    table gives an empty one.
    """
    return simhash.drop_near_duplicates(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets in its text replaced by a mark; ``n_chars`` is counted anew.

    Null and empty texts stay as they are, and so does the count of a null one.
    Texts of any length are read whole, rows stand for themselves, and all
    other columns come back, whatever their names.
    """
    clean = secrets.redact(docs)
    length = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast("bigint").alias("n_chars")
    return clean.select(*[length if c == "n_chars" else c for c in docs.columns])


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by domain, language and source weights, a row for each reading.

    The document in which a leaf's budget ends stays whole. A source without a
    known domain belongs to the default one, a null language or source is a
    branch of its own. Null and empty texts have no tokens; ids may be null or
    repeated, and of equal rows any is as good. All columns come back, whatever
    their names; an empty table gives an empty one.
    """
    slim = docs.select(packed(docs), "doc_id", "text", "lang", "source")
    mixed = mixing.mix_sources(slim, mix_levels(), MIX_WEIGHTS, MIX_BUDGET, MIX_SEED, keep=["_row"])
    return mixed.select(*[F.col(f"_row.{quoted(c)}") for c in docs.columns])


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document with the bytes of its text that each stands for.

    A null text counts as empty: begin and end ids only. Texts of any length
    are encoded whole, rows stand for themselves. Columns called ``ids``,
    ``starts`` and ``ends`` are replaced, all others but the text come back.
    """
    kept = [c for c in docs.columns if c != "text"]
    return pieces.encode_pieces(docs, tokenizer_file("piece_bpe_32k.model"), keep=kept).drop("decoded")


STAGES = [
    ("language", with_language),
    ("near_copies", without_near_copies),
    ("secrets", without_secrets),
    ("weights", to_weights),
    ("pieces", to_pieces),
]

# profiles, hashes and pieces are out of reach of SQL; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
