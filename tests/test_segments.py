"""An index in segments against one built anew."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paperloom.operators import segments
from paperloom.operators.answers import answer
from paperloom.operators.ingest import ingest
from paperloom.operators.invoke import make_stub
from paperloom.operators.retrieval import retrieve_hybrid
from paperloom.operators.segments import add_segment, compact, latest_manifest, load_segments, remove_unused

WORDS = "hail theft fire water glass storm claim policy driver road night bridge".split()


def _docs(spark, ids, edition=0):
    rows = [(i, " ".join(WORDS[(i * 7 + j * (j + edition)) % len(WORDS)] for j in range(5 + i % 40)), "ab"[i % 2]) for i in ids]
    return spark.createDataFrame(rows, "doc_id long, text string, kind string")


def _size(path):
    return sum(f.stat().st_size for f in Path(path).rglob("*.parquet"))


def _said(spark, index, asked=None):
    """Chunks, frequencies and the hits of some questions."""
    questions = spark.createDataFrame([(1, "hail on the bridge"), (2, "water and fire"), (3, "unknown")], "query_id long, question string")
    hits = sorted(map(tuple, retrieve_hybrid(questions, index, 3).select("query_id", "rank", "chunk_id", "score").collect()))
    chunks = sorted((r["chunk_id"], r["kind"], r["text"]) for r in index.chunks.collect())
    terms = {r["term"]: (r["df"], round(r["idf"], 9)) for r in index.terms.collect()}
    return chunks, terms, hits, index.n_chunks, round(index.mean_terms, 9)


def test_batches_equal_a_full_build(spark, tmp_path):
    folder = str(tmp_path / "index")
    add_segment(spark, folder, _docs(spark, range(60)), metadata=("kind",), batch=0)
    add_segment(spark, folder, _docs(spark, range(50, 90)), batch=1)
    # changed, unchanged, new, removed, and an id that was never there
    came = _docs(spark, range(5), 1).unionByName(_docs(spark, [20, 100]))
    add_segment(spark, folder, came, removed=spark.createDataFrame([(30,), (31,), (999,), (100,)], "doc_id long"), batch=2)
    now = _docs(spark, range(5), 1).unionByName(_docs(spark, [i for i in [*range(5, 90), 100] if i not in (30, 31)]))
    want = _said(spark, ingest(now, str(tmp_path / "anew"), metadata=("kind",)))
    assert _said(spark, load_segments(spark, folder)) == want
    assert [(s.buried, s.n_chunks) for s in latest_manifest(spark, folder).segments] == [(0, 60), (0, 30), (7, -1)]
    # a changed text that changes back, and a document that comes again
    add_segment(spark, folder, _docs(spark, [0, 1, 30]), batch=3)
    again = _docs(spark, range(2, 5), 1).unionByName(_docs(spark, [i for i in [*range(2), *range(5, 90), 100] if i != 31]))
    want = _said(spark, ingest(again, str(tmp_path / "again"), metadata=("kind",)))
    assert _said(spark, load_segments(spark, folder)) == want
    compact(spark, folder)
    manifest = latest_manifest(spark, folder)
    assert len(manifest.segments) == 1 and manifest.batch == 3
    assert remove_unused(spark, folder) == 4 + 4 and len(list(Path(folder, "segments").iterdir())) == 1
    assert _said(spark, load_segments(spark, folder)) == want
    # a batch that is in is not brought in again
    assert add_segment(spark, folder, _docs(spark, range(500)), batch=3) == manifest


def test_bytes_written_follow_the_batch(spark, tmp_path):
    folder = str(tmp_path / "index")
    add_segment(spark, folder, _docs(spark, range(3000)).coalesce(1), metadata=("kind",))
    add_segment(spark, folder, _docs(spark, range(3), 1).coalesce(1))
    first, second = (_size(s.path) for s in latest_manifest(spark, folder).segments)
    assert second < 20_000 < first


def test_a_broken_batch_leaves_the_manifest(spark, tmp_path):
    folder = str(tmp_path / "index")
    add_segment(spark, folder, _docs(spark, range(10)), metadata=("kind",), batch=0)
    before = latest_manifest(spark, folder)
    said = _said(spark, load_segments(spark, folder))

    def broken(cut):
        return _cut(cut).withColumn("text", F.raise_error(F.lit("lost")).cast("string"))

    from paperloom.operators.chunking import chunk_fixed as _cut

    with pytest.raises(Exception, match="lost"):
        add_segment(spark, folder, _docs(spark, range(5, 20), 2), batch=1, chunker=broken)
    assert latest_manifest(spark, folder) == before and _said(spark, load_segments(spark, folder)) == said
    add_segment(spark, folder, _docs(spark, range(5, 20), 2), batch=1)
    assert latest_manifest(spark, folder).number == 2
    remove_unused(spark, folder)
    assert len(list(Path(folder, "segments").iterdir())) == 2


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    folder = str(tmp_path / "index")
    manifest = add_segment(spark, folder, _docs(spark, range(3)), metadata=("kind",))
    with pytest.raises(RuntimeError, match="another job"):
        segments._publish(spark, folder, manifest)
    assert latest_manifest(spark, folder) == manifest and not [n for n in Path(folder).iterdir() if n.name.startswith("draft")]


def test_empty_batches_and_models(spark, tmp_path):
    from paperloom.checks.search_checks import make_letter_model

    folder, none = str(tmp_path / "index"), _docs(spark, [1]).filter("1 = 0")
    add_segment(spark, folder, none, metadata=("kind",))
    index = load_segments(spark, folder)
    assert index.n_chunks == 0 and index.chunks.count() == 0 and index.vectors.count() == 0
    with pytest.raises(ValueError):
        load_segments(spark, str(tmp_path / "none"))
    modelled = str(tmp_path / "modelled")
    add_segment(spark, modelled, _docs(spark, range(6)), dim=8, make_model=make_letter_model)
    add_segment(spark, modelled, _docs(spark, [2, 3], 1), make_model=make_letter_model)
    with pytest.raises(ValueError):
        add_segment(spark, modelled, _docs(spark, [2], 2))
    index = load_segments(spark, modelled, make_letter_model)
    assert index.vectors.count() + index.chunks.count() - 6 == 6
    asked = spark.createDataFrame([(1, "hail and fire")], "query_id long, question string")
    assert answer(asked, index, make_stub, 2).count() == 1
    with pytest.raises(ValueError):
        load_segments(spark, modelled)
