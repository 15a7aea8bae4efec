import pytest
from pyspark.sql import functions as F

from paperloom.functions.text import flatten_json, sentences, strip, terms, tokens
from paperloom.sources import feedback, objects


@pytest.mark.parametrize(
    "key, content_type, route",
    [
        ("a/B.PDF", None, "pdf"),
        ("a/b.txt", "Application/PDF", "pdf"),
        ("a/b.bin", "text/markdown", "text"),
        ("a/b.bin", "application/json", "text"),
        ("a/b.LOG", None, "text"),
        ("a/b.bin", "", "unsupported"),
        ("a/b.bin", None, "unsupported"),
    ],
)
def test_route_type(value, key, content_type, route):
    got = value(objects.route_type(F.col("k"), F.col("t")), "k string, t string", key, content_type)
    assert got == route


@pytest.mark.parametrize("raw", ["héllo €".encode(), "h\xe9llo".encode("latin-1"), b"", "\U0001f600".encode()])
@pytest.mark.parametrize("encoding", ["utf-8", "latin-1", "ascii"])
def test_decode_text_like_python(value, raw, encoding):
    try:
        want = raw.decode(encoding)
    except UnicodeDecodeError:
        want = raw.decode("latin-1")
    assert value(objects.decode_text(F.col("c"), encoding), "c binary", raw) == want


def _objects(spark):
    rows = [("a.txt", None, b"plain"), ("b.pdf", "application/pdf", b"one\x0c\x0ctwo  "), ("c.xyz", "Image/PNG", b"?"), ("d.xyz", None, b"?")]
    return spark.createDataFrame(rows, "key string, content_type string, content binary")


def _pages(raw):
    return [p or None for p in raw.decode().split("\x0c")]


def test_documents_permissive(spark):
    got = {r["key"]: (r["text"], r["error"]) for r in objects.document_texts(_objects(spark), _pages, "PERMISSIVE").collect()}
    assert got["a.txt"] == ("plain", None)
    assert got["b.pdf"] == ("one\n\ntwo", None)
    failed = "Failed to extract document content from {0}: Unsupported content type for text extraction: {1} (key: {0})"
    assert got["c.xyz"] == (None, failed.format("c.xyz", "image/png"))
    assert got["d.xyz"] == (None, failed.format("d.xyz", "unknown"))


def test_documents_failfast(spark):
    with pytest.raises(Exception, match="Unsupported content type"):
        objects.document_texts(_objects(spark), _pages).collect()


def test_broken_pdf_names_its_key(spark):
    def broken(raw):
        raise ValueError("no header")

    files = spark.createDataFrame([("x.pdf", b"zz")], "key string, content binary")
    assert "x.pdf" in objects.extract_binary_text(files, broken, "PERMISSIVE").first()["error"]
    with pytest.raises(Exception, match="Failed to open PDF document: x.pdf"):
        objects.extract_binary_text(files, broken).collect()


def test_read_list_and_land(spark, tmp_path):
    src, dst = tmp_path / "src", str(tmp_path / "dst")
    src.mkdir()
    (src / "one.txt").write_text("first")
    (src / "two.log").write_text("second")
    found = objects.read_objects(spark, str(src), "*.txt")
    assert [r["length"] for r in found.collect()] == [5]
    objects.land_files(spark, str(src), dst, "policies/")
    objects.land_files(spark, str(src), dst, "claims/")
    landed = spark.read.parquet(dst)
    keys = {r["key"] for r in objects.list_keys(landed, "policies/").collect()}
    assert keys == {"policies/one.txt", "policies/two.log"}
    assert objects.include_prefixes(landed, ["policies/one", "claims/"]).count() == 3
    assert objects.listing_notice(objects.list_keys(landed, "none/")).first()["notice"] == "Content is empty"
    assert objects.listing_notice(landed).first()["notice"] is None


def test_listing_does_not_read_content(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    plan = objects.read_objects(spark, str(tmp_path)).select("key")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_upload_outcome(spark):
    files = spark.createDataFrame(
        [("./data/a.txt", None, b"1"), ("./data/b.txt", "in/b", b"2"), ("gone.txt", None, None)], "file_name string, key string, content binary"
    )
    uploaded, rejected = objects.upload_outcome(files)
    assert sorted(r["key"] for r in uploaded.collect()) == ["./data/a.txt", "in/b"]
    assert [(r["key"], r["reason"]) for r in rejected.collect()] == [("gone.txt", "The file was not found.")]


def test_feedback_log(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([("q\n1", 'a "x"', "up")], "question string, answer string, rating string")
    feedback.append_feedback(rows, path)
    feedback.append_feedback(rows, path)
    (tmp_path / "log" / "part-extra.json").write_text("{broken\n")
    log = feedback.read_feedback(spark, path).collect()
    assert len(log) == 3
    assert sorted((r["question"], r["rating"]) for r in log if r["_corrupt"] is None) == [("q\n1", "up")] * 2


def test_text_expressions(value):
    text = "  One two\tthree. Four?! \n\n five 　"
    assert value(strip("t"), "t string", text) == text.strip()
    assert value(tokens("t"), "t string", "  a b\tc\nd ") == ["a", "b", "c", "d"]
    assert value(terms("t"), "t string", "Ab-C, É1!") == ["ab", "c", "é1"]
    assert value(sentences("t"), "t string", "A b. C?! \n\n... d") == ["A b.", "C?!", "d"]
    assert value(flatten_json("t"), "t string", 'a\nb "c" \\') == '"a b \\"c\\" \\\\"'


def test_input_files_are_written_in_place_by_tasks(spark, tmp_path):
    """A folder a key without a commit that moves each: rows of a key are lines of one file, nulls are empty ones."""
    from paperloom.checks.base import write_files

    rows = [(i, f"text {i}") for i in range(40)] + [(7, "text 7"), (50, None), (None, "é")]
    out = tmp_path / "files"
    write_files(spark.createDataFrame(rows, "doc_id long, value string"), "doc_id", str(out))
    found = {p.parent.name: p.read_text() for p in out.rglob("*") if p.is_file()}
    assert len(found) == 42 and not list(out.rglob("*.crc")) and not list(out.rglob("_*SUCCESS"))
    assert found["doc_id=7"] == "text 7\ntext 7\n" and found["doc_id=50"] == "\n" and found["doc_id=__HIVE_DEFAULT_PARTITION__"] == "é\n"
    write_files(spark.createDataFrame([(7, "again")], "doc_id long, value string"), "doc_id", str(out))
    assert len([p for p in (out / "doc_id=7").iterdir()]) == 2


def test_input_files_lie_together(spark, tmp_path):
    """So many files in a folder, named by their keys; what is written later lies beside them."""
    from paperloom.checks.base import write_files

    rows = [(i, f"text {i}") for i in range(-20, 20)] + [(7, "text 7"), (50, None)]
    for _ in range(2):
        write_files(spark.createDataFrame(rows, "doc_id long, value string"), "doc_id", str(tmp_path / "files"), together=4)
    files = [p for p in (tmp_path / "files").rglob("*") if p.is_file()]
    assert len(files) == 82 and all(len(list(d.iterdir())) <= 4 for d in {p.parent for p in files})
    assert sorted(p.read_text() for p in files if p.name.startswith("doc_id=7-")) == ["text 7\ntext 7\n"] * 2
    assert {p.read_text() for p in files if p.name.startswith("doc_id=50-")} == {"\n"}
    assert len([p for p in files if p.name.startswith("doc_id=-20-")]) == 2
