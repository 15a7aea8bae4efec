"""Archives: what is written comes back, through the index, with copies as revisits."""

import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.llm import warc
from paperloom.llm.files import shared_folder

LONG = "<p>long</p>" * 400_000

ROWS = [
    (5, "http://b.org/x?y=1#z", "same", "k"),
    (3, "http://B.org/x?y=1", "same", "k"),
    (9, "https://www.a.example:8080", None, None),
    (8, None, "", "k"),
    (None, "no url", "same", "k"),
    (7, "http://b.org/x y\n", "ä😀\r\n\r\n\x00", "k"),
    (6, "http://a.b.org/", LONG, "k"),
    (4, "", "once", "k"),
    (4, "", "once", "k"),
    (4, "", "once", "other"),
    (None, None, "only", None),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id bigint, url string, html string, digest string")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def read_back(spark, pages, tmp_path, **options):
    archive = warc.write_archive(pages, f"file://{tmp_path}/archive", **options)
    return archive, warc.resolve_revisits(warc.read_records(archive, warc.find_captures(archive, pages))).collect()


def test_round_trip(spark, pages, tmp_path):
    _, got = read_back(spark, pages, tmp_path)
    payloads = [(r[2] or "").encode() for r in ROWS]
    assert sorted(bytes(r["payload"]) for r in got) == sorted(payloads)
    assert all(r["payload_bytes"] == len(r["payload"]) and r["payload_digest"] == digest(bytes(r["payload"])) for r in got)
    assert all(r["intact"] for r in got if r["record_type"] == "response") and len({r["record_id"] for r in got}) == len(ROWS)
    kinds = sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in got)
    assert kinds == sorted(
        [("5", "revisit", 3), ("3", "response", None), ("9", "revisit", 8), ("8", "response", None), ("None", "revisit", 3), ("7", "response", None)]
        + [("6", "response", None), ("4", "response", None), ("4", "revisit", 4), ("4", "revisit", 4), ("None", "response", None)]
    )


def test_small_payloads_are_no_revisits(spark, pages, tmp_path):
    _, got = read_back(spark, pages, tmp_path, min_bytes=5)
    assert {r["record_type"] for r in got} == {"response"} and len(got) == len(ROWS)


def test_files_are_standard_archives(spark, pages, tmp_path):
    archive, _ = read_back(spark, pages, tmp_path)
    records = []
    for file in Path(tmp_path, "archive").glob("*.warc.gz"):
        data = gzip.decompress(file.read_bytes())
        while data:
            head, rest = data.split(b"\r\n\r\n", 1)
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            length = int(fields["Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[length : length + 4] == b"\r\n\r\n"
            records.append(fields)
            data = rest[length + 4 :]
    pages_in = [r for r in records if r["WARC-Type"] != "warcinfo"]
    assert len(pages_in) == len(ROWS) and all(r["WARC-Payload-Digest"].startswith("sha1:") for r in pages_in)
    held = {r["WARC-Record-ID"] for r in pages_in if r["WARC-Type"] == "response"}
    assert all(r["WARC-Refers-To"] in held and r["WARC-Profile"] == warc.PROFILE for r in pages_in if r["WARC-Type"] == "revisit")


def test_lookups(spark, pages, tmp_path):
    archive, _ = read_back(spark, pages, tmp_path)
    asked = lambda *urls: sorted(str(r["page_id"]) for r in warc.find_captures(archive, spark.createDataFrame([(u,) for u in urls], "url string")).collect())
    assert asked("http://b.org/x?y=1") == ["3", "5"]
    assert asked("http://b.org/x", "http://zzz.org/", "http://0.a/") == []
    assert asked(None) == ["8", "None"] and asked("", "") == ["4", "4", "4"]
    assert asked("http://b.org/x y\n", "https://www.a.example:8080/") == ["7", "9"]
    assert asked() == []


def test_captures_over_many_blocks_and_files(spark, tmp_path, monkeypatch):
    """A key with a third of all captures, blocks of few lines: nothing is lost, and few blocks are read."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    rows = [(i, "http://hot.org/" if i % 3 == 0 else f"http://h{i % 50}.org/{i}", f"text {i % 400}") for i in range(1500)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    archive, got = read_back(spark, pages, tmp_path)
    assert sorted(r["page_id"] for r in got) == list(range(1500))
    assert all(bytes(r["payload"]).decode() == f"text {r['page_id'] % 400}" for r in got)
    assert {r["page_id"]: r["refers_to"] for r in got} == {i: None if i < 400 else i % 400 for i in range(1500)}
    hot = warc.find_captures(archive, spark.createDataFrame([("http://hot.org/",)], "url string"))
    assert hot.count() == 500 and archive.parts.agg({"n_captures": "sum"}).first()[0] == 1500


def test_directory_finds_the_blocks_of_a_key():
    firsts = ["b", "d", "d", "d", "f"]
    spans = {k: list(warc._span(firsts, k)) for k in ("a", "b", "c", "d", "e", "f", "g")}
    # the block before the first equal key may end with it
    assert spans == {"a": [], "b": [0], "c": [0], "d": [0, 1, 2, 3], "e": [3], "f": [3, 4], "g": [4]}


@given(st.lists(st.text(alphabet="abc", max_size=3), min_size=1, max_size=40), st.integers(1, 6))
@settings(max_examples=200, deadline=None)
def test_spans_hold_every_line(keys, width):
    keys = sorted(keys)
    blocks = [keys[i : i + width] for i in range(0, len(keys), width)]
    for key in {*keys, "", "bb", "d"}:
        seen = [k for b in warc._span([b[0] for b in blocks], key) for k in blocks[b] if k == key]
        assert len(seen) == keys.count(key)


def test_keys():
    assert warc.capture_key("HTTP://User@Www.Example.ORG:80/A?b=/c#d") == "org,example,www:80)/A?b=/c"
    assert warc.capture_key("http://a.b") == "b,a)/" and warc.capture_key("http://a.b?q") == "b,a)/?q"
    assert warc.capture_key("plain text") == "plain%20text" and warc.capture_key(None) == "-" and warc.capture_key("") == ""


def test_an_empty_table(spark, pages, tmp_path):
    archive, got = read_back(spark, pages.filter("1 = 0"), tmp_path)
    assert got == [] and archive.parts.count() == 0
    assert warc.find_captures(archive, pages).count() == 0


def test_folders_are_those_of_spark(spark, tmp_path):
    assert shared_folder(spark, str(tmp_path)) == f"file:{tmp_path}"
    with pytest.raises(Exception):
        shared_folder(spark, "viewfs://none/x")


def test_payloads_are_not_shuffled(spark, pages, tmp_path, capsys):
    """The pass that writes joins a broadcast of the repeated payloads' digests."""
    plans = []
    real = warc.join_unique
    warc.join_unique = lambda *a, **k: plans.append(real(*a, **k)) or plans[-1]
    try:
        warc.write_archive(pages.dropDuplicates(["page_id"]), f"file://{tmp_path}/archive")
    finally:
        warc.join_unique = real
    plans[0].explain()
    text = capsys.readouterr().out
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
