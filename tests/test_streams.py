from datetime import datetime, timedelta

import pytest

from paperloom.operators.answers import answer
from paperloom.operators.feedback import feedback_rates
from paperloom.operators.ingest import ingest
from paperloom.operators.invoke import make_stub
from paperloom.operators.screening import apply_policy
from paperloom.streaming import jobs

START = datetime(2024, 5, 1, 8, 0)


def _stream(spark, df, path):
    df.coalesce(1).write.mode("append").parquet(str(path))
    return spark.readStream.schema(df.schema).parquet(str(path))


def _run(stream, tmp_path, name="out"):
    jobs.run_once(stream, str(tmp_path / name), str(tmp_path / f"{name}-progress")).awaitTermination()
    return stream.sparkSession.read.parquet(str(tmp_path / name))


def _clicks(spark, rows):
    made = [("q", a, r, START + timedelta(minutes=m)) for a, r, m in rows]
    return spark.createDataFrame(made, "question string, answer string, rating string, ts timestamp")


def test_screening_a_stream_equals_the_batch(spark, tmp_path):
    rows = spark.createDataFrame([(1, "you moron"), (2, "mail a@b.org"), (3, "fine")], "i long, text string")
    got = _run(jobs.screen_stream(_stream(spark, rows, tmp_path / "in")), tmp_path)
    assert sorted(map(str, got.collect())) == sorted(map(str, apply_policy(rows).collect()))


def test_feedback_hours_equal_the_batch_once_closed(spark, tmp_path):
    clicks = _clicks(spark, [("a", "up", 1), ("a", "down", 5), ("a", "up", 61), ("b", "meh", 62), ("a", "up", 200)])
    got = {r["hour"]: (r["n_up"], r["n_down"], r["n_other"], r["helpful_share"]) for r in _run(jobs.feedback_by_hour(_stream(spark, clicks, tmp_path / "in")), tmp_path).collect()}
    assert got == {START: (1, 1, 0, 0.5), START + timedelta(hours=1): (1, 0, 1, 1.0)}
    assert feedback_rates(clicks).first()["n_up"] == 3


def test_late_click_beyond_the_watermark_is_dropped(spark, tmp_path):
    source = tmp_path / "in"
    stream = jobs.feedback_by_hour(_stream(spark, _clicks(spark, [("a", "up", 1), ("a", "up", 130)]), source))
    _run(stream, tmp_path)
    _stream(spark, _clicks(spark, [("a", "up", 2), ("a", "down", 125), ("a", "up", 300)]), source)
    got = {r["hour"]: (r["n_up"], r["n_down"]) for r in _run(stream, tmp_path).collect()}
    assert got == {START: (1, 0), START + timedelta(hours=2): (1, 1)}


def test_double_clicks_count_once(spark, tmp_path):
    clicks = _clicks(spark, [("a", "up", 1), ("a", "up", 2), ("a", "down", 2), ("b", "up", 2)])
    assert _run(jobs.drop_repeats(_stream(spark, clicks, tmp_path / "in")), tmp_path).count() == 3


def test_a_click_behind_the_watermark_does_not_take_its_repeat_along(spark, tmp_path):
    source = tmp_path / "in"
    stream = jobs.drop_repeats(_stream(spark, _clicks(spark, [("x", "up", 240)]), source))
    _run(stream, tmp_path)
    _stream(spark, _clicks(spark, [("x", "down", 241)]), source)  # moves the watermark on
    _run(stream, tmp_path)
    _stream(spark, _clicks(spark, [("a", "up", 60), ("b", "up", 61)]), source)
    _stream(spark, _clicks(spark, [("a", "up", 245)]), source)
    got = _run(stream, tmp_path).filter("answer = 'a'").collect()
    assert [r["ts"] for r in got] in ([START + timedelta(minutes=245)], [])
    _stream(spark, _clicks(spark, [("c", "up", 246), ("c", "up", 247)]), source)
    assert _run(stream, tmp_path).filter("answer = 'c'").count() == 1


def test_only_new_files_are_ingested(spark, tmp_path):
    src, out, progress = tmp_path / "src", tmp_path / "out", str(tmp_path / "p")
    src.mkdir()
    (src / "a.txt").write_text("one")
    for _ in range(2):
        jobs.ingest_new_files(spark, str(src), str(out), progress).awaitTermination()
    (src / "b.bin").write_bytes(b"\x00")
    (src / "c.txt").write_bytes("zw\xe9i".encode("latin-1"))
    jobs.ingest_new_files(spark, str(src), str(out), progress).awaitTermination()
    got = {r["key"].rsplit("/", 1)[1]: (r["text"], r["error"] is None) for r in spark.read.parquet(str(out)).collect()}
    assert got == {"a.txt": ("one", True), "b.bin": (None, False), "c.txt": ("zwéi", True)}


@pytest.mark.parametrize("n", [2])
def test_answering_a_stream_equals_the_batch(spark, tmp_path, n):
    docs = spark.createDataFrame([(1, "Hail is covered."), (2, "Theft is covered too.")], "doc_id long, text string")
    index = ingest(docs, str(tmp_path / "index"))
    asked = spark.createDataFrame([(1, "hail?"), (2, "theft?")], "query_id long, question string")
    stream = _stream(spark, asked, tmp_path / "in")
    jobs.answer_stream(stream, index, make_stub, str(tmp_path / "out"), str(tmp_path / "p"), n).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("query_id", "answer").collect()
    want = answer(asked, index, make_stub, n).select("query_id", "answer").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_many_small_files_take_few_tasks(spark, tmp_path):
    """Neither what arrived nor its contents take a task for a few files each."""
    src, out = tmp_path / "src", tmp_path / "out"
    src.mkdir()
    for i in range(600):
        (src / f"{i}.txt").write_text(f"text {i}")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    tracker = spark.sparkContext.statusTracker()
    query = jobs.ingest_new_files(spark, str(src), str(out), str(tmp_path / "progress"))
    query.awaitTermination()
    stages = [s for j in tracker.getJobIdsForGroup(str(query.runId)) for s in tracker.getJobInfo(j).stageIds]
    sizes = [info.numTasks for info in map(tracker.getStageInfo, stages) if info]
    assert sizes and max(sizes) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.read.parquet(str(out)).filter("error IS NULL").count() == 600
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
