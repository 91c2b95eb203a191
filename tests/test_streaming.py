import datetime as dt
import os
import shutil

from pyspark.sql import functions as F

from citemill.operators import metrics as mt, validate as val
from citemill.plans import pipeline
from citemill.sources import files, querylog, tables as src
from citemill.sources.lake import SnapshotTable
from citemill.streaming import ingest, metrics as running


def test_stream_of_files_equals_one_batch(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    store = SnapshotTable(spark, str(tmp_path / "points"), pipeline.POINTS)
    rejects = SnapshotTable(spark, str(tmp_path / "rejects"), ingest.REJECTS)

    def run():
        arriving = files.uploaded(files.stream(spark, str(inbox), 2))
        ingest.start(arriving, store, rejects, str(tmp_path / "checkpoint")).awaitTermination()

    for i in range(5):
        (inbox / f"{i}.txt").write_text(f"text number {i} " * (10 + 20 * i))
    (inbox / "bad.txt").write_bytes(b"\xff\xfe bad bytes here")
    run()
    commits = store.log().count()
    assert commits == 3
    (inbox / "new.md").write_text("a file that comes later")
    (inbox / "x.csv").write_text("a file nobody can read")
    run()
    run()
    assert store.log().count() == commits + 1

    whole = files.uploaded(
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(inbox))
    )
    accepted, rejected = val.split(whole)
    want = pipeline.points(accepted, dt.datetime(2024, 1, 1)).drop("indexed_at")
    got = store.current().drop("indexed_at", "snapshot_id")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    kept = rejects.read().select("filename", "reject_reason")
    assert kept.exceptAll(rejected.select("filename", "reject_reason")).isEmpty()
    assert {r.reject_reason for r in kept.collect()} == {"bad_encoding", "unsupported_type"}


def test_the_newest_of_equally_named_files_counts(spark, tmp_path):
    inbox = tmp_path / "inbox"
    for n, text in enumerate(["old text, a long one " * 40, "new text of a file", "middle text " * 20]):
        (inbox / str(n)).mkdir(parents=True)
        (inbox / str(n) / "readme.txt").write_text(text)
        os.utime(inbox / str(n) / "readme.txt", (1000 + 10 * (n % 2), 1000 + 10 * (n % 2)))
    store = SnapshotTable(spark, str(tmp_path / "points"), pipeline.POINTS)
    rejects = SnapshotTable(spark, str(tmp_path / "rejects"), ingest.REJECTS)
    arriving = files.uploaded(files.stream(spark, str(inbox), pattern="*.txt"))
    ingest.start(arriving, store, rejects, str(tmp_path / "checkpoint")).awaitTermination()
    assert [r.text for r in store.current().collect()] == ["new text of a file"]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    documents = spark.createDataFrame(
        [("d", "d.txt", "some longer text " * 30, "txt")],
        "doc_id string, filename string, content string, file_type string",
    )
    store = SnapshotTable(spark, str(tmp_path / "points"), pipeline.POINTS)
    now = dt.datetime(2024, 1, 1)
    assert pipeline.upsert(documents, store, now, "s", 0) == 1
    n = store.current().count()
    assert pipeline.upsert(documents, store, now, "s", 0) is None
    assert pipeline.upsert(documents, store, now, "s", 1) == 2
    assert store.current().count() == n and store.read().count() == 2 * n


def test_running_metrics_equal_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    log = tmp_path / "log"
    events.repartition(3).write.parquet(str(log))
    batch = src.as_query_log(events)
    for name, aggregate, want in (
        ("total", running.running_totals, batch.agg(*mt.summary_columns(), mt.latency_percentile())),
        ("daily", running.running_daily, mt.daily_metrics(batch)),
    ):
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
        arriving = src.as_query_log(stream.parquet(str(log)))
        out = str(tmp_path / name)
        running.start(aggregate(arriving), out, str(tmp_path / f"{name}-cp")).awaitTermination()
        got = running.latest(spark, out)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        assert spark.read.parquet(out).select("batch_id").distinct().count() == 3


def test_state_is_kept_by_latency(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    events.repartition(2).write.parquet(str(tmp_path / "log"))
    batch = src.as_query_log(events)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    arriving = src.as_query_log(stream.parquet(str(tmp_path / "log")))
    for name, aggregated, by in (
        ("total", running.running_totals(arriving), ["failed", "latency_ms"]),
        ("daily", running.running_daily(arriving), [F.to_date("ts"), "failed", "latency_ms"]),
    ):
        started = running.start(aggregated, str(tmp_path / name), str(tmp_path / f"{name}-cp"))
        started.awaitTermination()
        (state,) = started.lastProgress["stateOperators"]
        assert state["numRowsTotal"] == batch.select(*by).distinct().count() > 1000


def test_append_mode_closes_days_in_order(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    log = tmp_path / "log"
    for first in range(1, 31, 5):
        part = events.filter(F.dayofmonth("ts").between(first, first + 4)).coalesce(1)
        part.write.mode("append").parquet(str(log))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    arriving = src.as_query_log(stream.parquet(str(log)))
    out = str(tmp_path / "out")
    daily = running.running_daily(arriving, "1 day")
    running.start(daily, out, str(tmp_path / "cp"), "append").awaitTermination()
    got = spark.read.parquet(out).drop("batch_id")
    days = mt.daily_metrics(src.as_query_log(events))
    assert got.exceptAll(days).isEmpty()
    assert got.select(F.count_distinct("day")).first()[0] == got.count() >= 28


def test_metrics_of_a_stored_query_log(spark, tmp_path):
    folder = str(tmp_path / "log")
    asked = "q_id bigint, query string, latency_ms double"
    hits = spark.createDataFrame([(1, "c1"), (1, "c2")], "q_id bigint, chunk_id string")
    now = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)
    good = spark.createDataFrame([(1, "a", 10.0), (2, "b", 30.0)], asked)
    querylog.append(mt.query_log(good, hits), folder, now)
    bad = spark.createDataFrame([(3, "c", 99.0)], asked)
    querylog.append(mt.query_log(bad, hits), folder, now + dt.timedelta(days=1), failed=True)
    stored = querylog.read(spark, folder)
    assert {r.q_id: r.num_results for r in stored.collect()} == {1: 2, 2: 0, 3: 0}
    out = str(tmp_path / "out")
    totals = running.running_totals(querylog.stream(spark, folder))
    running.start(totals, out, str(tmp_path / "cp")).awaitTermination()
    assert tuple(running.latest(spark, out).first()) == (3, 2, 1, 66.67, 13.33, 92.1)
    assert tuple(mt.query_metrics(stored).first())[:5] == (3, 2, 1, 66.67, 13.33)
    assert mt.daily_metrics(stored).count() == 2
    assert mt.query_metrics(stored).first().p95_latency_ms == 92.1


def test_a_new_checkpoint_under_an_old_path_loses_nothing(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "points"), pipeline.POINTS)
    rejects = SnapshotTable(spark, str(tmp_path / "rejects"), ingest.REJECTS)
    for n, text in enumerate(("a first text of some length", "another text of some length")):
        inbox = tmp_path / f"inbox{n}"
        inbox.mkdir()
        (inbox / f"{n}.txt").write_text(text)
        arriving = files.uploaded(files.stream(spark, str(inbox)))
        checkpoint = tmp_path / "checkpoint"
        ingest.start(arriving, store, rejects, str(checkpoint)).awaitTermination()
        shutil.rmtree(checkpoint)
    assert store.log().count() == 2 and store.current().count() == 2
