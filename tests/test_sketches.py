import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from citemill.operators import metrics as mt, sketches as sk
from citemill.plans import pipeline
from citemill.sources import tables as src
from citemill.sources.lake import SnapshotTable
from citemill.streaming import metrics as running

LOG = "failed boolean, latency_ms double, ts timestamp"


def test_ranks_stay_within_the_bound_after_merging(spark):
    value = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7.0
    skewed = F.when(F.col("id") % 3 == 0, F.lit(42.0)).otherwise(value)
    log = spark.range(300_000).select(F.lit(False).alias("failed"), skewed.alias("latency_ms"), (F.col("id") % 50).alias("part"))
    whole = sk.merged(sk.latency_sketches(log, F.col("part")))
    values = np.sort(log.select("latency_ms").toPandas()["latency_ms"].to_numpy())
    for p in (0.05, 0.5, 0.95, 0.99):
        found = whole.select(sk.quantile(p)).first()[0]
        low, high = np.searchsorted(values, found, "left") / len(values), np.searchsorted(values, found, "right") / len(values)
        assert low - 3 * sk.rank_error() <= p <= high + 3 * sk.rank_error()
    assert whole.select(F.octet_length("sketch")).first()[0] < 64_000


def test_counts_are_exact_and_empty_groups_are_zero(spark):
    log = src.query_events(spark, "/root/testdata/sf0.01")
    found = sk.figures(sk.latency_sketches(log)).drop("p95_latency_ms").first()
    assert found == mt.query_metrics(log).drop("p95_latency_ms").first()
    assert tuple(sk.figures(sk.latency_sketches(spark.createDataFrame([], LOG))).first()) == (0, 0, 0, 0.0, 0.0, 0.0)
    nulls = spark.createDataFrame([(True, None, None)], LOG)
    assert tuple(sk.figures(sk.latency_sketches(nulls)).first()) == (1, 0, 1, 0.0, 0.0, 0.0)


def test_a_micro_batch_writes_only_the_days_it_brings(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    for first in range(1, 31, 10):
        events.filter(F.dayofmonth("ts").between(first, first + 9)).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    arriving = src.as_query_log(stream.parquet(str(tmp_path / "log")))
    started = running.start_days(running.running_sketches(arriving, "2 days"), str(tmp_path / "out"), str(tmp_path / "cp"))
    started.awaitTermination()
    per_batch = spark.read.parquet(str(tmp_path / "out")).groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in per_batch if r["count"]) == [10, 10, 10]
    # Days the watermark has passed have left the state.
    (state,) = started.lastProgress["stateOperators"]
    assert state["numRowsTotal"] < 15
    found = running.latest_days(spark, str(tmp_path / "out")).drop("p95_latency_ms")
    want = mt.daily_metrics(src.as_query_log(events)).drop("p95_latency_ms")
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()


def test_commits_are_counted_once(spark, tmp_path):
    rows = lambda a, b: spark.range(a, b).select(F.col("id").cast("string").alias("doc_id"), F.lit(1).alias("v"))
    store, folder = SnapshotTable(spark, str(tmp_path / "t"), rows(0, 1).schema), str(tmp_path / "sketches")
    assert tuple(pipeline.counted(store, folder).first()) == (0, 0)
    store.commit(rows(0, 4000))
    store.commit(rows(2000, 6000))
    vectors, documents = pipeline.counted(store, folder).first()
    assert vectors == 8000 and abs(documents - 6000) <= 4 * sk.distinct_error() * 6000
    reads = store.rows
    store.rows = lambda: (_ for _ in ()).throw(AssertionError("read again"))
    assert tuple(pipeline.counted(store, folder).first()) == (vectors, documents)
    store.rows = reads
    store.commit(rows(0, 10), "overwrite", dt.datetime.now(dt.timezone.utc))
    assert tuple(pipeline.counted(store, folder).first()) == (10, 10)
