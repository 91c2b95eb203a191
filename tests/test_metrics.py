import numpy as np
import pytest
from pyspark.sql import functions as F

from citemill.operators import metrics as mt
from citemill.sources import tables as src

LOG = "failed boolean, latency_ms double, ts timestamp"


def test_known_figures(spark):
    row = mt.query_metrics(src.query_events(spark, "/root/testdata/sf0.01")).first()
    assert (row.total_queries, row.failed_queries, row.successful_queries) == (10000, 2014, 7986)
    assert (row.success_rate, row.avg_latency_ms, row.p95_latency_ms) == (79.86, 39.64, 147.35)


def test_empty_log_gives_zeros(spark):
    row = mt.query_metrics(spark.createDataFrame([], LOG)).first()
    assert tuple(row) == (0, 0, 0, 0.0, 0.0, 0.0)


def test_all_failed(spark):
    log = spark.createDataFrame([(True, 5.0, None)], LOG)
    assert tuple(mt.query_metrics(log).first()) == (1, 0, 1, 0.0, 0.0, 5.0)


@pytest.mark.parametrize("p", [0.0, 0.5, 0.95, 0.999, 1.0])
@pytest.mark.parametrize("kind", ["spread", "copies", "few"])
def test_percentile_equals_numpy(spark, p, kind):
    n = {"spread": 400_000, "copies": 300_000, "few": 7}[kind]
    value = F.pmod(F.xxhash64("id"), F.lit(10_000_019)) / 7.0
    if kind == "copies":
        value = F.when(F.col("id") % 3 > 0, F.lit(42.0)).otherwise(value)
    rows = spark.range(n).select(value.cast("double").alias("v"))
    want = np.quantile(rows.toPandas()["v"].to_numpy(), p)
    assert mt.percentile(rows, "v", p) == pytest.approx(want, rel=1e-12)


def test_percentile_of_nothing_and_of_wild_values(spark):
    assert mt.percentile(spark.createDataFrame([(None,)], "v double"), "v", 0.5) is None
    wild = [(x,) for x in (-1e300, 1e-300, -0.0, 0.0, 5e-324, -5e-324, 1e300, 2.0, None)] * 3
    rows = spark.createDataFrame(wild, "v double")
    want = np.quantile([x for (x,) in wild if x is not None], 0.4)
    assert mt.percentile(rows, "v", 0.4) == pytest.approx(want)


def test_few_bits_a_round_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(mt, "_DIGIT", 3)
    monkeypatch.setattr(mt, "_FEW", 0)
    rows = spark.range(5000).select((F.pmod(F.xxhash64("id"), F.lit(997)) / 3.0).alias("v"))
    want = np.quantile(rows.toPandas()["v"].to_numpy(), 0.95)
    assert mt.percentile(rows, "v", 0.95) == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("p", [0.0, 0.5, 0.95, 1.0])
@pytest.mark.parametrize("digit", [6, 18])
def test_percentiles_by_key_equal_numpy(spark, monkeypatch, p, digit):
    monkeypatch.setattr(mt, "_DIGIT", digit)
    hash = F.pmod(F.xxhash64("id"), F.lit(10_007))
    key = F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") < 9, "few").otherwise(F.concat(F.lit("k"), hash % 5))
    value = F.when(F.col("id") % 7 == 0, F.lit(42.0)).when(F.col("id") % 1001 > 0, hash / 7.0 - 300)
    rows = spark.range(20_000).select(key.alias("key"), value.alias("v"), (F.col("id") % 3 + 1).alias("n"))
    given = rows.toPandas().dropna()
    want = {k: np.quantile(np.repeat(g["v"].to_numpy(), g["n"]), p) for k, g in given.groupby("key")}
    found = {x.key: x.value for x in mt.percentiles(rows, p).collect()}
    assert found.keys() == want.keys() and all(found[k] == pytest.approx(want[k], rel=1e-12) for k in want)
    assert mt.percentiles(rows.limit(0), p).isEmpty()


def test_no_group_holds_all_its_latencies(spark):
    log = src.query_events(spark, "/root/testdata/sf0.01")
    plan = mt.daily_metrics(log)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan
    exact = log.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(mt.latency_percentile())
    found = mt.daily_metrics(log).select("day", "p95_latency_ms")
    assert found.exceptAll(exact).isEmpty() and exact.exceptAll(found).isEmpty()


def test_daily_totals_add_up(spark):
    log = src.query_events(spark, "/root/testdata/sf0.01")
    days = mt.daily_metrics(log)
    assert days.count() == 30
    assert days.agg(F.sum("total_queries"), F.sum("failed_queries")).first() == (10000, 2014)


def test_query_log_keeps_queries_without_hits(spark):
    asked = spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0)], "q_id bigint, query string, latency_ms double")
    hits = spark.createDataFrame([(1, "x"), (1, "y")], "q_id bigint, chunk_id string")
    rows = sorted(tuple(r) for r in mt.query_log(asked, hits).collect())
    assert rows == [(1, "a", 2.0, 2), (2, "b", 3.0, 0)]
