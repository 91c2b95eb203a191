"""Figures of bounded size that can be merged: percentiles and numbers of documents.

A sketch of latencies answers for any percentile with a known error in rank, a sketch of ids for
the number of different ones with a known relative error; both merge, so those of days, sources
and commits give those of any union without a look at the rows. The exact figures are in
``metrics`` and ``tables``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from citemill.operators.metrics import PERCENTILE, day_of

# Parameters of the sketches: a quantile sketch of a few kilobytes, 2 ** 12 registers for ids.
K, LOG_REGISTERS = 800, 12


def rank_error(k: int = K) -> float:
    """How far the rank of a value may be from the one asked for, as a share of all rows.

    Holds for one value with a confidence of 99 %.
    """
    return 2.296 / k**0.9723


def distinct_error(registers: int = LOG_REGISTERS) -> float:
    """The relative standard error of a number of different ids."""
    return 1.04 / 2 ** (registers / 2)


def latency_sketches(log: DataFrame, *by: Column, k: int = K) -> DataFrame:
    """Counts, time spent and a sketch of all latencies for each group; one small row each."""
    spent = F.sum(F.when(~F.col("failed"), F.col("latency_ms")))
    return log.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if("failed").alias("failed"),
        F.coalesce(spent, F.lit(0.0)).alias("spent"),
        F.count("latency_ms").alias("timed"),
        F.kll_sketch_agg_double("latency_ms", k).alias("sketch"),
    )


def merged(sketches: DataFrame, *by: Column) -> DataFrame:
    """The same for larger groups, from those of smaller ones."""
    sums = [F.sum(c).alias(c) for c in ("total", "failed", "spent", "timed")]
    return sketches.groupBy(*by).agg(*sums, F.kll_merge_agg_double("sketch").alias("sketch"))


def quantile(p: float = PERCENTILE) -> Column:
    """The percentile of a group's sketch; 0 without latencies."""
    found = F.kll_sketch_get_quantile_double("sketch", F.lit(p))
    return F.when(F.col("timed") > 0, found).otherwise(F.lit(0.0))


def figures(sketches: DataFrame, *keep: str, p: float = PERCENTILE) -> DataFrame:
    """The figures of ``metrics.query_metrics``, the percentile from the sketch."""
    share = lambda part: F.coalesce(F.try_divide(part, F.col("total")), F.lit(0.0))
    good = F.col("total") - F.col("failed")
    return sketches.select(
        *keep,
        F.col("total").alias("total_queries"),
        good.alias("successful_queries"),
        F.col("failed").alias("failed_queries"),
        F.round(100 * share(good), 2).alias("success_rate"),
        F.round(share(F.col("spent")), 2).alias("avg_latency_ms"),
        F.round(quantile(p), 2).alias("p95_latency_ms"),
    )


def daily_sketches(log: DataFrame, *by: Column, k: int = K) -> DataFrame:
    return latency_sketches(log, day_of().alias("window"), *by, k=k)


def document_sketches(rows: DataFrame, *by: Column) -> DataFrame:
    """The number of rows and a sketch of their documents' ids for each group."""
    ids = F.hll_sketch_agg(F.col("doc_id").cast("string"), LOG_REGISTERS)
    return rows.groupBy(*by).agg(F.count("*").alias("total_vectors"), ids.alias("documents"))


def document_estimate(sketches: DataFrame) -> DataFrame:
    """One row ``total_vectors, documents``: the first exact, the second within ``distinct_error``."""
    return sketches.agg(
        F.coalesce(F.sum("total_vectors"), F.lit(0)).alias("total_vectors"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("documents")), F.lit(0)).alias("documents"),
    )
