"""Metrics of the query log."""

from __future__ import annotations

import itertools
import math
import struct

from pyspark.sql import Column, DataFrame, Window, functions as F

PERCENTILE = 0.95
# Bits that a round of a selection decides, and how many open rows are counted by value.
_DIGIT, _FEW = 18, 20_000


def query_log(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """One log row for each query: its latency and how many results it had."""
    counted = hits.groupBy("q_id").agg(F.count("*").alias("n"))
    return queries.join(counted, "q_id", "left").select(
        "q_id",
        "query",
        "latency_ms",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("num_results"),
    )


def summary_columns(n: str | None = None) -> list[Column]:
    """Aggregates over log rows with ``failed`` and ``latency_ms``; each counts ``n`` times.

    The average divides the latency of successful queries by all queries; an empty log
    gives 0 everywhere.
    """
    times = F.lit(1) if n is None else F.col(n)
    total = F.coalesce(F.sum(times), F.lit(0))
    failed = F.coalesce(F.sum(F.when(F.col("failed"), times)), F.lit(0))
    spent = F.coalesce(F.sum(F.when(~F.col("failed"), F.col("latency_ms") * times)), F.lit(0.0))
    zero = F.lit(0.0)
    rate = F.try_divide(100.0 * (total - failed).cast("double"), total.cast("double"))
    return [
        total.alias("total_queries"),
        (total - failed).alias("successful_queries"),
        failed.alias("failed_queries"),
        F.round(F.coalesce(rate, zero), 2).alias("success_rate"),
        F.round(F.coalesce(F.try_divide(spent, total.cast("double")), zero), 2).alias(
            "avg_latency_ms"
        ),
    ]


def _ordered_bits(value: Column) -> Column:
    """A double as a long of the same order: all bits of a positive one, of a negative one flipped.

    Both zeros are one; what is no number comes last.
    """
    spelled = F.call_function("reflect", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0))
    bits = spelled.cast("bigint")
    return F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit((1 << 63) - 1)))


def _from_bits(bits: Column) -> Column:
    own = F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit((1 << 63) - 1)))
    return F.call_function("reflect", F.lit("java.lang.Double"), F.lit("longBitsToDouble"), own).cast("double")


def _double(bits: int) -> float:
    return struct.unpack("<d", struct.pack("<q", bits if bits >= 0 else bits ^ ((1 << 63) - 1)))[0]


def percentile(rows: DataFrame, column: str, p: float) -> float | None:
    """The exact, linearly interpolated percentile of ``column``; None without values.

    Radix selection: values are counted by their leading bits, then, inside the one or two
    cells that hold the ranks in question, by the bits that follow, until what is open is few
    enough to be counted by value. A round is one pass with partial aggregates, and its
    result at most ``2 ** _DIGIT`` rows for each open cell, as a rule some hundred.
    """
    inside = rows.select(F.col(column).cast("double").alias("v")).filter("v is not null").select(_ordered_bits(F.col("v")).alias("v"))
    ranks, before, known = None, 0, 0
    while True:
        shift = max(64 - known - _DIGIT, 0)
        found = inside.groupBy(F.shiftright("v", shift).alias("cell")).agg(F.count("*").alias("n")).collect()
        cells = sorted((r["cell"], r["n"]) for r in found)
        if ranks is None:
            total = sum(n for _, n in cells)
            if not total:
                return None
            at = p * (total - 1)
            ranks = math.floor(at), math.ceil(at)
        upto = list(itertools.accumulate((n for _, n in cells), initial=before))[1:]
        first, last = (next(k for k, n in enumerate(upto) if rank < n) for rank in ranks)
        if not shift:
            break
        before = upto[first - 1] if first else before
        open_ = sorted({cells[first][0], cells[last][0]})
        inside = inside.filter(F.shiftright("v", shift).isin(open_))
        held = sum(n for c, n in cells if c in open_)
        known = 64 if held <= _FEW else known + _DIGIT
    low, high = (_double(cells[k][0]) for k in (first, last))
    if ranks[0] == ranks[1]:
        return low
    return (ranks[1] - at) * low + (at - ranks[0]) * high


def percentiles(rows: DataFrame, p: float) -> DataFrame:
    """The exact percentile of ``v`` for each ``key`` (string), as ``key, value``.

    Each row counts ``n`` times. Radix selection for all keys at once: three rounds of counts by
    key and cell, the bounds of each round a table that the next is joined with. Nothing comes to the
    driver, no key's values have to fit a task, and no job runs before the result is asked for.
    Keys without values are left out.
    """
    rows = rows.filter("v is not null").select("key", _ordered_bits(F.col("v")).alias("v"), "n")
    by_key = Window.partitionBy("key")
    shift = 64 - _DIGIT
    cells = rows.groupBy("key", F.shiftright("v", shift).alias("cell")).agg(F.sum("n").alias("n"))
    cells = cells.withColumn("total", F.sum("n").over(by_key)).withColumn("upto", F.sum("n").over(by_key.orderBy("cell")))
    at = F.lit(p) * (F.col("total") - 1)
    ranks = F.array(F.floor(at), F.ceil(at))
    sought = cells.select("*", at.alias("at"), F.posexplode(ranks).alias("which", "rank"))

    def hit(placed: DataFrame) -> DataFrame:
        before = F.col("upto") - F.col("n")
        inside = placed.filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= before))
        return inside.select("key", "which", "at", (F.col("rank") - before).alias("rank"), F.col("cell").alias("prefix"))

    sought = hit(sought)
    for width in (_DIGIT, 64 - 2 * _DIGIT):
        above, shift = shift, shift - width
        open_ = sought.select(F.col("key").alias("key_"), F.col("prefix").alias("prefix_")).distinct()
        within = rows.join(open_, (F.col("key") == F.col("key_")) & (F.shiftright("v", above) == F.col("prefix_")), "left_semi")
        cells = within.groupBy(F.col("key").alias("of"), F.shiftright("v", shift).alias("cell")).agg(F.sum("n").alias("n"))
        cells = cells.withColumn("in", F.shiftright("cell", width)).withColumn(
            "upto", F.sum("n").over(Window.partitionBy("of", "in").orderBy("cell"))
        )
        same = (F.col("key") == F.col("of")) & (F.col("prefix") == F.col("in"))
        sought = hit(sought.join(cells, same))
    ends = sought.groupBy("key").agg(
        F.first("at").alias("at"), *[F.max(F.when(F.col("which") == k, F.col("prefix"))).alias(name) for k, name in enumerate(("low", "high"))]
    )
    low, high, part = _from_bits(F.col("low")), _from_bits(F.col("high")), F.col("at") - F.floor("at")
    between = (F.ceil("at") - F.col("at")) * low + part * high
    return ends.select("key", F.when(part == 0, low).otherwise(between).alias("value"))


def _rounded(value: Column) -> Column:
    """Two places, after what interpolation leaves behind the sixth is gone."""
    return F.round(F.round(value, 6), 2)


def query_metrics(log: DataFrame, p: float = PERCENTILE) -> DataFrame:
    """Totals, success rate, average and exact 95th percentile latency of a query log.

    The percentile is found first, by a few jobs; the rest is one lazy aggregate.
    """
    found = percentile(log, "latency_ms", p) or 0.0
    return log.agg(*summary_columns()).select(
        "*", _rounded(F.lit(found)).alias("p95_latency_ms")
    )


def latency_percentile(p: float = PERCENTILE) -> Column:
    """The exact percentile as an aggregate: for groups whose distinct latencies fit a task.

    No query uses it: ``percentiles`` has no such limit.
    """
    found = F.coalesce(F.percentile("latency_ms", p), F.lit(0.0))
    return _rounded(found).alias("p95_latency_ms")


def latency_counts(log: DataFrame, *by: Column) -> DataFrame:
    """How many rows, ``n``, there are of each latency, failed or not."""
    return log.groupBy(*by, "failed", "latency_ms").agg(F.count(F.lit(1)).alias("n"))


def day_of(ts: str = "ts") -> Column:
    return F.window(F.col(ts), "1 day")


def total_figures(counts: DataFrame, p: float = PERCENTILE) -> DataFrame:
    """``query_metrics`` from ``latency_counts``."""
    values = percentiles(_values(counts, F.lit("")), p)
    totals = counts.agg(*summary_columns("n"))
    value = F.coalesce(values.agg(F.first("value")).scalar(), F.lit(0.0))  # of the only key
    return totals.select("*", _rounded(value).alias("p95_latency_ms"))


def daily_figures(counts: DataFrame, p: float = PERCENTILE) -> DataFrame:
    """The same figures for each ``window``, a day, from ``latency_counts``."""
    start = F.col("window.start").cast("string")
    values = percentiles(_values(counts, start), p)
    grouped = counts.groupBy("window").agg(*summary_columns("n"))
    found = grouped.join(values, start == F.col("key"), "left")
    return found.select(
        F.date_format("window.start", "yyyy-MM-dd").alias("day"),
        *[c for c in grouped.columns if c != "window"],
        _rounded(F.coalesce("value", F.lit(0.0))).alias("p95_latency_ms"),
    )


def _values(counts: DataFrame, key: Column) -> DataFrame:
    return counts.select(key.alias("key"), F.col("latency_ms").cast("double").alias("v"), "n")


def daily_metrics(log: DataFrame) -> DataFrame:
    """The same figures for each day of ``ts``."""
    return daily_figures(log.select(day_of().alias("window"), "failed", "latency_ms", F.lit(1).alias("n")))
