"""Keep query metrics up to date from a growing query log.

The state of a stream is a count for each latency (and day); the figures are found from the
counts of each micro-batch, in parts, so no task holds all latencies. ``running_sketches`` keeps
a sketch for each day instead: a state and an output that grow with days and not with rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from citemill.operators import metrics as mt, sketches as sk
from citemill.session import work_dir


def running_totals(log: DataFrame) -> DataFrame:
    """Counts of each latency, of which ``start`` makes the metrics of the whole log."""
    return mt.latency_counts(log)


def running_daily(log: DataFrame, watermark: str | None = None) -> DataFrame:
    """Counts of each day's latencies, of which ``start`` makes the metrics of each day.

    Without a watermark every day is kept and late rows count, for complete mode. With one,
    closed days leave the state, and rows that come later than the watermark are dropped:
    for unbounded streams whose rows arrive roughly in order. A watermark needs a
    ``TIMESTAMP``, and its days are those of UTC.
    """
    if watermark is not None:
        log = log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    return mt.latency_counts(log, mt.day_of())


def start(
    aggregated: DataFrame,
    folder: str,
    checkpoint: str,
    mode: str = "complete",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write the metrics of each micro-batch to its own folder; a rerun replaces it.

    The counts of a micro-batch are read several times and so stored first, in place of the last ones.
    """
    counts = work_dir(aggregated.sparkSession, "latency-counts")
    figures = mt.daily_figures if "window" in aggregated.columns else mt.total_figures

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(counts)
        stored = batch.sparkSession.read.schema(batch.schema).parquet(counts)
        figures(stored).write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return (
        aggregated.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest(spark: SparkSession, folder: str) -> DataFrame:
    """What the last micro-batch of a complete-mode stream wrote."""
    written = spark.read.parquet(folder)
    last = written.agg(F.max("batch_id")).scalar()
    return written.filter(F.col("batch_id") == last).drop("batch_id")


def running_sketches(log: DataFrame, watermark: str) -> DataFrame:
    """Each day's counts and sketch of latencies: a state of one small row a day.

    Days leave the state when the watermark has passed them; rows that come later than that are dropped.
    """
    timed = log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    return sk.daily_sketches(timed)


def start_days(
    days: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write, with each micro-batch, the days that it changed and no others; a rerun replaces them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return (
        days.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest_days(spark: SparkSession, folder: str) -> DataFrame:
    """The figures of each day as the last micro-batch that changed it left them."""
    written = spark.read.parquet(folder)
    columns = [c for c in written.columns if c not in ("window", "batch_id")]
    newest = written.groupBy("window").agg(F.max_by(F.struct(*columns), "batch_id").alias("last"))
    dated = newest.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "last.*")
    return sk.figures(dated, "day")
