"""Read the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


# Session setting: into how many partitions scans of the given tables are dealt. Unset, as
# it should be for large tables, they are read in the splits that Spark makes of their files.
SCAN_PARTITIONS = "spark.citemill.scanPartitions"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dealt(scan: DataFrame) -> DataFrame:
    """``scan`` in the number of partitions that the session names, if it names one."""
    parts = scan.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return scan.repartition(int(parts)) if parts else scan


def raw_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Table ``documents`` in the lake's terms, its source standing in for a file name."""
    scan = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return dealt(scan).select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("source").alias("filename"),
        F.col("text").alias("content"),
        "lang",
    )


def questions(spark: SparkSession, folder: str) -> DataFrame:
    """Table ``benchmark`` as queries."""
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("q_id"), F.col("text").alias("query")
    )


def query_events(spark: SparkSession, folder: str) -> DataFrame:
    """Table ``events`` as a query log: errors failed, the value is the latency."""
    return as_query_log(table(spark, folder, "events"))


def as_query_log(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("q_id"),
        "ts",
        (F.col("event_type") == "error").alias("failed"),
        F.col("value").alias("latency_ms"),
    )
