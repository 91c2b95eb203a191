"""The stored query log: rows are only ever added, batches and streams read it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from citemill import schemas


def append(rows: DataFrame, folder: str, at: dt.datetime, failed: bool = False) -> None:
    """Add the log rows of a batch of queries answered, or failed, at ``at``."""
    stamped = rows.withColumns(
        {"failed": F.lit(failed), "ts": F.lit(at).cast("timestamp")}
    )
    stamped.select(*schemas.QUERY_LOG.names).write.mode("append").parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(schemas.QUERY_LOG).parquet(folder)


def stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(schemas.QUERY_LOG).parquet(folder)
