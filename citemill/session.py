"""Spark session settings and the shared folder jobs may write to."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Arrow batches stop at the smaller of the two limits, so a few very long
    # texts cannot make one batch outgrow a Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}


def get_spark(app: str = "citemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; ``conf`` overrides them.

    Keyword names use ``__`` for the dots of a Spark setting. The master is left to
    ``spark-submit`` unless given.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULTS)
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, else the warehouse's.

    Both are read from the session and neither is changed. A path of scheme ``file`` must be
    a mount that all machines share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder name under the shared folder; gone when the application ends."""
    own = os.path.join(shared_dir(spark), "citemill", spark.sparkContext.applicationId)
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path)
    store.deleteOnExit(path)
    return f"{own}/{purpose}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, purpose: str, **options) -> DataFrame:
    """``frame`` written to the shared folder and read back; it no longer depends on what made it.

    ``options`` are those of the writer.
    """
    folder = work_dir(frame.sparkSession, purpose)
    frame.write.options(**options).parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)
