"""Ingest new files as they arrive."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from citemill import schemas
from citemill.operators import tables as tb, validate as val
from citemill.plans import pipeline
from citemill.sources.lake import SnapshotTable

REJECTS = schemas.struct_of(filename=schemas.S, reject_reason=schemas.S)


def start(
    documents: DataFrame,
    store: SnapshotTable,
    rejects: SnapshotTable,
    checkpoint: str,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Chunk, embed and upsert a stream of documents that carry a ``reject_reason``.

    Of several documents with one id the newest counts, in a batch as across batches. Each
    micro-batch is one snapshot. A batch that is run again after a failure finds itself in
    the log and writes nothing. The stream is named by the id that Spark keeps in its
    checkpoint, so a new checkpoint, under whatever path, is a new stream.
    """

    def ingest(batch: DataFrame, batch_id: int) -> None:
        now = dt.datetime.now(dt.timezone.utc)
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise RuntimeError("the stream has no id")
        accepted, rejected = val.split(batch)
        rejects.commit(rejected, at=now, stream_id=stream, batch_id=batch_id)
        newest = tb.latest_version(accepted)
        pipeline.upsert(newest, store, now, stream, batch_id, **options)

    needed = ["doc_id", "filename", "content", "file_type", "created_at", "reject_reason"]
    return (
        documents.select(*[F.col(name) for name in needed])
        .writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
