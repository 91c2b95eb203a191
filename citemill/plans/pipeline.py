"""Whole jobs put together from the operators."""

from __future__ import annotations

import datetime as dt
import inspect
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from citemill import schemas
from citemill.functions import ids, vectors as vec
from citemill.operators import chunk, context as ctx, embed, search, sketches, validate as val
from citemill.session import stored
from citemill.sources import files, lake
from citemill.sources.lake import SnapshotTable

# Fields of an indexed point, besides its vector.
POINTS = T.StructType(
    [T.StructField("point_id", T.LongType())]
    + schemas.POINT_PAYLOAD.fields
    + [T.StructField("embedding", T.ArrayType(T.FloatType()))]
)

# How vectors of a collection are compared.
METRIC = "cosine"

# A collection is renewed by whole documents, unless it declares that it is by chunks.
UNIT = {"unit": "chunk"}
WITHDRAWN = "withdrawn"

INGEST_STATS = "status string, documents bigint, chunks bigint, vectors bigint, collection string"


def collection(
    spark: SparkSession, folder: str, dim: int = vec.DIMENSION, metric: str = METRIC, by_chunk: bool = False
) -> SnapshotTable:
    """A table of points that declares its dimension and metric, and refuses other vectors.

    One that is kept ``by_chunk`` is brought up to date by ``reingest_changed``.
    """
    declared = {"dimension": dim, "metric": metric} | (UNIT if by_chunk else {})
    return SnapshotTable(spark, folder, POINTS, declared, ("embedding",))


def _is_by_chunk(store: SnapshotTable) -> bool:
    return store.properties.get("unit") == UNIT["unit"]


def _held_to_contract(made: DataFrame, dim: int) -> DataFrame:
    """The same points; a vector that breaks the collection's contract stops the write.

    Points without a vector are kept, as they are when an encoder finds nothing in a text.
    """
    if made.schema["embedding"].dataType == T.BinaryType():
        wrong = F.when(F.octet_length("embedding") != 4 * dim, F.lit("wrong_dimension"))
        checked = made.withColumn("reject_reason", F.coalesce(wrong, "broken")).drop("broken")
    else:
        checked = val.check_vectors(made, dim)
    broken = F.col("embedding").isNotNull() & F.col("reject_reason").isNotNull()
    message = F.concat(F.lit("vector of "), F.col("chunk_id"), F.lit(": "), F.col("reject_reason"))
    held = F.when(broken, F.raise_error(message)).otherwise(F.col("embedding"))
    return checked.withColumn("embedding", held).drop("reject_reason")


def points(
    documents: DataFrame,
    indexed_at: dt.datetime,
    chunker: Callable[..., DataFrame] = chunk.chunk_fixed,
    load: Callable[[], embed.Encoder] | None = None,
    dim: int = vec.DIMENSION,
    packed: bool = False,
) -> DataFrame:
    """Chunks of documents as points of a collection. One pass, no shuffle.

    A chunker that can make vectors (it takes ``load``) does so in its own pass. Chunks without
    a vector keep a null and are left out when the points are indexed. With ``packed`` vectors are
    bytes, unless the chunker makes them and cannot give them so.
    """
    carry = ("filename", "file_type")
    takes = inspect.signature(chunker).parameters
    if "load" in takes:
        encoder = load or partial(embed.hash_text_encoder, dim)
        made = chunker(documents, carry=carry, load=encoder, **({"packed": True} if packed and "packed" in takes else {}))
    else:
        made = embed.embed_chunks(chunker(documents, carry=carry), load, dim, packed=packed)
    made = made.select(
        ids.point_id(F.col("chunk_id")).alias("point_id"),
        "chunk_id",
        "doc_id",
        "chunk_index",
        F.col("chunk_text").alias("text"),
        "filename",
        "file_type",
        "chunk_size",
        F.col("chunking_strategy").alias("strategy"),
        F.lit(indexed_at).cast("timestamp").alias("indexed_at"),
        "embedding",
        *(["broken"] if "broken" in made.columns else []),
    )
    return _held_to_contract(made, dim)


_open_collection = collection  # the name is a parameter below


def reingest(
    documents: DataFrame,
    folder: str,
    collection: str,
    indexed_at: dt.datetime,
    chunker: Callable[..., DataFrame] = chunk.chunk_sentences,
    load: Callable[[], embed.Encoder] | None = None,
    dim: int = vec.DIMENSION,
) -> DataFrame:
    """Replace a collection by the points of ``documents``; returns its totals.

    Documents, chunks and vectors are counted while they are written, so nothing is read
    a second time. The new snapshot becomes visible only when it is complete.
    """
    spark = documents.sparkSession
    read, made = Observation(), Observation()
    source = documents.observe(read, F.count(F.lit(1)).alias("documents"))
    store = _open_collection(spark, folder, dim)
    indexed = points(source, indexed_at, chunker, load, dim, bool(store.packed)).observe(
        made, F.count(F.lit(1)).alias("chunks"), F.count("embedding").alias("vectors")
    )
    store.commit(indexed, "overwrite", indexed_at)
    totals = {**read.get, **made.get}
    return spark.createDataFrame(
        [("success", totals["documents"], totals["chunks"], totals["vectors"], collection)],
        INGEST_STATS,
    )


def reingest_folder(spark: SparkSession, source: str, folder: str, collection: str, **options):
    """Load all files below ``source`` and replace the collection; returns totals, rejects."""
    accepted, rejected = val.split(files.loaded(files.scan(spark, source)))
    indexed_at = options.pop("indexed_at", None) or dt.datetime.now(dt.timezone.utc)
    return reingest(accepted, folder, collection, indexed_at, **options), rejected


def upsert(
    documents: DataFrame,
    store: SnapshotTable,
    indexed_at: dt.datetime,
    stream_id: str | None = None,
    batch_id: int | None = None,
    **options,
) -> int | None:
    """Add documents to a collection; earlier points of the same documents are outdated."""
    if _is_by_chunk(store):
        raise ValueError("this collection is renewed by chunks")
    dim = int(store.properties.get("dimension", vec.DIMENSION))
    made = points(documents, indexed_at, **{"dim": dim, "packed": bool(store.packed), **options})
    return store.commit(made, "append", indexed_at, stream_id, batch_id)


def searchable(store: SnapshotTable, at: dt.datetime | None = None, packed: bool = False) -> DataFrame:
    """Points that can be found: the newest of each document, or chunk, that have a vector.

    ``packed`` gives vectors as they are stored, which a search reads with less work.
    """
    shown = live_points(store, at, packed) if _is_by_chunk(store) else store.current(at, packed=packed)
    return shown.filter(F.col("embedding").isNotNull())


def live_points(store: SnapshotTable, at: dt.datetime | None = None, packed: bool = False) -> DataFrame:
    """The newest point of each chunk of a collection kept by chunks, without withdrawn ones."""
    return store.current(at, "chunk_id", packed).filter(~F.col("strategy").eqNullSafe(F.lit(WITHDRAWN)))


def chunk_changes(cut: DataFrame, live: DataFrame) -> DataFrame:
    """What tells ``cut`` chunks from ``live`` points: ``chunk_id, doc_id, change``.

    ``change`` is ``new``, ``changed`` (another text, place, name, type or strategy), ``gone`` or
    ``same``. Digests are compared; what is moved is an id and a digest for each chunk.
    """
    text = lambda *columns: F.md5(F.to_json(F.struct(*[F.col(c).cast("string").alias(f"c{k}") for k, c in enumerate(columns)]))).alias("digest")
    ours = cut.select("chunk_id", "doc_id", text("chunk_text", "chunk_index", "filename", "file_type", "chunking_strategy"))
    theirs = live.select(
        F.col("chunk_id").alias("live_id"), F.col("doc_id").alias("live_doc"),
        text("text", "chunk_index", "filename", "file_type", "strategy").alias("live_digest"),
    )
    both = ours.join(theirs, (F.col("chunk_id") == F.col("live_id")) & (F.col("doc_id") == F.col("live_doc")), "full")
    change = (
        F.when(F.col("live_id").isNull(), "new")
        .when(F.col("chunk_id").isNull(), "gone")
        .when(F.col("digest") == F.col("live_digest"), "same")
        .otherwise("changed")
    )
    return both.select(
        F.coalesce("chunk_id", "live_id").alias("chunk_id"), F.coalesce("doc_id", "live_doc").alias("doc_id"), change.alias("change")
    )


def counted(store: SnapshotTable, folder: str, at: dt.datetime | None = None) -> DataFrame:
    """Vectors and documents of a collection, from a sketch kept for each commit below ``folder``.

    Only commits without a sketch are read; what was counted once is never read again. The number
    of vectors is that of all visible rows, documents are within ``sketches.distinct_error``.
    """
    spark, schema = store.spark, "total_vectors bigint, documents binary, snapshot_id bigint"
    spark.createDataFrame([], schema).write.mode("append").parquet(folder)
    known = spark.read.schema(schema).parquet(folder)
    shown = lake.visible(store.log(), at).select("snapshot_id")
    missing = [r["snapshot_id"] for r in shown.join(known, "snapshot_id", "left_anti").collect()]
    if missing:
        rows = store.rows().filter(F.col("snapshot_id").isin(missing))
        made = sketches.document_sketches(rows, F.col("snapshot_id"))
        made.select("total_vectors", "documents", "snapshot_id").write.mode("append").parquet(folder)
    every = spark.read.schema(schema).parquet(folder).dropDuplicates(["snapshot_id"])
    return sketches.document_estimate(every.join(shown, "snapshot_id", "left_semi"))


CHANGES = ("new", "changed", "gone", "same")


def reingest_changed(
    documents: DataFrame,
    store: SnapshotTable,
    indexed_at: dt.datetime,
    chunker: Callable[..., DataFrame] = chunk.chunk_fixed,
    load: Callable[[], embed.Encoder] | None = None,
) -> DataFrame:
    """Bring a collection kept by chunks up to date with ``documents``; returns ``change, chunks``.

    Only chunks that are new or changed are encoded and written; those whose document or
    place is gone are withdrawn. All of it is one snapshot, or none if nothing differs. Whether
    the chunks to encode are told by a broadcast or a join is Spark's choice by their number; where
    it joins, its runtime bloom filter leaves out unchanged chunks ahead of the shuffle.
    """
    if not _is_by_chunk(store):
        raise ValueError("this collection is renewed by documents")
    dim = int(store.properties.get("dimension", vec.DIMENSION))
    cut = chunker(documents, carry=("filename", "file_type"))
    seen = Observation()
    counted = [F.count_if(F.col("change") == name).alias(name) for name in CHANGES]
    compared = chunk_changes(cut, live_points(store)).observe(seen, *counted)
    changes = stored(compared.filter("change <> 'same'"), "chunk-changes")
    totals = seen.get
    if sum(totals[name] for name in CHANGES[:3]):
        wanted = changes.filter("change <> 'gone'").select("chunk_id", "doc_id")

        def only_wanted(rows: DataFrame, carry: tuple[str, ...]) -> DataFrame:
            cut = chunker(rows, carry=carry)
            if not totals["same"]:  # all that has both ids, as in a first ingest: nothing to be told apart
                return cut.dropna(subset=["chunk_id", "doc_id"])
            return cut.join(wanted, ["chunk_id", "doc_id"], "left_semi")

        made = points(documents, indexed_at, only_wanted, load, dim, bool(store.packed))
        gone = changes.filter("change = 'gone'").select(
            *[
                {"point_id": ids.point_id(F.col("chunk_id")), "chunk_id": F.col("chunk_id"), "doc_id": F.col("doc_id"),
                 "strategy": F.lit(WITHDRAWN), "indexed_at": F.lit(indexed_at).cast("timestamp")}
                .get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
                for f in store.kept
            ]
        )
        store.commit(made.unionByName(gone), "append", indexed_at)
    return documents.sparkSession.createDataFrame([(name, totals[name]) for name in CHANGES], "change string, chunks bigint")


def embed_queries(
    queries: DataFrame,
    top_k: int = search.TOP_K,
    min_score: float | None = None,
    load: Callable[[], embed.Encoder] | None = None,
    dim: int = vec.DIMENSION,
) -> DataFrame:
    """Questions ``(q_id, query)`` as search requests, with defaults where they name none.

    Requests outside the accepted bounds are left out; ``check_requests`` gives them.
    """
    accepted, _ = check_requests(queries, top_k, min_score)
    return embed.embed_chunks(accepted, load, dim, text="query")


def check_requests(
    queries: DataFrame, top_k: int = search.TOP_K, min_score: float | None = None
) -> tuple[DataFrame, DataFrame]:
    """Requests with defaults filled in, and the rejected ones with their reason."""
    return val.split(val.check_queries(val.request_defaults(queries, top_k, min_score)))


def search_texts(
    queries: DataFrame,
    chunks: DataFrame,
    top_k: int = search.TOP_K,
    min_score: float | None = None,
    carry: tuple[str, ...] = ("doc_id", "chunk_index", "chunk_text", "filename"),
    dim: int = vec.DIMENSION,
) -> DataFrame:
    """Best chunks for each question, with hashed vectors made on the fly.

    The vectors are several times as large as the texts; they are made and used inside
    the same task and never stored.
    """
    requests = embed_queries(queries, top_k, min_score, dim=dim)
    lowered = chunks.withColumn("searched", F.lower("chunk_text"))
    hits = search.top_k(
        requests,
        lowered,
        vector="searched",
        dim=dim,
        encoder=lambda: embed.hash_encoder(dim),
        carry=carry,
    )
    return hits.withColumnRenamed("chunk_text", "text")


def search_points(
    requests: DataFrame,
    stored: DataFrame,
    carry: tuple[str, ...] = ("doc_id", "chunk_index", "text", "filename", "file_type"),
    dim: int = vec.DIMENSION,
) -> DataFrame:
    """Best points of a stored collection for each request, with their payload."""
    return search.top_k(requests, stored, dim=dim, carry=carry)


def answer_inputs(queries: DataFrame, chunks: DataFrame, top_k: int = search.TOP_K) -> DataFrame:
    """Flagship: questions in; prompt with cited context and its confidence out."""
    return ctx.prompts(queries, search_texts(queries, chunks, top_k))


def write_chunks(chunks: DataFrame, created_at: dt.datetime, table: str) -> None:
    """Replace the rows of a catalog table of chunks."""
    lake.overwrite(chunks.withColumn("created_at", F.lit(created_at).cast("timestamp")), table)
