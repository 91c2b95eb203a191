"""Joins, counts and lineage over the document and chunk tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from citemill.functions import text as tx
from citemill.functions.joins import same_key
from citemill.operators import validate as val
from citemill.operators.asof import as_of_join
from citemill.operators.embed import HASH_MODEL


def chunks_per_filename(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Number of chunks under each file name; documents of one name are counted together.

    Both sides are counted per document before the join, so a document with very many
    rows meets the join as a single one and no chunk text is shuffled.
    """
    counted = chunks.groupBy("doc_id").agg(F.count("*").alias("n"))
    named = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "filename")
    named = named.groupBy("doc_id", "filename").agg(F.count("*").alias("times"))
    joined = named.join(counted, "doc_id")
    return joined.groupBy("filename").agg(F.sum(F.col("n") * F.col("times")).alias("num_chunks"))


def chunks_per_document(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """Number of chunks of every document, 0 for those without any."""
    counted = chunks.groupBy("doc_id").agg(F.count("*").alias("n"))
    named = documents.select(F.col("doc_id").cast("string").alias("doc_id"))
    return named.join(counted, "doc_id", "left").select(
        "doc_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("num_chunks")
    )


def latest_version(documents: DataFrame) -> DataFrame:
    """The newest row of each ``doc_id`` by ``created_at``, of equally new ones by digest.

    Documents are ranked by ids, times and digests alone, one row per document and task;
    contents are not sorted. Rows equal in all three count as one and stay once.
    """
    marked = documents.withColumn("digest", F.md5(F.encode("content", "UTF-8")))
    rank = F.max(F.struct(F.col("created_at"), F.col("digest")))
    newest = marked.groupBy(F.col("doc_id").alias("newest_id")).agg(rank.alias("newest"))
    same = (
        same_key("doc_id", "newest_id")
        & F.col("created_at").eqNullSafe(F.col("newest.created_at"))
        & F.col("digest").eqNullSafe(F.col("newest.digest"))
    )
    kept = marked.join(newest, same, "left_semi")
    return kept.dropDuplicates(["doc_id", "created_at", "digest"]).drop("digest")


def chunk_preview(chunks: DataFrame, limit: int | None = 10) -> DataFrame:
    """Beginnings of chunks in document order; all of them if ``limit`` is None."""
    shown = chunks.select(
        "chunk_id",
        "doc_id",
        "chunk_index",
        "chunk_size",
        tx.preview(F.col("chunk_text")).alias("preview"),
    ).orderBy("doc_id", "chunk_index")
    return shown if limit is None else shown.limit(limit)


def lake_summary(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row with the number of documents and of chunks."""
    n_chunks = chunks.agg(F.count("*")).scalar()
    return documents.agg(F.count("*").alias("total_documents")).select(
        "total_documents", n_chunks.alias("total_chunks")
    )


def missing_embeddings(chunks: DataFrame, metadata: DataFrame) -> DataFrame:
    """Chunks that have no vector yet.

    Ids of 64 bits may collide in a large lake, so the document must be the same, too.
    """
    place = ["chunk_id", "doc_id"]
    return chunks.join(metadata.select(*place), place, "left_anti")


def embedding_models(metadata: DataFrame) -> DataFrame:
    return metadata.groupBy("embedding_model", "vector_dimension").agg(
        F.count("*").alias("num_vectors")
    )


def collection_stats(points: DataFrame, name: str, metric: str = "cosine") -> DataFrame:
    """One row that describes a vector collection from the rows it really holds."""
    size = F.size("embedding")
    return points.agg(
        F.count("*").alias("total_vectors"),
        F.count_distinct("doc_id").alias("documents"),
        F.min(size).alias("min_dimension"),
        F.max(size).alias("max_dimension"),
    ).select(F.lit(name).alias("collection"), "*", F.lit(metric).alias("distance_metric"))


def upload_stats(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunks made and text length of every document."""
    counted = chunks.groupBy("doc_id").agg(F.count("*").alias("n"))
    lengths = documents.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        "filename",
        F.length("content").alias("text_length"),
    )
    return lengths.join(counted, "doc_id", "left").select(
        *lengths.columns, F.coalesce("n", F.lit(0)).cast("bigint").alias("chunks_created")
    )


def _origin(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("filename").alias("source_file"),
        F.col("file_size"),
        F.md5(F.encode("content", "UTF-8")).alias("file_hash"),
        "snapshot_id",
    )


def _with_commit(rows: DataFrame, log: DataFrame) -> DataFrame:
    commits = log.select("snapshot_id", "committed_at", "operation")
    commits = commits.withColumnRenamed("snapshot_id", "commit_id")
    return rows.join(commits, same_key("snapshot_id", "commit_id"), "left").drop("commit_id")


def lineage(chunks: DataFrame, documents: DataFrame, log: DataFrame) -> DataFrame:
    """Each chunk with the document it was cut from and the snapshot that brought it.

    ``documents`` carries ``snapshot_id``. Left joins keep chunks whose origin is unknown.
    """
    origin = _with_commit(_origin(documents), log)
    traced = chunks.select("chunk_id", "doc_id", "chunk_index", "chunking_strategy")
    return traced.join(origin, "doc_id", "left")


def version_lineage(chunks: DataFrame, documents: DataFrame, log: DataFrame) -> DataFrame:
    """Each chunk with the version of its document that was the newest when its own snapshot came.

    Both carry ``snapshot_id``; a document may have come in several snapshots. Each chunk comes
    out once, with nulls where no version had come by then. No version meets a chunk but its own.
    """
    own = ["source_file", "file_size", "file_hash", "document_snapshot"]
    versions = _origin(documents).withColumn("document_snapshot", F.col("snapshot_id"))
    traced = chunks.select("chunk_id", "doc_id", "chunk_index", "chunking_strategy", "snapshot_id")
    found = as_of_join(traced, versions, "doc_id", "snapshot_id", "file_hash", tuple(own))
    commits = log.select(F.col("snapshot_id").alias("commit_id"), "committed_at", "operation")
    return found.join(commits, F.col("document_snapshot") == F.col("commit_id"), "left").drop("commit_id")


def hits_with_lineage(
    hits: DataFrame, documents: DataFrame, log: DataFrame, model: str = HASH_MODEL
) -> DataFrame:
    """``hits`` with a struct ``data_lineage``, null where the document is unknown.

    It tells the snapshot and time that brought the document, its file, the steps from there
    to the hit (chunking strategy, where the hit carries it, and model) and its quality.

    Documents are first cut down to those that were hit: that list is small, so Spark can
    broadcast it, and the table of documents is not shuffled for a handful of rows.
    """
    wanted = hits.select("doc_id").distinct()
    named = documents.withColumn("doc_id", F.col("doc_id").cast("string"))
    named = named.join(wanted, "doc_id", "left_semi")
    origin = _origin(named).join(_quality(named), "doc_id")
    fields = ["snapshot_id", "committed_at", "operation", "source_file", "file_size", "file_hash"]
    traced = _with_commit(origin, log).select(
        F.col("doc_id").alias("origin_id"), F.struct(*fields, "quality").alias("found")
    )
    strategy = F.col("chunking_strategy") if "chunking_strategy" in hits.columns else F.lit(None)
    steps = F.array_compact(F.array(strategy.cast("string"), F.lit(model)))
    record = F.struct("found.*", steps.alias("transformations"))
    return hits.join(traced, same_key("doc_id", "origin_id"), "left").select(
        *[F.col(c) for c in hits.columns],
        F.when(F.col("origin_id").isNotNull(), record).alias("data_lineage"),
    )


def _quality(documents: DataFrame) -> DataFrame:
    checked = quality_checks(documents) if "lang" in documents.columns else quality_checks(
        documents.withColumn("lang", F.lit(None).cast("string"))
    )
    fields = [c for c in checked.columns if c != "doc_id"]
    return checked.select("doc_id", F.struct(*fields).alias("quality"))


def quality_checks(documents: DataFrame, text: str = "content", lang: str = "lang") -> DataFrame:
    content = F.col(text)
    return documents.select(
        "doc_id",
        F.length(content).alias("text_length"),
        F.col(lang).alias("language"),
        tx.words_per_sentence(content).alias("readability_score"),
        tx.contains_pii(content).alias("contains_pii"),
    )


def rejects_by_reason(checked: DataFrame) -> DataFrame:
    _, rejected = val.split(checked)
    return rejected.groupBy("reject_reason").agg(F.count("*").alias("n"))
