"""Turn texts into vectors, in Arrow batches and without a shuffle."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from citemill.functions import vectors as vec

# Names under which vectors are recorded.
HASH_MODEL = "hashed-tokens-384"
KNOWN_MODELS = (
    "fake-embedding-v1",
    "sentence-transformers/all-MiniLM-L6-v2",
    "text-embedding-ada-002",
    HASH_MODEL,
)

Encoder = Callable[[pa.Array], np.ndarray]


def hash_encoder(dim: int = vec.DIMENSION) -> Encoder:
    """The built-in encoder: needs no model, same text always gives the same vector."""
    return lambda texts: vec.hash_counts(texts, dim)


def hash_text_encoder(dim: int = vec.DIMENSION) -> Encoder:
    """The same for texts that are not yet in lower case; ``windows`` takes them as runs of words."""

    def encode(texts: pa.Array) -> np.ndarray:
        return vec.hash_counts(vec.lowered(texts), dim)

    encode.windows = lambda words, first, last: vec.hash_windows(vec.lowered(words), first, last, dim)
    return encode


def encode_column(
    text: Column, load: Callable[[], Encoder] = hash_encoder, dim: int = vec.DIMENSION
) -> Column:
    """Vector column of a text column; null where the encoder gives a zero vector.

    ``load`` runs once per task and returns the function from a batch of texts to a
    matrix, so a model is loaded once and called on whole batches.
    """

    @F.arrow_udf("array<float>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = load()
        for texts in batches:
            matrix = np.asarray(encoder(texts))
            if matrix.shape != (len(texts), dim):
                raise ValueError(f"encoder gave {matrix.shape}, need {(len(texts), dim)}")
            yield vec.matrix_lists(matrix)

    return encode(text)


def encode_packed(
    text: Column, load: Callable[[], Encoder] = hash_encoder, dim: int = vec.DIMENSION
) -> Column:
    """The vectors of ``encode_column`` as bytes: ``vector``, and ``broken``, what is wrong with it.

    An element of a list is handled by itself wherever Spark moves or writes it; bytes are copied.
    """

    @F.arrow_udf("vector binary, broken string")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = load()
        for texts in batches:
            matrix = np.asarray(encoder(texts))
            if matrix.shape != (len(texts), dim):
                raise ValueError(f"encoder gave {matrix.shape}, need {(len(texts), dim)}")
            yield pa.StructArray.from_arrays(list(vec.matrix_packed(matrix)), ["vector", "broken"])

    return encode(text)


def embed_chunks(
    chunks: DataFrame,
    load: Callable[[], Encoder] | None = None,
    dim: int = vec.DIMENSION,
    text: str = "chunk_text",
    packed: bool = False,
) -> DataFrame:
    """``chunks`` with a column ``embedding``; hashed tokens unless ``load`` is given.

    With ``packed`` it holds bytes, and a column ``broken`` says of vectors what is wrong with them.
    """
    source, made = (F.lower(F.col(text)), lambda: hash_encoder(dim)) if load is None else (F.col(text), load)
    if packed:
        coded = chunks.withColumn("embedding", encode_packed(source, made, dim))
        return coded.select(*chunks.columns, "embedding.broken", F.col("embedding.vector").alias("embedding"))
    return chunks.withColumn("embedding", encode_column(source, made, dim))


def hash_weights(
    documents: DataFrame, key: str = "doc_id", text: str = "content", dim: int = vec.DIMENSION
) -> DataFrame:
    """Long form of the hashed vectors: one row for each text and dimension it uses."""
    kind = documents.schema[key].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, dims, weights = vec.hash_weights(batch.column(1), dim)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    pa.array(dims, pa.int32()),
                    pa.array(weights, pa.int64()),
                ],
                [key, "dim", "weight"],
            )

    lowered = documents.select(key, F.lower(F.col(text)).alias(text))
    return lowered.mapInArrow(weigh, f"{key} {kind}, dim int, weight bigint")


def embedding_metadata(
    embedded: DataFrame,
    model: str,
    dim: int = vec.DIMENSION,
    created_at: dt.datetime | None = None,
    snapshot_id: int | None = None,
) -> DataFrame:
    """One row for each chunk that has a vector, without the vector itself."""
    return embedded.filter(F.col("embedding").isNotNull()).select(
        "chunk_id",
        "doc_id",
        F.lit(model).alias("embedding_model"),
        F.lit(dim).alias("vector_dimension"),
        F.lit(created_at).cast("timestamp").alias("created_at"),
        F.lit(snapshot_id).cast("bigint").alias("snapshot_id"),
    )
