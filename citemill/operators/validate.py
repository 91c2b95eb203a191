"""Split input into accepted and rejected rows. Every reject keeps its first reason."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from citemill.functions import text as tx, vectors as vec
from citemill.operators.embed import KNOWN_MODELS
from citemill.operators.search import MAX_TOP_K, MIN_SCORE, MIN_TOP_K, TOP_K

# What an upload must look like.
TEXT_SUFFIXES = (".txt", ".md")
PARSER_SUFFIXES = (".pdf",)
MIN_CHARS = 10


def reject_reason(name: Column, content: Column) -> Column:
    """Why a file is refused, or null. ``content`` is its text, or its bytes as text."""
    lower = F.lower(name)

    def ends_with(suffixes: tuple[str, ...]) -> Column:
        found = F.lit(False)
        for suffix in suffixes:
            found = found | lower.endswith(suffix)
        return found

    return (
        F.when(~ends_with(TEXT_SUFFIXES + PARSER_SUFFIXES), F.lit("unsupported_type"))
        .when(ends_with(PARSER_SUFFIXES), F.lit("unsupported_parser"))
        .when(~F.is_valid_utf8(content), F.lit("bad_encoding"))
        .when(content.isNull() | (F.length(content) < MIN_CHARS), F.lit("too_short"))
        .when(~tx.has_content(content), F.lit("no_chunks"))
    )


def validate(documents: DataFrame, name: str = "filename", text: str = "content") -> DataFrame:
    """``documents`` with a column ``reject_reason``, null for accepted rows."""
    return documents.withColumn("reject_reason", reject_reason(F.col(name), F.col(text)))


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows of a DataFrame with ``reject_reason``."""
    accepted = checked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return accepted, checked.filter(F.col("reject_reason").isNotNull())


def check_vectors(points: DataFrame, dim: int = vec.DIMENSION, vector: str = "embedding"):
    """``points`` with a ``reject_reason`` for vectors that break the collection's contract."""
    column = F.col(vector)
    nan = F.lit(math.nan).cast(points.schema[vector].dataType.elementType)
    # Neither true nor false if an element is null; NaN is above infinity in Spark's order.
    has_nan, low, high = F.array_contains(column, nan), F.array_min(column), F.array_max(column)
    reason = (
        F.when(column.isNull(), F.lit("empty_embedding"))
        .when(F.size(column) != dim, F.lit("wrong_dimension"))
        .when(has_nan.isNull(), F.lit("null_element"))
        .when(has_nan | (high == math.inf) | (low == -math.inf), F.lit("not_finite"))
        .when((low == 0) & (high == 0), F.lit("empty_embedding"))
    )
    return points.withColumn("reject_reason", reason)


def check_models(metadata: DataFrame, known: tuple[str, ...] = KNOWN_MODELS) -> DataFrame:
    """``metadata`` with a ``reject_reason`` for vectors of a model nobody has heard of."""
    unknown = ~F.coalesce(F.col("embedding_model").isin(*known), F.lit(False))
    return metadata.withColumn("reject_reason", F.when(unknown, F.lit("unknown_model")))


def request_defaults(
    queries: DataFrame, top_k: int = TOP_K, min_score: float | None = MIN_SCORE
) -> DataFrame:
    """``queries`` with the defaults of a request where it names no limit, as column or value."""
    defaults = {"top_k": F.lit(top_k), "min_score": F.lit(min_score).cast("double")}
    return queries.withColumns(
        {n: F.coalesce(F.col(n), d) if n in queries.columns else d for n, d in defaults.items()}
    )


def check_queries(queries: DataFrame) -> DataFrame:
    """``queries`` with a ``reject_reason`` for requests outside the accepted bounds."""
    reason = (
        F.when(F.coalesce(F.length("query"), F.lit(0)) < 1, F.lit("empty_query"))
        .when(~F.col("top_k").between(MIN_TOP_K, MAX_TOP_K), F.lit("top_k_out_of_range"))
        .when(~F.col("min_score").between(0.0, 1.0), F.lit("min_score_out_of_range"))
    )
    return queries.withColumn("reject_reason", reason)
