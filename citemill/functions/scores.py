"""Score expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Confidence limits on the unrounded score.
HIGH, MEDIUM = 0.8, 0.6
# What stands in for a missing payload field.
PAYLOAD_DEFAULTS = {
    "chunk_id": "unknown",
    "doc_id": "unknown",
    "filename": "unknown",
    "chunk_index": 0,
    "file_type": "txt",
    "text": "",
}


def confidence(score: Column) -> Column:
    return (
        F.when(score >= HIGH, F.lit("HIGH"))
        .when(score >= MEDIUM, F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays in double precision; null if either has no length."""
    zero = F.lit(0.0)

    def dot(x: Column, y: Column) -> Column:
        terms = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(terms, zero, lambda total, term: total + term)

    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def fill_payload(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(PAYLOAD_DEFAULTS[name]))
