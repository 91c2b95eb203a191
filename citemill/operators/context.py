"""Assemble what an answer is written from: cited context, sources and prompt."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from citemill.functions import scores as sc, text as tx
from citemill.operators.embed import HASH_MODEL

# Wording and layout of context and prompt.
SOURCE_HEAD = "[Source %d]\n%s"
SOURCE_BREAK = "\n\n"
NO_HITS_ANSWER = "No relevant documents found."
ANSWER_MODEL = "gpt-4o-mini"
SYSTEM_PROMPT = """You are a helpful assistant that answers questions based ONLY on the provided context. 
                    If the context doesn't contain enough information, say so. 
                    Be concise and accurate. Cite source numbers when referencing information."""
USER_PROMPT = """Context from documents:

%s

Question: %s

Answer the question using ONLY the context above. Be specific and cite sources."""


def with_confidence(hits: DataFrame) -> DataFrame:
    return hits.withColumn("confidence_level", sc.confidence(F.col("score")))


def fill_defaults(hits: DataFrame) -> DataFrame:
    """``hits`` in which missing payload fields have their default."""
    present = [name for name in sc.PAYLOAD_DEFAULTS if name in hits.columns]
    return hits.withColumns({name: sc.fill_payload(name) for name in present})


def sources(hits: DataFrame, chars: int = tx.SOURCE_PREVIEW_CHARS) -> DataFrame:
    """One row for each cited source, its text cut to a preview."""
    filled = fill_defaults(hits)
    return filled.select(
        "q_id",
        "rk",
        "filename",
        "chunk_index",
        "score",
        tx.source_preview(F.col("text"), chars).alias("text"),
    )


def context(hits: DataFrame) -> DataFrame:
    """One row for each query with hits: numbered sources in rank order.

    A query has at most the permitted number of hits, so its group is small.
    """
    filled = fill_defaults(hits)
    ordered = F.array_sort(F.collect_list(F.struct("rk", "text")))
    parts = F.transform(
        ordered, lambda hit: F.format_string(SOURCE_HEAD, hit["rk"], hit["text"])
    )
    return filled.groupBy("q_id").agg(
        F.count("*").alias("num_sources"),
        F.max("score").alias("best_score"),
        F.array_join(parts, SOURCE_BREAK).alias("context"),
    )


def prompts(queries: DataFrame, hits: DataFrame, model: str = ANSWER_MODEL) -> DataFrame:
    """One row for each query: the messages to send, or the answer if there is no hit."""
    joined = queries.select("q_id", "query").join(context(hits), "q_id", "left")
    found = F.col("context").isNotNull()
    user = F.format_string(USER_PROMPT, F.col("context"), F.col("query"))
    return joined.select(
        "q_id",
        "query",
        F.coalesce("num_sources", F.lit(0)).cast("bigint").alias("num_sources"),
        F.when(found, F.lit(SYSTEM_PROMPT)).alias("system_prompt"),
        F.when(found, user).alias("user_prompt"),
        F.when(~found, F.lit(NO_HITS_ANSWER)).alias("answer"),
        F.when(found, sc.confidence(F.col("best_score"))).alias("confidence_level"),
        F.lit(model).alias("model"),
    )


def envelopes(
    queries: DataFrame, hits: DataFrame, collection: DataFrame, model: str = HASH_MODEL
) -> DataFrame:
    """One row for each query, also without hits: its results in rank order and counts."""
    fields = [c for c in hits.columns if c not in ("q_id", "rk")]
    results = F.array_sort(F.collect_list(F.struct("rk", *fields)))
    found = hits.groupBy("q_id").agg(
        results.alias("results"), F.count("*").alias("num_results")
    )
    total = collection.agg(F.count("*").alias("n")).scalar()
    return (
        queries.select("q_id", "query")
        .join(found, "q_id", "left")
        .select(
            "q_id",
            "query",
            F.lit(model).alias("query_embedding_model"),
            "results",
            F.coalesce("num_results", F.lit(0)).cast("bigint").alias("num_results"),
            total.alias("total_documents"),
        )
    )
