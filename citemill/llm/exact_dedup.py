"""Exact duplicates: of equal texts the row with the smallest id stays.

Three rounds of combining, each grouping by digest and full content: within a task (Spark's
partial aggregation), over the tasks of one salt, and over the salts. A group with a third
of all rows so reaches the last round with at most ``SALTS`` rows. Rows then learn their
group by digest alone, a join that adaptive execution splits where it is skewed. Digests
that stand for several texts are joined by full text instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from citemill.llm.common import stored

SALTS = 16
BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Runs of blanks become one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def exact_groups(
    rows: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per given row: its id, ``keep_id``, ``group_size``, ``kept``, ``digest``.

    Texts are compared after ``normalised``, so null equals empty. Rows that share an id and
    a text are all kept or all dropped; null ids stay only where a group has no other. The
    digest only speeds things up: another one, however weak, gives the same groups. Other
    columns are ignored and an empty table gives an empty one.
    """
    texts = rows.select(F.col(row_id).alias("row_id"), normalised(F.col(text)).alias("body"))
    texts = texts.select("row_id", "body", digest(F.col("body")).alias("digest"))
    by_salt = texts.groupBy(
        "digest", "body", F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt")
    ).agg(F.min("row_id").alias("row_id"), F.count("*").alias("n"))
    winners = (
        by_salt.repartition("digest")
        .groupBy("digest", "body")
        .agg(F.min("row_id").alias("keep_id"), F.sum("n").alias("group_size"))
        .withColumn("alone", F.count("*").over(Window.partitionBy("digest")) == 1)
    )
    # Full texts are needed again only where a digest does not tell texts apart.
    winners = stored(
        winners.withColumn("body", F.when(~F.col("alone"), F.col("body"))), "exact-winners"
    )
    found = _learn(texts.select("row_id", "digest"), winners.filter("alone").drop("body"), ["digest"])
    shared = winners.filter(~F.col("alone"))
    if not shared.isEmpty():
        found = found.unionByName(_learn(texts, shared, ["digest", "body"]))
    return found.select(
        F.col("row_id").alias(row_id),
        "keep_id",
        "group_size",
        F.col("row_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest"),
    )


def _learn(rows: DataFrame, winners: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(winners, keys).select("row_id", "keep_id", "group_size", "digest")
