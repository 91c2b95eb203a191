"""The corpus pipeline: stages over all documents, each written as Parquet and read again.

Every stage calls one operator of ``citemill.llm`` on all that the stage before kept. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citemill.llm import common, exact_dedup, langid, queries, simhash, suffix_dedup


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what is too far from every language learned here; fills in missing languages."""
    columns = docs.columns
    known = docs.filter(~langid.held_out(F.col("doc_id")))
    judged = langid.predict(docs, langid.fit(known, "doc_id", "text", "lang"))
    judged = judged.filter(~F.col("rejected")).withColumn("lang", F.coalesce("lang", "lang_pred"))
    return judged.select(*columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest id stays; of rows that repeat, one."""
    columns = docs.columns
    kept = exact_dedup.exact_groups(docs).filter("kept").select("doc_id", "digest")
    digest, kept_id, kept_digest = common.unused(docs, "digest", "kept_id", "kept_digest")
    kept = kept.withColumnsRenamed({"doc_id": kept_id, "digest": kept_digest})
    keyed = docs.withColumn(digest, exact_dedup.sha256(exact_dedup.normalised(F.col("text"))))
    same = F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(digest) == F.col(kept_digest))
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", digest]).select(*columns)


def _row_id() -> Column:
    """The document's id; one beyond all ids for documents without."""
    beyond = F.lit(1 << 62) + F.xxhash64("text").bitwiseAND(F.lit((1 << 61) - 1))
    return F.coalesce(F.col("doc_id").cast("bigint"), beyond)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id."""
    columns = docs.columns
    (row,) = common.unused(docs, "row")
    keyed = docs.withColumn(row, _row_id())
    groups = simhash.near_duplicates(keyed, row)
    kept = groups.filter(F.col(row) == F.col("component_id")).select(row)
    return keyed.join(kept, row, "left_semi").select(*columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur more than once go from all texts; all documents stay."""
    cut = suffix_dedup.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens."""
    return queries.packed(docs.select("doc_id", "text"))


STAGES = [("language", language), ("exact", exact), ("near", near), ("repeats", repeats), ("pack", pack)]

# Languages are learned, fingerprints and suffixes are no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return docs
