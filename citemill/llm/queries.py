"""The queries ``opN_<name>``: each operator over its whole table, with production settings."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from citemill.llm import bpe, common, exact_dedup, fim, html_extract, langid, negatives, packing, quality, sentencepieces, sharding, simhash, suffix_dedup, warc

SHARDS, SEQUENCE, EMBEDDING_SIZE = 24, 2048, 64


def op1_minimax_shards(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = common.documents(spark, folder).select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("digest"),
    )
    return sharding.minimax_shards(rows, "digest", "size", "doc_id", SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    rows = common.documents(spark, folder).select("doc_id", "text")
    return quality.clean_lines(rows).drop("text", "cleaned")


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = common.documents(spark, folder).select("doc_id", "text")
    return exact_dedup.exact_groups(rows).withColumnRenamed("digest", "text_sha256")


def op4_html_trees(spark: SparkSession, folder: str) -> DataFrame:
    rows = common.pages(spark, folder).select("page_id", "url", "html")
    found = html_extract.main_text(rows, html_extract.train())
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    rows = common.documents(spark, folder).select(
        "doc_id", "text", "lang", langid.held_out(F.col("doc_id")).alias("held_out")
    )
    model = langid.fit(rows.filter(~F.col("held_out")), "doc_id", "text", "lang")
    return langid.predict(rows.drop("lang"), model).drop("text")


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.repeat_report(common.documents(spark, folder).select("doc_id", "text"))


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests are taken where the ids are made, as lists of ids are larger than the texts."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = common.documents(spark, folder).select("doc_id", "text")

    def digests(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, encoding = batch.column("ids"), bpe.encoding_of(path)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.diff(ids.offsets.to_numpy()).astype(np.int64)),
                _sha256(x.encode() for x in _spelled(ids, len(encoding.pieces), " ")),
                _sha256(encoding.decoded(ids)),
            ],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    kinds = rows.selectExpr(
        "doc_id", "cast(null as bigint) n_tokens", "cast(null as string) ids_sha256", "cast(null as string) decoded_sha256"
    )
    return bpe.encode(rows, path, public_tokenizers.PATTERN, then=digests, schema=kinds.schema)


def _spelled(ids: pa.ListArray, number: int, between: str) -> list[str]:
    """Lists of ids below ``number`` in decimals."""
    words = pa.array(map(str, range(number))).take(ids.values)
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, words), between).to_pylist()


def _sha256(contents) -> pa.Array:
    return pa.array([hashlib.sha256(x).hexdigest() for x in contents], pa.string())


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(common.documents(spark, folder).select("doc_id", "text"))


def op9_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    """Each page as a response of its own minute and a revisit up to five hours later."""
    records = warc.parse_records(warc_records(common.pages(spark, folder)))
    captured = F.to_timestamp(F.col("warc")["warc-date"], "yyyy-MM-dd'T'HH:mm:ss'Z'")
    records = records.select(
        "record_id", "page_id", F.col("warc")["warc-type"].alias("kind"), F.col("warc")["warc-target-uri"].alias("url"),
        F.col("warc")["warc-payload-digest"].alias("payload_digest"), captured.alias("captured"),
        "status", "headers", F.md5(F.coalesce("body", F.lit(""))).alias("payload_md5"),
    )
    records = common.stored(records, "warc-records")  # parsed once, used for both sides of the join
    return warc.resolve_revisits(records, ("page_id", "payload_md5")).select(
        "record_id", F.col("page_id").alias("payload_page_id"), "canonical_url",
        F.coalesce("refers_to", F.lit(-1).cast("bigint")).alias("refers_to"), "outcome",
        F.array_join(
            F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])),
            "\n",
        ).alias("headers"),
        "payload_md5",
    )


def warc_records(pages: DataFrame) -> DataFrame:
    """WARC records made from pages. The revisit's validators depend on the page's id."""
    tag = F.md5(F.coalesce("html", F.lit("")))
    date = lambda shift: F.date_format(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 60 + shift), "yyyy-MM-dd'T'HH:mm:ss'Z'"
    )
    head = lambda kind, url, shift: F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nWARC-Date: "), date(shift), F.lit("\r\n\r\n"),
    )
    changed = F.concat(F.lit("\r\nLast-Modified: day "), (F.col("page_id") % 7).cast("string"))
    response = F.concat(
        head("response", F.col("url"), 0),
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nServer: a\r\nContent-Length: "),
        F.octet_length(F.coalesce("html", F.lit(""))).cast("string"),
        F.lit("\r\nETag: \""), tag, F.lit("\""), changed, F.lit("\r\n\r\n"), F.coalesce("html", F.lit("")),
    )
    kind = F.pmod(F.col("page_id"), F.lit(5))
    validator = (
        F.when(kind == 0, F.concat(F.lit("\r\nETag: \""), tag, F.lit("\"")))
        .when(kind == 1, F.concat(F.lit("\r\nETag: W/\""), tag, F.lit("\"")))
        .when(kind == 2, changed)
        .when(kind == 3, F.lit("\r\nETag: \"other\""))
        .otherwise(F.lit(""))
    )
    again = F.concat(
        head("revisit", F.concat(F.col("url"), F.lit("#again")), 30 + F.pmod(F.col("page_id"), F.lit(4)) * 6000),
        F.lit("HTTP/1.1 304 Not Modified\r\nConnection: close\r\nServer: b\r\nContent-Length: 0\r\nCache-Control: max-age="),
        (F.col("page_id") % 100).cast("string"), validator, F.lit("\r\n\r\n"),
    )
    records = F.array(
        F.struct((F.col("page_id") * 2).alias("record_id"), response.alias("record")),
        F.struct((F.col("page_id") * 2 + 1).alias("record_id"), again.alias("record")),
    )
    return pages.select("page_id", F.inline(records))


def op10_vector_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packed(common.documents(spark, folder).select("doc_id", "text"))


def packed(rows: DataFrame) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    found = packing.pieces(rows, vocabulary, public_tokenizers.PATTERN, SEQUENCE).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    limits = packing.Limits(SEQUENCE, SEQUENCE, SEQUENCE * SEQUENCE)
    return packing.pack(found, "length", ["doc_id", "piece"], limits)


def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    rows = common.documents(spark, folder).select("doc_id", "text")
    made = fim.transform(rows, fim.Cutting("line", 100, 50, 7)).drop("text")
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", shifted), F.col("vec_id") % 100 == 0, EMBEDDING_SIZE)


def op13_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Digests are taken where the lists are made, as these are larger than the texts."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = common.documents(spark, folder).select("doc_id", "text")

    def digests(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, model = batch.column("ids"), sentencepieces.model_of(path)
        spans = [x.values.to_numpy() for x in (batch.column("begins"), batch.column("ends"))]
        bounds = ids.offsets.to_numpy().tolist()
        crc = [zlib.crc32(spans[1][a:b], zlib.crc32(spans[0][a:b])) for a, b in zip(bounds[:-1], bounds[1:])]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.diff(ids.offsets.to_numpy()).astype(np.int64)),
                _sha256(x.encode() for x in _spelled(ids, len(model.shown), ",")),
                _sha256(sentencepieces.texts_of(model, ids)),
                pa.array(crc, pa.int64()),
            ],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"],
        )

    kinds = rows.selectExpr(
        "doc_id", "cast(null as bigint) n_tokens", "cast(null as string) ids_sha256",
        "cast(null as string) decoded_sha256", "cast(null as bigint) spans_crc32",
    )
    return sentencepieces.encode(rows, path, then=digests, schema=kinds.schema)


QUERIES = {
    f.__name__: f
    for f in (op1_minimax_shards, op2_line_quality, op3_exact_dedup, op4_html_trees, op5_language_id, op6_suffix_dedup, op7_byte_bpe, op8_simhash, op9_warc_revisits, op10_vector_best_fit, op11_fill_in_middle, op12_hard_negatives, op13_sentencepiece)
}
