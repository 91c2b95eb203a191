"""Read documents from files. Zero-length files are skipped by Spark's binary source."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from citemill import schemas
from citemill.functions import ids, text as tx
from citemill.operators import validate as val


# The accepted suffixes, in either case, as a file pattern.
TEXT_FILES = "*.{[tT][xX][tT],[mM][dD]}"
PARSER_FILES = "*.[pP][dD][fF]"

PART_BYTES = 8 << 20


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """All files below ``folder`` with an accepted suffix, in either case.

    Other files are left out when the folder is listed. PDF files are listed, but as
    nothing can read them their content is not fetched.
    """

    def files(pattern: str) -> DataFrame:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        return reader.option("pathGlobFilter", pattern).load(folder)

    unread = files(PARSER_FILES).select(
        "path", "modificationTime", "length", F.lit(None).cast("binary").alias("content")
    )
    found = files(TEXT_FILES).unionByName(unread)
    return found.filter(tx.has_supported_suffix(F.col("path")))


def stream(
    spark: SparkSession, folder: str, files_per_batch: int = 1000, pattern: str = "*"
) -> DataFrame:
    """Files as a stream, and those added later.

    With the default pattern files of other types arrive too, to be listed as rejects.
    """
    return (
        spark.readStream.format("binaryFile")
        .schema(schemas.BINARY_FILE)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )


def loaded(files: DataFrame) -> DataFrame:
    """Files as loaded documents: text mode, ids from full paths, sizes in bytes.

    Rows that cannot be read keep a ``reject_reason``. Markdown is kept as text and PDF is
    refused, as there is no parser for either.
    """
    path = F.regexp_replace("path", "^[a-z0-9]+:(//[^/]*)?", "")
    text = F.col("content").cast("string")
    decoded = files.select(
        path.alias("path"), text.alias("content"), "length", "modificationTime"
    )
    reason = val.reject_reason(F.col("path"), F.col("content"))
    return decoded.select(
        ids.name_id(F.col("path")).alias("doc_id"),
        tx.file_name(F.col("path")).alias("filename"),
        tx.universal_newlines(F.try_validate_utf8("content")).alias("content"),
        tx.loader_file_type(F.col("path")).alias("file_type"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("created_at"),
        F.create_map(
            F.lit("path"),
            F.col("path"),
            F.lit("extension"),
            tx.file_suffix(F.col("path")),
        ).alias("metadata"),
        reason.alias("reject_reason"),
    )


def uploaded(files: DataFrame) -> DataFrame:
    """Files as uploaded documents: bytes as they are, ids from file names."""
    name = tx.file_name(F.col("path"))
    decoded = files.select(
        name.alias("filename"),
        F.col("content").cast("string").alias("content"),
        F.col("modificationTime").alias("created_at"),
    )
    return decoded.select(
        ids.name_id(F.col("filename")).alias("doc_id"),
        "filename",
        F.try_validate_utf8("content").alias("content"),
        tx.upload_file_type(F.col("filename")).alias("file_type"),
        F.length(F.try_validate_utf8("content")).cast("bigint").alias("file_size"),
        "created_at",
        val.reject_reason(F.col("filename"), F.col("content")).alias("reject_reason"),
    )


def text_parts(spark: SparkSession, folder: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Text files in parts of about ``part_bytes``, however large the files are.

    Columns ``doc_id, filename, part, content``, to be chunked by ``parts.chunk_fixed_parts``.
    Spark cuts the files into byte ranges (``spark.sql.files.maxPartitionBytes``) and reads each in
    a task of its own; no row holds a whole file, but a line has to fit into one. Parts end at
    lines, so no character is cut. Texts, ids and names are those of ``loaded``, but for a byte
    order mark at the start and the line end at the very end, which are left out. ``content``
    is null where a part is no UTF-8.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", TEXT_FILES)
    path = F.regexp_replace("_metadata.file_path", "^[a-z0-9]+:(//[^/]*)?", "")
    bare = F.translate(F.regexp_replace("value", "\r\\z", ""), "\r", "\n")
    lines = reader.option("lineSep", "\n").text(folder).select(
        F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))).alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.when(F.is_valid_utf8("value"), bare.cast("binary")).alias("line"),
    )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, nth, held, size = None, 0, [], 0

        def flush() -> pa.RecordBatch:
            columns = [[at[0]], [at[1] + nth], [None if None in held else b"".join(held)]]
            kinds = [pa.string(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "part", "content"]
            )

        for batch in batches:
            for path, start, line in zip(*[c.to_pylist() for c in batch.columns]):
                if (path, start) != at:
                    if held:
                        yield flush()
                    # A line end comes before each line but the first of a file.
                    first, at, nth, held, size = start == 0, (path, start), 0, [], 0
                else:
                    first = False
                held.append(line if first or line is None else b"\n" + line)
                size += len(line or b"") + 1
                if size >= part_bytes:
                    yield flush()
                    nth, held, size = nth + 1, [], 0
        if held:
            yield flush()

    read = lines.mapInArrow(joined, "path string, part long, content binary")
    return read.select(
        ids.name_id(F.col("path")).alias("doc_id"),
        tx.file_name(F.col("path")).alias("filename"),
        "part",
        F.col("content").cast("string").alias("content"),
    )
