"""Cut documents into overlapping chunks. One row in, many rows out, no shuffle."""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from citemill.functions import ids, text as tx, vectors as vec

# Defaults of the two chunkers.
FIXED_SIZE, FIXED_OVERLAP = 200, 50
SENTENCE_SIZE, SENTENCE_OVERLAP_WORDS = 500, 100

# Output rows of the sentence chunker handed back to Spark at a time.
_ROWS_PER_BATCH = 2048
_CHARS_PER_BATCH = 8 << 20
_BLANK = re.compile(" ")


def fixed_windows(
    text: Column,
    size: int = FIXED_SIZE,
    overlap: int = FIXED_OVERLAP,
    keep_empty: bool = False,
) -> Column:
    """Array of stripped windows of ``size`` characters starting every ``size - overlap``.

    One regular expression walks the text once: the look-ahead captures a window, the
    match itself advances by one step. Cutting each window with ``substring`` instead
    would count characters from the start of the text every time, which is quadratic
    in the length of a long document.
    """
    if size < 1 or overlap < 0 or overlap >= size:
        raise ValueError(f"need 0 <= overlap < size, got size={size}, overlap={overlap}")
    window = f"(?s)(?=(.{{1,{size}}})).{{1,{size - overlap}}}"
    pieces = F.transform(F.regexp_extract_all(text, F.lit(window), F.lit(1)), tx.strip)
    return pieces if keep_empty else F.filter(pieces, lambda piece: piece != "")


def chunk_fixed(
    documents: DataFrame,
    size: int = FIXED_SIZE,
    overlap: int = FIXED_OVERLAP,
    keep_empty: bool = False,
    text: str = "content",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Chunks of fixed windows. Empty ones are dropped before numbering unless kept.

    ``carry`` names further document columns to repeat on each chunk.
    """
    pieces = fixed_windows(F.col(text), size, overlap, keep_empty)
    doc_id = F.col("doc_id").cast("string").alias("doc_id")
    cut = documents.select(
        doc_id, *carry, F.posexplode(pieces).alias("chunk_index", "chunk_text")
    )
    return cut.select(
        ids.chunk_id(F.col("doc_id"), F.col("chunk_index")).alias("chunk_id"),
        "doc_id",
        "chunk_index",
        "chunk_text",
        F.length("chunk_text").alias("chunk_size"),
        F.lit(tx.strategy_label("fixed", size, overlap)).alias("chunking_strategy"),
        *carry,
    )


def _packed(text: str, size: int, overlap: int) -> Iterator[tuple[str, int]]:
    """Chunks of one text and their lengths."""
    return ((chunk, length) for chunk, length, *_ in _cut(text, size, overlap))


def _cut(text: str, size: int, overlap: int) -> Iterator[tuple[str, int, int, int, list[str]]]:
    """Chunks of one text, their lengths, first and last words (excluded), and all its words.

    The words of a chunk follow each other in the text, so a chunk is given by its first
    word, its first new sentence and the sentence after its last. That one is found by
    bisection of the summed lengths; words are counted and joined once for the whole text,
    and a chunk is two slices: repeated words, which one blank parts, and new sentences as
    they stand. The blank that joins a sentence to a chunk is not counted against
    ``size``; before the first sentence of all it only counts for the length.
    """
    sentences = [s for part in re.split(tx.SENTENCE_END, text) if (s := part.strip())]
    if not sentences:
        return
    words = [s.split() for s in sentences]
    lengths = [len(s) for s in sentences]
    raw = " ".join(sentences)
    at = list(itertools.accumulate((n + 1 for n in lengths), initial=0))
    word = list(itertools.accumulate(map(len, words), initial=0))
    flat = list(itertools.chain.from_iterable(words))
    plain = " ".join(flat)
    starts = [0, *(m.end() for m in _BLANK.finditer(plain)), len(plain) + 1]
    first, last, tail = 0, 0, ""
    while last < len(sentences):
        new = last
        lead = f"{tail} " if new else ""
        extra = 1 if not new and lengths[0] <= size else 0
        room = size - (len(lead) + extra + lengths[new]) + at[new + 1] + 1
        last = max(new + 1, bisect.bisect_right(at, room) - 1)
        chunk = lead + raw[at[new] : at[last] - 1]
        yield chunk, len(chunk) + extra, first, word[last], flat
        first = max(first, word[last] - overlap)
        tail = plain[starts[first] : starts[word[last]] - 1]


def chunk_sentences(
    documents: DataFrame,
    size: int = SENTENCE_SIZE,
    overlap: int = SENTENCE_OVERLAP_WORDS,
    text: str = "content",
    carry: tuple[str, ...] = (),
    load: Callable[[], Callable[[pa.Array], np.ndarray]] | None = None,
    packed: bool = False,
) -> DataFrame:
    """Chunks of whole sentences; each repeats the last ``overlap`` words before it.

    Where a chunk ends depends on all earlier sentences of the text, so texts are cut in
    Arrow batches. Ids and labels are added by Spark. ``chunk_size`` counts the chunk before
    stripping, as its length decided where to cut. With ``load``, which gives an encoder, a
    column ``embedding`` is made in the same pass, null where the encoder finds nothing; with
    ``packed`` it holds bytes, and a column ``broken`` says what is wrong with a vector.
    """
    if overlap < 1:
        raise ValueError("sentence chunks need an overlap of at least one word")

    names = ["doc_id", *carry]
    source = documents.select(F.col("doc_id").cast("string").alias("doc_id"), *carry, text)
    if packed:
        made_fields = [T.StructField("embedding", T.BinaryType()), T.StructField("broken", T.StringType())]
    else:
        made_fields = [T.StructField("embedding", T.ArrayType(T.FloatType()))]
    made_fields = made_fields if load else []
    schema = T.StructType(
        [source.schema[name] for name in names]
        + [
            T.StructField("chunk_index", T.IntegerType()),
            T.StructField("chunk_text", T.StringType()),
            T.StructField("chunk_size", T.IntegerType()),
        ]
        + made_fields
    )

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load() if load else None
        for batch in batches:
            texts = batch.column(len(names))
            rows: list[int] = []
            index: list[int] = []
            chunks: list[str] = []
            sizes: list[int] = []
            chars, words, runs, here = 0, [], [], 0
            in_runs = getattr(encoder, "windows", None)

            def flush() -> pa.RecordBatch:
                kept = [batch.column(i).take(pa.array(rows, pa.int32())) for i in range(len(names))]
                made = [
                    pa.array(index, pa.int32()),
                    pa.array(chunks, pa.string()),
                    pa.array(sizes, pa.int32()),
                ]
                if encoder:
                    ends = np.array(runs, np.int64).reshape(-1, 2)
                    matrix = in_runs(pa.array(words, pa.string()), *ends.T) if in_runs else np.asarray(encoder(made[1]))
                    made += vec.matrix_packed(matrix) if packed else [vec.matrix_lists(matrix)]
                return pa.RecordBatch.from_arrays(kept + made, [f.name for f in schema])

            for row in range(batch.num_rows):
                content = texts[row].as_py()
                if content is None:
                    continue
                here = 0
                for i, (chunk, length, first, last, own) in enumerate(_cut(content, size, overlap)):
                    if in_runs:  # words of the text that are not yet among those of the batch
                        here = max(here, first) if words else first
                        words += own[here:last]
                        runs.append((len(words) - (last - first), len(words)))
                        here = last
                    rows.append(row)
                    index.append(i)
                    chunks.append(chunk)
                    sizes.append(length)
                    chars += len(chunk)
                    if len(rows) >= _ROWS_PER_BATCH or chars >= _CHARS_PER_BATCH:
                        yield flush()
                        rows, index, chunks, sizes, chars, words, runs = [], [], [], [], 0, [], []
            if rows:
                yield flush()

    cut = source.mapInArrow(fold, schema)
    return cut.select(
        ids.chunk_id(F.col("doc_id"), F.col("chunk_index")).alias("chunk_id"),
        "doc_id",
        "chunk_index",
        "chunk_text",
        "chunk_size",
        F.lit(tx.strategy_label("smart", size, overlap)).alias("chunking_strategy"),
        *carry,
        *[f.name for f in made_fields],
    )


def split_sentences(documents: DataFrame, text: str = "content") -> DataFrame:
    return documents.select(
        "doc_id", F.posexplode(tx.sentences(F.col(text))).alias("sentence_index", "sentence")
    )
