"""Texts larger than a task: given in parts, chunked as if whole, held nowhere as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from citemill.functions import ids, text as tx
from citemill.functions.joins import same_key
from citemill.operators import chunk
from citemill.session import stored

BLOCK_CHARS = 1 << 20
_RANGE = "_range"


def preceding(rows: DataFrame, key: str, order: str, amount: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``amount`` over the rows of the same ``key`` before each, as ``name``.

    ``rows`` should be narrow: they are sorted by range, so that a key of any size is spread
    over tasks, and stored. Only one sum for each range and key meets in one place.
    """
    placed = rows.repartitionByRange(key, order).withColumn(_RANGE, F.spark_partition_id())
    placed = stored(placed, "ranges")
    inside = Window.partitionBy(_RANGE, key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(key).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("bigint")
    ranges = placed.groupBy(key, _RANGE).agg(F.sum(amount).alias(name))
    ranges = ranges.withColumn(name, F.coalesce(F.sum(name).over(across), none))
    summed = placed.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), none))
    joined = summed.join(ranges, [key, _RANGE])
    return joined.select(*rows.columns, (F.col("_inside") + F.col(name)).alias(name))


def _placed(parts: DataFrame, text: str) -> DataFrame:
    """``parts`` that hold a character, with the number of characters before each."""
    twice = F.raise_error(F.concat(F.lit("part given twice: "), F.col("doc_id"), F.lit(" "), F.col("part")))
    sizes = parts.groupBy("doc_id", "part").agg(F.count("*").alias("given"), F.sum(F.length(text)).alias("n"))
    sizes = sizes.filter(F.col("n") > 0).select(
        "doc_id", "part", F.when(F.col("given") > 1, twice.cast("bigint")).otherwise(F.col("n")).alias("n")
    )
    placed = preceding(sizes, "doc_id", "part", "n", "before").withColumnsRenamed({"doc_id": "_doc", "part": "_part"})
    return parts.join(placed, same_key("doc_id", "_doc") & (F.col("part") == F.col("_part"))).drop("_doc", "_part")


def blocks(parts: DataFrame, block: int, reach: int, text: str = "content", carry: tuple[str, ...] = ()) -> DataFrame:
    """The texts in blocks of ``block`` characters, each with the ``reach`` characters after it.

    Columns ``doc_id, block, text`` and ``carry``. A block is made of the pieces of all parts
    that touch it, so parts may be of any sizes and a block is never longer than
    ``block + reach`` characters.
    """
    start = F.col("block") * block
    low = F.greatest(start - F.col("before"), F.lit(0))
    high = F.least(start + block + reach - F.col("before"), F.col("n"))
    first = F.greatest(F.floor((F.col("before") - reach) / block), F.lit(0)).cast("bigint")
    last = F.floor((F.col("before") + F.col("n") - 1) / block).cast("bigint")
    touched = _placed(parts, text).withColumn("block", F.explode(F.sequence(first, last)))
    pieces = touched.select(
        "doc_id", *carry, "block",
        F.struct(
            (F.col("before") + low).alias("at"),
            F.substring(F.col(text), (low + 1).cast("int"), (high - low).cast("int")).alias("piece"),
        ).alias("piece"),
    )
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("piece")), lambda p: p["piece"]), "")
    return pieces.groupBy("doc_id", "block").agg(joined.alias("text"), *[F.min(c).alias(c) for c in carry])


def chunk_fixed_parts(
    parts: DataFrame,
    size: int = chunk.FIXED_SIZE,
    overlap: int = chunk.FIXED_OVERLAP,
    keep_empty: bool = False,
    text: str = "content",
    carry: tuple[str, ...] = (),
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The chunks ``chunk.chunk_fixed`` makes of each document's parts put together.

    ``parts`` has ``doc_id``, ``part`` (any whole numbers, in order, once a document) and
    ``text``; rows without ``doc_id`` or ``part`` are left out, a null text counts as empty,
    and a number given twice in a document stops the job. ``carry`` names columns that are
    alike in all parts of a document. ``chunk_index`` is a bigint here, and the chunks
    of a document are spread over as many tasks as it has blocks.
    """
    step = size - overlap
    per_block = max(1, block_chars // max(step, 1))
    given = parts.filter(F.col("doc_id").isNotNull() & F.col("part").isNotNull()).select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("part").cast("bigint").alias("part"), *carry, text
    )
    windows = chunk.fixed_windows(F.col("text"), size, overlap, keep_empty=True)
    cut = F.slice(windows, 1, per_block)  # what starts behind the block is the next one's
    if not keep_empty:
        cut = F.filter(cut, lambda piece: piece != "")
    made = blocks(given, per_block * step, size - 1, text, carry).select("doc_id", "block", *carry, cut.alias("pieces"))
    if keep_empty:
        made = made.withColumn("before", F.col("block") * per_block)
    else:
        made = stored(made.filter(F.size("pieces") > 0), "blocks")
        counts = made.select("doc_id", "block", F.size("pieces").cast("bigint").alias("n"))
        counts = preceding(counts, "doc_id", "block", "n", "before")
        counts = counts.select(F.col("doc_id").alias("_doc"), F.col("block").alias("_block"), "before")
        made = made.join(counts, same_key("doc_id", "_doc") & (F.col("block") == F.col("_block")))
    exploded = made.select("doc_id", "before", *carry, F.posexplode("pieces").alias("nth", "chunk_text"))
    exploded = exploded.withColumn("chunk_index", F.col("before") + F.col("nth"))
    return exploded.select(
        ids.chunk_id(F.col("doc_id"), F.col("chunk_index")).alias("chunk_id"),
        "doc_id",
        "chunk_index",
        "chunk_text",
        F.length("chunk_text").alias("chunk_size"),
        F.lit(tx.strategy_label("fixed", size, overlap)).alias("chunking_strategy"),
        *carry,
    )
