"""Exact search over vectors of one byte a component, with a proven error.

A vector is stored as whole numbers from -127 to 127 and a scale of its own, beside how far the
two are apart relative to the vector's length. The product of a query with the whole numbers
is off by at most that share, so each cosine has an interval. Items whose upper end is below
the k-th lower end of a query cannot be hits; the others are scored again from the vectors
themselves, in double precision. The first pass reads a quarter of the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from citemill.functions import scores as sc, vectors as vec
from citemill.operators import blocks, search
from citemill.session import stored

LEVELS = 127


def encode(items: DataFrame, item_id: str = "chunk_id", vector: str = "embedding", dim: int = vec.DIMENSION) -> DataFrame:
    """``item_id, code, unit, apart``: codes (binary), what one step is of the vector's length, and
    the length of what the code leaves out, relative to the vector's own. No shuffle.

    Vectors of another size or without direction are left out.
    """
    source = items.filter(F.size(vector) == dim).select(item_id, F.col(vector).alias("vector"))
    kind = source.schema[item_id].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = vec.list_matrix(batch.column(1), dim).astype(np.float64)
            with np.errstate(all="ignore"):
                top = np.abs(x).max(axis=1)
                good = np.isfinite(top) & (top > 0)
                # Relative to the largest component, so that no square leaves the range.
                x = np.where(good[:, None], x / np.where(good, top, 1)[:, None], 0)
            whole = np.rint(x * LEVELS)
            length = np.maximum(np.sqrt((x**2).sum(axis=1)), 1e-300)
            apart = np.sqrt(((x - whole / LEVELS) ** 2).sum(axis=1)) / length
            codes = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(dim), len(x), [None, pa.py_buffer(np.ascontiguousarray(whole.astype(np.int8)))]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), codes, pa.array(1 / (LEVELS * length)), pa.array(apart)],
                names=[item_id, "code", "unit", "apart"],
            ).filter(pa.array(good))

    return source.mapInArrow(code, f"`{item_id}` {kind}, code binary, unit double, apart double")


def intervals(asked: np.ndarray, table: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends of the cosines of unit queries with coded items."""
    codes = np.frombuffer(b"".join(table.column("code").to_pylist()), np.int8).reshape(-1, dim)
    near = asked.astype(np.float32) @ codes.T.astype(np.float32)
    near = near.astype(np.float64) * table.column("unit").to_numpy()
    # Besides what the code leaves out, the product in single precision is off.
    error = table.column("apart").to_numpy() + (dim + 8) * 2.0**-23 * (1 + table.column("apart").to_numpy())
    return near - error, near + error


def top_k(
    queries: DataFrame,
    coded: DataFrame,
    items: DataFrame,
    item_id: str = "chunk_id",
    vector: str = "embedding",
    dim: int = vec.DIMENSION,
    carry: tuple[str, ...] = (),
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """What ``search.top_k`` finds among ``items``, of which ``coded`` are the codes.

    Blocks of queries and codes meet by a join; survivors are joined with the vectors by id, which
    must be one of its own for each item.
    """
    usable = search.usable_queries(queries, dim)
    ours = stored(blocks.packed(usable, max(1, block_bytes // (8 * dim))), "query-blocks")
    theirs = stored(blocks.packed(coded, max(1, block_bytes // dim)), "code-blocks")
    left, right = max(1, theirs.count()), max(1, ours.count())

    def work(block: pa.Table, asked: pa.Table) -> Iterator[pa.RecordBatch]:
        x = vec.list_matrix(asked.column("embedding").combine_chunks(), dim).astype(np.float64)
        x /= np.sqrt((x**2).sum(axis=1))[:, None]
        k = asked.column("top_k").to_numpy()
        floor = asked.column("min_score").combine_chunks().fill_null(-2.0).to_numpy(zero_copy_only=False)
        for at in range(0, len(x), 256):
            part = slice(at, at + 256)
            low, high = intervals(x[part], block, dim)
            width = min(int(k[part].max()), low.shape[1])
            ends = -np.sort(-np.partition(low, low.shape[1] - width, axis=1)[:, low.shape[1] - width :], axis=1)
            kth = np.where(k[part] <= width, ends[np.arange(len(ends)), np.minimum(k[part], width) - 1], -2.0)
            qi, xi = np.nonzero(high >= np.maximum(kth, floor[part])[:, None])
            if len(qi):
                rows = pa.array(qi + at)
                yield pa.RecordBatch.from_arrays(
                    [asked.column("q_id").combine_chunks().take(rows), pa.array(k[qi + at]),
                     block.column(item_id).combine_chunks().take(pa.array(xi)), pa.array(low[qi, xi]), pa.array(high[qi, xi])],
                    names=["q_id", "top_k", "item", "low", "high"],
                )

    kinds = {"q_id": usable.schema["q_id"], "item": coded.schema[item_id]}
    schema = ", ".join(
        [f"q_id {kinds['q_id'].dataType.simpleString()}", "top_k bigint", f"item {kinds['item'].dataType.simpleString()}", "low double", "high double"]
    )

    def numbered(frame: DataFrame, groups: int) -> DataFrame:
        return frame.withColumn("block_group", F.pmod("block_group", F.lit(groups)))

    found = stored(blocks.meet(numbered(theirs, left), numbered(ours, right), left, right, work, schema), "candidates")
    placed = found.withColumn("nth", F.row_number().over(Window.partitionBy("q_id").orderBy(F.desc("low"))))
    kth = placed.filter(F.col("nth") == F.col("top_k")).select(F.col("q_id").alias("k_id"), F.col("low").alias("kth"))
    left_over = found.join(kth, F.col("q_id") == F.col("k_id"), "left").filter("kth is null or high >= kth").select("q_id", "item")
    asked = usable.select(F.col("q_id").alias("a_id"), F.col("embedding").alias("asked"), "top_k", "min_score")
    rows = items.select(item_id, *carry, F.col(vector).alias("vector"))
    scored = left_over.join(rows, F.col("item") == F.col(item_id)).join(asked, F.col("q_id") == F.col("a_id"))
    scored = scored.withColumn("score", sc.cosine(F.col("asked"), F.col("vector")))
    scored = scored.filter("min_score is null or score >= min_score")
    return search._ranked(scored, item_id, carry)
