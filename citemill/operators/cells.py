"""Exact search that reads only cells which can hold a hit.

Items are filed under the nearest of a fixed number of centroids, and for every cell and every
block of a cell it is known how near to and how far from its centroid the items lie. The angle
between a query and a centroid then bounds the cosine of all items there. A query first reads
the cells with the best bounds, until they hold as many items as it asks for; what it finds is
its floor, and of the other cells it reads those whose bound reaches the floor. Blocks of a
cell are left out in the same way. Nothing is approximate: the rows are those of ``search.top_k``.

Centroids are fitted on at most ``SAMPLE`` rows; every row is filed, wherever it lies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.accumulators import Accumulator
from pyspark.sql import DataFrame, functions as F

from citemill.functions import vectors as vec
from citemill.operators import blocks, search
from citemill.session import stored

SAMPLE, CELLS, ROUNDS = 20_000, 64, 10
BLOCK_ROWS = 1024
# Blocks of a cell beyond so many are read by other tasks.
_PART_BLOCKS = 4


@dataclass
class Index:
    """Blocks of items by cell (``cell, part, low, high, block``), and what is known of each cell.

    ``low`` and ``high`` are the smallest and largest cosine to the centroid; one row a cell.
    """

    blocks: DataFrame
    centroids: np.ndarray
    low: np.ndarray
    high: np.ndarray
    count: np.ndarray
    item_id: str
    carry: tuple[str, ...]
    items: DataFrame

    @property
    def dim(self) -> int:
        return self.centroids.shape[1]

    @property
    def parts(self) -> np.ndarray:
        return np.maximum(1, -(-self.count // (BLOCK_ROWS * _PART_BLOCKS)))


def _error(dim: int) -> float:
    """How far a cosine in single precision may be from the true one."""
    return (dim + 8) * 2.0**-23


def reach(near: np.ndarray, low: np.ndarray, high: np.ndarray, dim: int) -> np.ndarray:
    """The most that the cosine of a query with any item can be.

    ``near`` is the query's cosine to a centroid, ``low`` and ``high`` those of the items.
    """
    e = _error(dim)
    angle = lambda c: np.arccos(np.clip(c, -1, 1))
    outside = angle(near + e) - angle(low - e)
    inside = angle(high + e) - angle(near - e)
    return np.cos(np.maximum(0, np.maximum(outside, inside))) + e


def fit(items: DataFrame, vector: str, item_id: str, dim: int, cells: int = CELLS, sample: int = SAMPLE) -> np.ndarray:
    """Centroids of unit length from at most about ``sample`` rows, chosen by a hash of their ids."""
    usable = items.filter(F.size(vector) == dim)
    share = min(1.0, sample / max(usable.count(), 1))
    draw = F.pmod(F.xxhash64(F.col(item_id)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    drawn = usable.filter(draw).select(F.col(vector).cast("array<double>").alias("v")).toArrow()
    x = vec.list_matrix(drawn.column("v").combine_chunks(), dim) if drawn.num_rows else np.zeros((0, dim))
    norm = np.sqrt((x**2).sum(axis=1))
    good = np.isfinite(norm) & (norm > 0)
    x = np.unique(x[good] / norm[good, None], axis=0)
    if not len(x):
        return np.eye(1, dim)
    rng = np.random.default_rng(1)
    centroids = x[rng.choice(len(x), min(cells, len(x)), replace=False)]
    for _ in range(ROUNDS):
        own = (x @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, x)
        length = np.sqrt((sums**2).sum(axis=1, keepdims=True))
        centroids = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centroids)
    return centroids


def build(
    items: DataFrame,
    item_id: str = "chunk_id",
    vector: str = "embedding",
    dim: int = vec.DIMENSION,
    carry: tuple[str, ...] = (),
    cells: int = CELLS,
    sample: int = SAMPLE,
) -> Index:
    """An index of all items that have a direction; those without cannot be found.

    Stored in the shared folder, sorted by cell and nearness, so that a block holds items of one
    cell that lie about equally far from its centroid. The driver gets one row a cell.
    """
    centroids = fit(items, vector, item_id, dim, cells, sample)
    source = items.filter(F.size(vector) == dim).select(item_id, *carry, F.col(vector).alias("vector"))
    schema = source.selectExpr("*", "0 as cell", "0.0D as near").schema

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, norm = search._single(vec.list_matrix(batch.column(batch.num_columns - 1), dim))
            with np.errstate(invalid="ignore", divide="ignore"):
                near = (rows @ centroids.T.astype(np.float32)) / norm[:, None]
            good = norm > 0
            near[~good] = 0
            cell = near.argmax(axis=1)
            best = near[np.arange(len(near)), cell].astype(np.float64)
            columns = [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(best)]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(
                [*batch.schema, pa.field("cell", pa.int32()), pa.field("near", pa.float64())]
            )).filter(pa.array(good))

    filed = source.mapInArrow(file, schema)
    # Copies of one item are equally near; the id spreads them.
    filed = filed.repartitionByRange("cell", "near", item_id).sortWithinPartitions("cell", "near", item_id)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def emit(rows: pa.Table) -> pa.RecordBatch:
            near = rows.column("near").to_numpy()
            block = blocks.write_stream(rows.drop_columns(["cell", "near"]).combine_chunks())
            values = [rows.column("cell")[0].as_py(), rows.num_rows, float(near.min()), float(near.max()), block]
            kinds = [pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds)], ["cell", "rows", "low", "high", "block"]
            )

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            cell = table.column("cell").to_numpy()
            starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, int)
            cuts = [c for s, e in zip(starts, np.append(starts[1:], len(cell))) for c in range(s, e, BLOCK_ROWS)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield emit(table.slice(a, b - a))
            held = table.slice(cuts[-1]).to_batches() if cuts else []
        if held:
            yield emit(pa.Table.from_batches(held))

    made = stored(filed.mapInArrow(pack, "cell int, rows bigint, low double, high double, block binary"), "cells")
    known = made.groupBy("cell").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("rows").alias("n")).collect()
    low, high, count = np.zeros(len(centroids)), np.zeros(len(centroids)), np.zeros(len(centroids), np.int64)
    for row in known:
        low[row["cell"]], high[row["cell"]], count[row["cell"]] = row["low"], row["high"], row["n"]
    return Index(made, centroids, low, high, count, item_id, carry, source)


def top_k(queries: DataFrame, index: Index, read: Accumulator | None = None) -> DataFrame:
    """What ``search.top_k`` finds among the index's items, for queries of the same form.

    ``read`` is increased by the pairs of a query and an item that were looked at.
    """
    dim = index.dim
    usable = stored(search.usable_queries(queries, dim), "cell-queries")
    schema = search._hit_schema(usable, index.items, index.item_id, index.carry)
    names = [f.name for f in schema]
    first = _visit(usable, index, names, schema, read, True)
    first = stored(first, "first-cells")
    full = F.when(F.count("*") >= F.first("top_k"), F.min("score"))
    best = search._ranked(first.select(*names), index.item_id, index.carry).join(usable.select("q_id", "top_k"), "q_id")
    floors = best.groupBy("q_id").agg(full.alias("floor"))
    again = usable.join(floors, "q_id", "left").withColumn("floor", F.greatest("min_score", "floor")).drop("min_score")
    again = again.withColumnRenamed("floor", "min_score").select(*usable.columns)
    rest = _visit(again, index, names, schema, read, False)
    return search._ranked(first.unionByName(rest), index.item_id, index.carry)


def _visit(queries: DataFrame, index: Index, names, schema, read, begins: bool) -> DataFrame:
    """Partial hits of the cells that each query reads first, or of those it still has to."""
    dim, centroids, parts = index.dim, index.centroids, index.parts
    low, high, count = index.low, index.high, index.count
    kept = [f.name for f in queries.schema]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = vec.list_matrix(batch.column(kept.index("embedding")), dim).astype(np.float64)
            near = (x / np.sqrt((x**2).sum(axis=1))[:, None]) @ centroids.T
            most = np.where(count > 0, reach(near, low, high, dim), -np.inf)
            k = batch.column(kept.index("top_k")).to_numpy()
            order = np.argsort(-most, axis=1, kind="stable")
            so_far = np.cumsum(count[order], axis=1) - count[order]
            begun = np.zeros_like(most, bool)
            np.put_along_axis(begun, order, so_far < k[:, None], axis=1)
            begun &= count > 0
            if begins:
                wanted = begun
            else:
                floor = batch.column(kept.index("min_score")).fill_null(-2.0).to_numpy(zero_copy_only=False)
                wanted = ~begun & (most >= floor[:, None])
            row, cell = np.nonzero(wanted)
            times = parts[cell]
            row, cell = np.repeat(row, times), np.repeat(cell, times)
            part = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(cell.astype(np.int32)), pa.array(part.astype(np.int32))],
                names=[*kept, "cell", "part"],
            )

    n = blocks.tasks(queries.sparkSession)
    asked = queries.mapInArrow(ask, queries.selectExpr("*", "0 as cell", "0 as part").schema)
    number = F.monotonically_increasing_id()
    widths = F.array(*[F.lit(int(p)) for p in parts])
    spread = index.blocks.withColumn("part", F.pmod(number, F.get(widths, F.col("cell")).cast("bigint")).cast("int"))
    packed = asked.repartition(n, "cell", "part").sortWithinPartitions("cell", "part").mapInArrow(
        _by_cell(max(1, (8 << 20) // (8 * dim))), "cell int, part int, asked binary"
    )
    pairs = packed.join(spread.repartition(n, "cell", "part"), ["cell", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, lowest, highest, asked, block in zip(*[c.to_pylist() for c in batch.columns]):
                table = blocks.read_stream(asked)
                x = vec.list_matrix(table.column("embedding").combine_chunks(), dim).astype(np.float64)
                near = (x / np.sqrt((x**2).sum(axis=1))[:, None]) @ centroids[cell]
                floor = table.column("min_score").combine_chunks().fill_null(-2.0).to_numpy(zero_copy_only=False)
                some = np.flatnonzero(reach(near, np.array(lowest), np.array(highest), dim) >= floor)
                if len(some):
                    items = blocks.read_stream(block)
                    if read is not None:
                        read.add(len(some) * items.num_rows)
                    yield from search.partial_hits(table.take(pa.array(some)), items, dim, names)

    return pairs.select("cell", "low", "high", "asked", "block").mapInArrow(run, schema)


def _by_cell(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Queries in the order of cell and part as blocks of at most ``most``, each for one of them."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            key = table.column("cell").to_numpy().astype(np.int64) << 32 | table.column("part").to_numpy()
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(key)]):
                for a in range(s, e, most):
                    part = table.slice(a, min(most, e - a))
                    own = [pa.array([part.column(c)[0].as_py()], pa.int32()) for c in ("cell", "part")]
                    block = blocks.write_stream(part.drop_columns(["cell", "part"]).combine_chunks())
                    yield pa.RecordBatch.from_arrays([*own, pa.array([block], pa.binary())], ["cell", "part", "asked"])

    return pack
