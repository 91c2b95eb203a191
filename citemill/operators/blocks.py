"""Two tables of which every row meets every row of the other, block by block.

Rows are packed into blocks, each an Arrow stream in one row. Every block of one side meets
every block of the other by a join on two group numbers: a block of the left is repeated for
each group of the right and the other way round. So both sides are spread over all tasks, the
driver sees no row of either, and a task holds one block of each side at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

BLOCK_BYTES = 4 << 20


def write_stream(table: pa.Table | pa.RecordBatch, compression: str | None = None) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=compression)) as stream:
        stream.write(table)
    return sink.getvalue().to_pybytes()


def read_stream(block: bytes | pa.Buffer) -> pa.Table:
    return pa.ipc.open_stream(block).read_all().combine_chunks()


def packed(
    rows: DataFrame,
    block_rows: int,
    groups: int | None = None,
    arrange: Callable[[pa.Table], list[np.ndarray]] | None = None,
    slab_rows: int | None = None,
) -> DataFrame:
    """``rows`` as blocks of at most ``block_rows``: ``block_group`` (int) and ``block`` (binary).

    Blocks go to the groups in turn, or get rising numbers if none are given. A task gathers ``slab_rows`` rows at a time; ``arrange``
    says which of them make each block, otherwise they are cut as they come. Nothing is shuffled.
    """
    slab_rows = slab_rows or block_rows

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId() * 7919
        held, size = [], 0

        def emit(slab: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal turn
            count = slab.num_rows
            parts = arrange(slab) if arrange else [
                np.arange(a, min(a + block_rows, count)) for a in range(0, count, block_rows)
            ]
            for part in parts:
                block = write_stream(slab.take(pa.array(part)).combine_chunks())
                turn += 1
                columns = [pa.array([turn % groups if groups else turn], pa.int32()), pa.array([block], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["block_group", "block"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            while size >= slab_rows:
                table = pa.Table.from_batches(held)
                yield from emit(table.slice(0, slab_rows))
                held = table.slice(slab_rows).to_batches()
                size -= slab_rows
        if size:
            yield from emit(pa.Table.from_batches(held))

    return rows.mapInArrow(pack, "block_group int, block binary")


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def group_counts(left_rows: int, right_rows: int, left_block: int, right_block: int) -> tuple[int, int]:
    """Groups of each side, about as many as it has blocks."""
    return max(1, -(-left_rows // left_block)), max(1, -(-right_rows // right_block))


def meet(
    left: DataFrame,
    right: DataFrame,
    left_groups: int,
    right_groups: int,
    work: Callable[[pa.Table, pa.Table], Iterator[pa.RecordBatch]],
    schema,
) -> DataFrame:
    """``work`` of every block of ``left`` with every block of ``right``, once each.

    Blocks with equal group numbers meet in one task. A task keeps the block it has read last
    of each side, as rows with the same one follow each other.
    """
    n = tasks(left.sparkSession)
    numbers = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    ours = left.select(F.col("block_group").alias("l"), numbers(right_groups).alias("r"), F.col("block").alias("left_block"))
    theirs = right.select(numbers(left_groups).alias("l"), F.col("block_group").alias("r"), F.col("block").alias("right_block"))
    pairs = ours.repartition(n, "l", "r").join(theirs.repartition(n, "l", "r"), ["l", "r"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[tuple[bytes, pa.Table] | None] = [None, None]

        def opened(side: int, block: bytes) -> pa.Table:
            if last[side] is None or last[side][0] != block:
                last[side] = block, read_stream(block)
            return last[side][1]

        for batch in batches:
            for k in range(batch.num_rows):
                blocks = [batch.column(side)[k].as_py() for side in (0, 1)]
                yield from work(opened(0, blocks[0]), opened(1, blocks[1]))

    return pairs.select("left_block", "right_block").mapInArrow(run, schema)
