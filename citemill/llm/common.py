"""What the operators share: intermediate tables, Arrow columns, totals by partition."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from citemill.session import work_dir


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Write ``frame`` to the shared folder and read it back.

    What is read no longer depends on what made it, so a lost executor costs no more than
    the tasks it had. The folder goes when the application ends.
    """
    folder = work_dir(frame.sparkSession, purpose)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/pages.parquet")


def unused(rows: DataFrame, *names: str) -> list[str]:
    """Names for helper columns, with as many underscores in front as none of ``rows`` has."""
    taken = {c.lower() for c in rows.columns}
    return [next(n for k in count(1) if (n := "_" * k + name).lower() not in taken) for name in names]


def each_batch(
    work: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that treats each batch with rows by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return run


def in_order(frame: DataFrame, keys: list[str], sums: dict[str, str], purpose: str) -> tuple[DataFrame, dict]:
    """All rows in the order of ``keys``, with what lies before each.

    ``sums`` names new columns and the integer column each adds up; a null column name
    counts rows. The table is parted by range of all keys, so if the last key tells rows of
    one group apart, a group of any size is spread. Every task hands the driver one row of
    totals and nothing else. Returns the stored table, with the new columns, and the totals
    over all rows. Keys may be null (nulls first); summed columns may not.
    """
    spark = frame.sparkSession
    part_name, *offset_names = unused(frame, "part", *[f"{name}_before" for name in sums])
    schema = frame.limit(0).selectExpr("*", *[f"cast(0 as bigint) `{n}`" for n in sums], f"0 as {part_name}").schema
    columns = list(sums.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        so_far = dict.fromkeys(sums, 0)
        for batch in batches:
            added = []
            for name, of in columns:
                size = np.ones(batch.num_rows, np.int64) if of is None else batch.column(of).to_numpy(zero_copy_only=False).astype(np.int64)
                upto = np.cumsum(size) + so_far[name]
                added.append(pa.array(upto - size))
                so_far[name] = int(upto[-1]) if len(upto) else so_far[name]
            parts = pa.array(np.full(batch.num_rows, part, np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added, parts], names=[*batch.schema.names, *sums, part_name]
            )

    placed = stored(
        frame.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema), purpose
    )
    totals = [F.count("*") if of is None else F.sum(of) for of in sums.values()]
    rows = placed.groupBy(F.col(part_name).alias("part")).agg(*[t.alias(n) for t, n in zip(totals, sums)]).collect()
    so_far, offsets = dict.fromkeys(sums, 0), []
    for row in sorted(rows, key=lambda r: r["part"]):
        offsets.append((row["part"], *so_far.values()))
        so_far = {name: so_far[name] + row[name] for name in sums}
    kinds = ", ".join(f"`{name}` bigint" for name in offset_names)
    before = spark.createDataFrame(offsets, f"`{part_name}` int, {kinds}")
    # One row for each task of the sort.
    joined = placed.join(F.broadcast(before), part_name).select(
        *frame.columns, *[(F.col(n) + F.col(o)).alias(n) for n, o in zip(sums, offset_names)]
    )
    return joined, so_far


def byte_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each row's begin and end."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return content[at[0] : at[-1]], at - at[0]


def runs(offsets: np.ndarray, most_bytes: int, most_rows: int) -> Iterator[tuple[int, int]]:
    """Consecutive rows of at most so many bytes and rows; a longer row comes alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most_bytes, "right")) - 1
        last = min(max(last, first + 1), first + most_rows, rows)
        yield first, last
        first = last
