"""As-of join: each row with the last row of another table before it, key by key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from citemill.session import stored

_SIDE, _PART, _NTH, _KNOWN = "_asof_side", "_asof_part", "_asof_nth", "_asof_known"


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    time: str,
    tie: str,
    carry: tuple[str, ...],
) -> DataFrame:
    """``left`` with columns ``carry`` of the last row of ``right`` of the same key up to its time.

    Both have ``key`` and ``time``; a row of ``right`` at the same time counts as earlier, and of
    several at one time the one with the largest ``tie`` (a column of ``right``) is the last. Rows of
    ``left`` without key, time or such a row get nulls; rows of ``right`` without key or time are left
    out. Columns in ``carry`` replace those of ``left`` of their name.

    Both sides are sorted together by range of key and time, and each task hands the last row on
    as it goes, so a key of any size is spread over tasks. Between tasks go the last rows, one
    a task, through the driver. Nothing else is joined, and no row is repeated.
    """
    left = left.drop(*[c for c in carry if c not in (key, time)])
    own = left.columns
    kinds = {f.name: f for f in right.schema}
    nothing = [F.lit(None).cast(kinds[c].dataType).alias(f"_asof_{c}") for c in carry]
    tied = F.lit(None).cast(kinds[tie].dataType).alias("_asof_tie")
    asked = left.select("*", *nothing, tied, F.lit(1).alias(_SIDE))
    blank = [F.lit(None).cast(left.schema[c].dataType).alias(c) for c in own if c not in (key, time)]
    given = right.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).cast(left.schema[key].dataType).alias(key), F.col(time).cast(left.schema[time].dataType).alias(time),
        *blank, *[F.col(c).alias(f"_asof_{c}") for c in carry], F.col(tie).alias("_asof_tie"), F.lit(0).alias(_SIDE),
    )
    both = asked.unionByName(given)
    # What tells rows of one key and time apart, so that these are spread, too.
    apart = F.when(F.col(_SIDE) == 1, F.xxhash64(*own)).otherwise(F.lit(0).cast("bigint"))
    both = both.withColumn("_asof_apart", apart)
    order = [key, time, _SIDE, "_asof_tie", "_asof_apart"]
    carried = [f"_asof_{c}" for c in carry]
    schema = both.selectExpr("*", f"true {_KNOWN}", f"0 {_PART}", f"0L {_NTH}").schema
    for field in schema:
        field.nullable = True
    names = both.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, held = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            # The row held back comes first, as one more row of the other side.
            table = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks()
            count, extra = table.num_rows, int(held is not None)
            given = table.column(_SIDE).to_numpy() == 0
            keys = table.column(key).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
            last = np.maximum.accumulate(np.where(given, np.arange(count), -1))
            found = (last >= 0) & (keys == keys[np.maximum(last, 0)]) & (keys >= 0)
            at = pa.array(np.maximum(last, 0), mask=~found)
            columns = {n: table.column(n) for n in names}
            columns |= {c: table.column(c).take(at) for c in carried}
            columns[_KNOWN] = pa.array(found)
            columns[_PART] = pa.array(np.full(count, part, np.int32))
            columns[_NTH] = pa.array(np.arange(nth - extra, nth - extra + count))
            nth += batch.num_rows
            made = pa.table(columns).slice(extra).combine_chunks()
            if last[-1] >= 0:
                held = table.slice(int(last[-1]), 1).combine_chunks().to_batches()[0]
            yield from made.to_batches()

    placed = both.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)
    placed = stored(placed, "as-of")
    edge = F.struct(_NTH, key, _SIDE, _KNOWN, *carried)
    ends = placed.groupBy(_PART).agg(F.min(F.struct(_NTH, key)).alias("head"), F.max_by(edge, _NTH).alias("tail"))
    handed, last = [], None
    for row in sorted(ends.collect(), key=lambda r: r[_PART]):
        if last is not None and row["head"][key] == last[key]:
            handed.append((row[_PART], last[key], *[last[c] for c in carried]))
        tail = row["tail"]
        # A row of the other side is its own last one; one without leaves what came before, if the key goes on.
        if tail[_KNOWN]:
            last = tail
        elif last is not None and tail[key] != last[key]:
            last = None
    fields = [T.StructField("_at", T.IntegerType()), T.StructField("_key", left.schema[key].dataType)]
    fields += [T.StructField(f"_from{c}", kinds[c].dataType) for c in carry]
    before = left.sparkSession.createDataFrame(handed, T.StructType(fields))
    # One row a task at most.
    joined = placed.filter(F.col(_SIDE) == 1).join(F.broadcast(before), F.col(_PART) == F.col("_at"), "left")
    missing = ~F.col(_KNOWN) & (F.col(key) == F.col("_key"))
    return joined.select(
        *own, *[F.when(missing, F.col(f"_from{c}")).otherwise(F.col(f"_asof_{c}")).alias(c) for c in carry]
    )
