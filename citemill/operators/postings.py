"""Exact search over sparse vectors by an inverted index with upper bounds.

The index is parted by items: a shard holds some thousand of them with the rows they carry and, for
every dimension, the list of its items that have a weight there, largest weight first (whatever its
sign); from the lists come the items' whole vectors. Weights are relative to the item's length, so with a query of length 1
the sum of products is the cosine. A query that has to beat a score leaves out a shard's longest
lists as long as all they could add stays below the score; an item it still wants must then have, in
one of the other lists, a weight of at least what is left of the score over the sum of the
query's own weights there. Only the beginnings of lists that reach that are read. What an item gains
in them, over the most that an item not seen there could have, tells whether it can still reach the
score; only such items are scored, from their whole vectors. The score to beat is the query's own
limit or the k-th best that the task has found so far.

Sums are made where a shard lies, so no posting is ever shuffled: a task hands on at most ``top_k``
rows for each query. The rows are those of ``search.top_k``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.accumulators import Accumulator
from pyspark.sql import DataFrame, functions as F

from citemill.functions import vectors as vec
from citemill.operators import blocks, search
from citemill.session import stored

# A shard ends with the first of these.
SHARD_ROWS, SHARD_WEIGHTS, SHARD_BYTES = 1 << 14, 1 << 20, 8 << 20
# A task that writes or reads shards has about so many bytes of them in memory at a time.
GROUP_BYTES = 8 << 20
_SLICE_ROWS = 1024
_QUERIES_AT_ONCE = 256
_PAIRS_AT_ONCE = 2048
_SLACK = 1e-9  # for sums in double precision


@dataclass
class Index:
    """Shards ``rows, starts, lists``, all binary.

    ``rows`` are the item ids and what they carry; ``lists`` the places and elements of the items'
    vectors by dimension, ``starts`` where each dimension's list begins. Both are compressed.
    """

    shards: DataFrame
    items: DataFrame
    item_id: str
    carry: tuple[str, ...]


_COLUMNS = ("rows", "starts", "lists")


def _relative(x: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Elements by item over the lengths of their items, each of which has one that is not 0."""
    # Scaled by the largest element first, so that no square leaves the range.
    wide, first, count = x.astype(np.float64), ends[:-1], np.diff(ends)
    wide /= np.repeat(np.maximum.reduceat(np.abs(wide), first), count)
    wide /= np.repeat(np.sqrt(np.add.reduceat(wide**2, first)), count)
    return wide


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same numbers in a byte each if all are small and whole, as counts are."""
    if np.abs(x).max(initial=0) <= 127:
        small = x.astype(np.int8)
        if (small == x).all():
            return small
    return x if x.dtype == np.float32 else x.astype(np.float64)


class _Shard:
    """Lists and vectors of some items, as used inside a task."""

    def __init__(self, rows: pa.Buffer, starts: pa.Buffer, lists: pa.Buffer, dim: int):
        self.rows = blocks.read_stream(rows).to_batches()[0]
        self.starts = np.frombuffer(starts, np.int64)
        self.numbers, values = (c.chunk(0).to_numpy() for c in blocks.read_stream(lists).columns)
        self.dim, self.count = dim, np.diff(self.starts)
        by_item = np.argsort(self.numbers, kind="stable")
        self.ends = np.searchsorted(self.numbers[by_item], np.arange(self.rows.num_rows + 1))
        self.dims = np.repeat(np.arange(dim, dtype=np.int32), self.count)[by_item]
        self.values = values[by_item].astype(np.promote_types(values.dtype, np.float32))
        self.weights = np.empty(len(values))
        self.weights[by_item] = _relative(self.values, self.ends)
        self.size = np.abs(self.weights)
        self.rank = pc.rank(self.rows.column(0), "ascending", tiebreaker="first").to_numpy()
        self.high = np.zeros(dim)
        self.high[self.count > 0] = self.size[self.starts[:-1][self.count > 0]]

    def vectors(self, items: np.ndarray) -> np.ndarray:
        found = np.zeros((len(items), self.dim), self.values.dtype)
        first, count = self.ends[items], self.ends[items + 1] - self.ends[items]
        at = np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)
        found[np.repeat(np.arange(len(items)), count), self.dims[at]] = self.values[at]
        return found


def _made(rows: list[pa.RecordBatch], item: list[np.ndarray], dims: list[np.ndarray], values: list[np.ndarray], dim: int) -> pa.RecordBatch:
    """One shard of items whose weights are given in their order."""
    item, at, x = np.concatenate(item), np.concatenate(dims), np.concatenate(values)
    table = pa.Table.from_batches(rows).combine_chunks()
    size = -np.abs(_relative(x, np.searchsorted(item, np.arange(table.num_rows + 1))))
    order = np.argsort(size, kind="stable")
    order = order[np.argsort(at[order], kind="stable")]
    starts = np.append(0, np.cumsum(np.bincount(at, minlength=dim)))
    lists = pa.RecordBatch.from_arrays([pa.array(item[order]), pa.array(_narrow(x)[order])], ["number", "value"])
    parts = [blocks.write_stream(table, "zstd"), starts.astype(np.int64).tobytes(), blocks.write_stream(lists, "zstd")]
    return pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], list(_COLUMNS))


def _has_size(vectors: pa.Array, dim: int) -> pa.Array:
    """Which vectors have ``dim`` elements; null ones have none."""
    listed = pa.types.is_list(vectors.type)
    size = pc.list_value_length(vectors) if listed else pc.binary_length(vectors)
    return pc.fill_null(pc.equal(size, dim if listed else 4 * dim), False)


def _shards(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """Shards of the items of a task; their vectors are the last column."""
    rows, item, dims, values = [], [], [], []
    held = weights = size = 0
    for batch in batches:
        for a in range(0, batch.num_rows, _SLICE_ROWS):
            part = batch.slice(a, _SLICE_ROWS)
            part = part.filter(_has_size(part.column(part.num_columns - 1), dim))
            x = vec.matrix(part.column(part.num_columns - 1), dim)
            good = np.isfinite(x).all(axis=1) & x.any(axis=1)
            if not good.any():
                continue
            kept = pa.RecordBatch.from_arrays(part.columns[:-1], part.schema.names[:-1]).filter(pa.array(good))
            x = x if good.all() else x[good]
            row, at = np.nonzero(x)
            if held and (held + len(x) > SHARD_ROWS or weights + len(row) > SHARD_WEIGHTS or size > SHARD_BYTES):
                yield _made(rows, item, dims, values, dim)
                rows, item, dims, values = [], [], [], []
                held = weights = size = 0
            rows.append(kept)
            item.append((row + held).astype(np.uint16))
            dims.append(at.astype(np.min_scalar_type(dim)))
            values.append(x[row, at])
            held, weights, size = held + len(x), weights + len(row), size + kept.nbytes
    if held:
        yield _made(rows, item, dims, values, dim)


def build(
    items: DataFrame, item_id: str = "chunk_id", vector: str = "embedding", dim: int = vec.DIMENSION, carry: tuple[str, ...] = ()
) -> Index:
    """An index of all items with a direction, in one pass; stored in the shared folder.

    Vectors may be packed. Shards are bounded in rows, weights and bytes, and so is what a task
    holds of them while it writes or reads. Nothing is shuffled and the driver gets nothing.
    """
    # Vectors of another size are left out below: a filter here would have Spark make vectors twice that a function makes.
    source = items.select(item_id, *carry, F.col(vector).alias("vector"))
    shards = source.mapInArrow(lambda batches: _shards(batches, dim), ", ".join(f"{c} binary" for c in _COLUMNS))
    # Shards are large rows and already compressed; by default a hundred are gathered before their bytes count.
    options = {"compression": "uncompressed", "parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": "false"}
    made = stored(shards, "postings", **options)
    return Index(made, source.drop("vector"), item_id, carry)


def limits(x: np.ndarray, floor: np.ndarray, high: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For unit queries the least weight wanted in each dimension's list; infinite if it is left out.

    Every item whose cosine is at least ``floor`` (above 0) has such a weight in one of the lists.
    """
    most = np.abs(x) * high
    order = np.argsort(-np.where(x != 0, count, -1), axis=1, kind="stable")
    so_far = np.cumsum(np.take_along_axis(most, order, 1), axis=1)
    left_out = np.zeros_like(most, bool)
    np.put_along_axis(left_out, order, so_far < (floor - _SLACK)[:, None], axis=1)
    rest = floor - _SLACK - np.where(left_out, most, 0).sum(axis=1)
    own = np.where(left_out, 0, np.abs(x)).sum(axis=1)
    wanted = np.maximum(rest, 0) / np.maximum(own, 1e-300)
    return np.where(left_out | (x == 0), np.inf, wanted[:, None])


def _candidates(x: np.ndarray, floor: np.ndarray, shard: _Shard, read: Accumulator | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a unit query and an item of the shard that can reach the query's ``floor``."""
    high, count = shard.high, shard.count
    all_lists = np.where((x != 0) & (count > 0), 0.0, np.inf)
    wanted = np.where(np.isneginf(floor)[:, None], all_lists, limits(x, np.maximum(floor, -2.0), high, count))
    # Where most would be read anyway, all is: then sums leave hardly anything to be scored.
    spared = (count * (np.isinf(wanted) & (x != 0))).sum(axis=1)
    wanted = np.where((2 * spared < (count * (x != 0)).sum(axis=1))[:, None], all_lists, wanted)
    # The most that an item can have in a list in which it was not seen.
    unseen = np.abs(x) * np.minimum(wanted, high)
    most = unseen.sum(axis=1)
    items, seen = shard.rows.num_rows, 0
    qi, xi = [], []
    for k in range(len(x)):
        lists = np.flatnonzero(wanted[k] <= high)
        ends = [
            int(shard.starts[d] + np.searchsorted(-shard.size[shard.starts[d] : shard.starts[d + 1]], -wanted[k, d], "right"))
            if wanted[k, d] > 0 else int(shard.starts[d + 1])
            for d in lists
        ]
        part, open_ = np.zeros(items), np.full(items, most[k])
        for d, end in zip(lists.tolist(), ends):
            # An item is in a list once, so no place is added to twice.
            where = shard.numbers[shard.starts[d] : end]
            part[where] += x[k, d] * shard.weights[shard.starts[d] : end]
            if unseen[k, d]:
                open_[where] -= unseen[k, d]
            seen += len(where)
        upto = part + open_ + 2 * _SLACK
        found = np.flatnonzero(upto >= floor[k])
        qi.append(np.full(len(found), k))
        xi.append(found)
    if read is not None:
        read.add(seen)
    return np.concatenate(qi), np.concatenate(xi)


class _Found(search._Found):
    """The best rows of a block of queries, found by lists."""

    def pairs(self, q: search._Queries, shard: _Shard, read: Accumulator | None) -> Iterator[tuple]:
        unit = q.matrix / q.norm[:, None]
        for start in range(0, len(q.k), _QUERIES_AT_ONCE):
            block = slice(start, start + _QUERIES_AT_ONCE)
            rows = np.arange(len(q.k[block]))
            floor = np.maximum(self.best[block][rows, q.k[block] - 1], q.floor[block])
            if np.isneginf(floor).any() and shard.rows.num_rows > self.best.shape[1]:
                # With nothing to beat yet, the k-th best of the sums stands for it.
                floor = np.where(np.isneginf(floor), self._begun(unit[block], q.k[block], shard), floor)
            qi, xi = _candidates(unit[block], floor - _SLACK, shard, read)
            for a in range(0, len(qi), _PAIRS_AT_ONCE):
                some = slice(a, a + _PAIRS_AT_ONCE)
                used, place = np.unique(xi[some], return_inverse=True)
                scores = search._exact(q, qi[some] + start, shard.vectors(used), place)
                yield search._admitted(q, self.best, block, qi[some], xi[some], scores, shard.rank)

    def _begun(self, x: np.ndarray, k: np.ndarray, shard: _Shard) -> np.ndarray:
        floor = np.empty(len(x))
        for row in range(len(x)):
            part = np.zeros(shard.rows.num_rows)
            for d in np.flatnonzero(x[row]):
                where = slice(shard.starts[d], shard.starts[d + 1])
                part[shard.numbers[where]] += x[row, d] * shard.weights[where]
            floor[row] = np.partition(part, len(part) - k[row])[len(part) - k[row]] - _SLACK
        return floor

    def look(self, q: search._Queries, shard: _Shard, read: Accumulator | None) -> None:
        self.begin(q)
        self.keep(q, self.pairs(q, shard, read), shard.rows)


def top_k(queries: DataFrame, index: Index, dim: int = vec.DIMENSION, read: Accumulator | None = None) -> DataFrame:
    """What ``search.top_k`` finds. ``read`` is increased by the postings that were looked at.

    Queries are sent to the tasks in blocks, as there.
    """
    usable = search.usable_queries(queries, dim)
    sent = search._sent_blocks(usable, dim, max(1, search.QUERY_BLOCK_BYTES // (8 * dim)))
    schema = search._hit_schema(usable, index.items, index.item_id, index.carry)
    names = [f.name for f in schema]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [_Found(block, names) for block in sent]
        one = search._Queries(*sent[0].value) if len(sent) == 1 else None
        for batch in batches:
            for k in range(batch.num_rows if sent else 0):
                shard = _Shard(*[column[k].as_buffer() for column in batch.columns], dim)
                for each in found:
                    each.look(one or search._Queries(*each.block.value), shard, read)
                    if one is None:
                        vars(each.block).pop("_value", None)  # this worker's copy; read again when needed
        for each in found:
            yield from each.hand_on(each.block.value[0])

    return search._ranked(index.shards.select(*_COLUMNS).mapInArrow(look, schema), index.item_id, index.carry)
