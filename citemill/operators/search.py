"""Exact nearest-neighbour ranking of many queries against many vectors.

Each task multiplies its batches of vectors with a block of queries and hands on only
rows that can still be among a query's best; a window then ranks what is left. So the
vectors are never shuffled, and what is shuffled grows with queries x tasks x k.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F, types as T

from citemill.functions import vectors as vec
from citemill.operators import blocks
from citemill.operators.embed import Encoder
from citemill.session import stored

# Limits and defaults of a search request.
TOP_K, MIN_TOP_K, MAX_TOP_K = 3, 1, 20
MIN_SCORE = 0.5

# Queries are sent to the tasks in blocks of this size at most.
QUERY_BLOCK_BYTES = 64 << 20
# Vectors that a task gathers before it goes through several blocks.
_GATHERED_BYTES = 64 << 20
_QUERIES_PER_PRODUCT = 256
_PAIRS_PER_PRODUCT = 16384


class _Queries:
    """A block of queries with the lengths of their vectors, as used inside a task."""

    def __init__(self, ids: pa.Array, matrix: np.ndarray, k: np.ndarray, floor: np.ndarray):
        self.ids, self.k, self.floor = ids, k, floor
        self.matrix = matrix.astype(np.float64)
        self.norm = np.sqrt((self.matrix**2).sum(axis=1))
        self.unit = (self.matrix / self.norm[:, None]).astype(np.float32)


def _arrays(block: pa.Table, dim: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """A block of queries as plain arrays, the form in which it is sent to tasks."""
    block = block.combine_chunks()
    ids = block.column("q_id")
    if pa.types.is_large_string(ids.type):
        ids = ids.cast(pa.string())
    if not block.num_rows:
        empty = np.empty(0)
        return pa.array([], ids.type), np.empty((0, dim)), empty.astype(np.int64), empty
    column = {name: block.column(name).chunk(0) for name in block.column_names}
    floor = pc.fill_null(column["min_score"], -math.inf)
    return (
        ids.chunk(0),
        vec.list_matrix(column["embedding"], dim),
        column["top_k"].to_numpy(),
        floor.to_numpy(zero_copy_only=False),
    )


def _single(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and their lengths in single precision; length 0 for rows without direction.

    Rows whose squares leave the range of single precision are scaled to length 1 first.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        rows = np.asarray(x, dtype=np.float32)
        norm = np.sqrt(np.einsum("ij,ij->i", rows, rows))
        odd = np.flatnonzero(~((norm > 1e-15) & (norm < 1e15)))
        if len(odd):
            exact = x[odd].astype(np.float64)
            length = np.sqrt((exact**2).sum(axis=1))
            fine = np.isfinite(length) & (length > 0)
            rows = rows.copy()
            rows[odd] = np.where(fine[:, None], exact / np.where(fine, length, 1)[:, None], 0)
            norm[odd] = fine
    return rows, norm


def _exact(q: _Queries, qi: np.ndarray, x: np.ndarray, xi: np.ndarray) -> np.ndarray:
    """Cosine in double of the pairs (qi, xi); the same for equal rows wherever they lie."""
    scores = np.empty(len(qi))
    for at in range(0, len(qi), _PAIRS_PER_PRODUCT):
        part = slice(at, at + _PAIRS_PER_PRODUCT)
        a, b = qi[part], x[xi[part]].astype(np.float64)
        dots = (q.matrix[a] * b).sum(axis=1)
        scores[part] = dots / (q.norm[a] * np.sqrt((b**2).sum(axis=1)))
    return scores


def _best_of_batch(q: _Queries, best: np.ndarray, x: np.ndarray, rank: np.ndarray):
    """Pairs of a batch that may be among a query's best, as (query, row, score).

    A product in single precision finds candidates; its error has a known bound, and all
    rows within that bound are scored again in double. ``best`` holds each query's best
    scores so far, in falling order, and is brought up to date.
    """
    single, norm = _single(x)
    usable = np.flatnonzero(norm > 0)
    if len(usable) < len(x):
        x, single, norm, rank = x[usable], single[usable], norm[usable], rank[usable]
    rows, dim = x.shape
    if not rows:
        return
    error = (dim + 8) * 2.0**-23
    width = best.shape[1]
    for start in range(0, len(q.k), _QUERIES_PER_PRODUCT):
        block = slice(start, start + _QUERIES_PER_PRODUCT)
        near = q.unit[block] @ single.T
        near /= norm
        kth_best = best[block][np.arange(len(near)), q.k[block] - 1]
        seen = np.maximum(kth_best, q.floor[block])
        limit = seen - error
        if rows > width and np.isneginf(kth_best).any():
            kth = np.partition(near, rows - width, axis=1)[:, rows - width]
            limit = np.maximum(limit, kth - 2 * error)
        qi, xi = np.nonzero(~(near < limit[:, None].astype(np.float32)))
        scores = _exact(q, qi + start, x, xi)
        found, xi, scores = _admitted(q, best, block, qi, xi, scores, rank)
        yield found, usable[xi], scores


def _admitted(q: _Queries, best: np.ndarray, block: slice, qi: np.ndarray, xi: np.ndarray, scores: np.ndarray, rank: np.ndarray):
    """Scored pairs of some queries and items that are among a query's best; ``best`` is brought up to date."""
    here, width = best[block], best.shape[1]
    seen = np.maximum(here[np.arange(len(here)), q.k[block] - 1], q.floor[block])
    good = scores >= seen[qi]
    qi, xi, scores = qi[good], xi[good], scores[good]
    order = np.lexsort((rank[xi], -scores, qi))
    qi, xi, scores = qi[order], xi[order], scores[order]
    first = np.searchsorted(qi, np.arange(len(here)))
    place = np.arange(len(qi)) - first[qi]
    kept = place < q.k[block][qi]
    qi, xi, scores, place = qi[kept], xi[kept], scores[kept], place[kept]
    fresh = np.full((len(here), width), -math.inf)
    fresh[qi, place] = scores
    merged = np.concatenate([here, fresh], axis=1)
    best[block] = -np.sort(-merged, axis=1)[:, :width]
    return qi + block.start, xi, scores


def _pack(usable: DataFrame, block_rows: int) -> DataFrame:
    """Queries as blocks of at most ``block_rows``, each an Arrow stream in one row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                block = pa.Table.from_batches([batch.slice(at, block_rows)])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, block.schema) as stream:
                    stream.write_table(block)
                made = [pa.array([block.num_rows]), pa.array([sink.getvalue().to_pybytes()])]
                yield pa.RecordBatch.from_arrays(made, ["n", "block"])

    return usable.mapInArrow(pack, "n bigint, block binary")


def _sent_blocks(usable: DataFrame, dim: int, block_rows: int) -> list[Broadcast]:
    """All queries, a broadcast for each ``block_rows`` of them; the driver holds one block."""
    context = usable.sparkSession.sparkContext
    sent, held, rows = [], [], 0

    def send() -> None:
        if held:
            sent.append(context.broadcast(_arrays(pa.concat_tables(held), dim)))

    for row in _pack(usable, block_rows).toLocalIterator():
        if rows and rows + row["n"] > block_rows:
            send()
            held, rows = [], 0
        held.append(pa.ipc.open_stream(row["block"]).read_all())
        rows += row["n"]
    send()
    return sent


class _Found:
    """The best rows of a block of queries so far, as Arrow rows ready to be handed on."""

    def __init__(self, block: Broadcast, names: list[str]):
        self.block, self.names = block, names
        self.best: np.ndarray | None = None
        self.rows: list[pa.RecordBatch] = []
        self.held = 0

    def begin(self, q: _Queries) -> None:
        if self.best is None:
            self.best = np.full((len(q.k), int(q.k.max(initial=1))), -math.inf)

    def add(self, q: _Queries, x: np.ndarray, rank: np.ndarray, batch: pa.RecordBatch) -> None:
        self.begin(q)
        self.keep(q, _best_of_batch(q, self.best, x, rank), batch.select(batch.schema.names[1:]))

    def keep(self, q: _Queries, pairs: Iterator[tuple], batch: pa.RecordBatch) -> None:
        for qi, xi, scores in pairs:
            if not len(qi):
                continue
            at = pa.array(xi)
            kept = [column.take(at) for column in batch.columns]
            found = [pa.array(qi), pa.array(q.k[qi]), pa.array(scores), *kept]
            self.rows.append(pa.RecordBatch.from_arrays(found, self.names))
            self.held += len(qi)
        if self.held > 4 * self.best.size:
            self._cut()

    def _cut(self) -> None:
        """Leave ``top_k`` rows for each query, ties by rising item id."""
        table = pa.Table.from_batches(self.rows)
        order = pc.sort_indices(
            table, [("q_id", "ascending"), ("score", "descending"), (self.names[3], "ascending")]
        ).to_numpy()
        q = table.column("q_id").to_numpy()[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        kept = order[place < table.column("top_k").to_numpy()[order]]
        self.rows = table.take(pa.array(kept)).combine_chunks().to_batches()
        self.held = len(kept)

    def hand_on(self, ids: pa.Array) -> Iterator[pa.RecordBatch]:
        if self.rows:
            self._cut()
            for rows in self.rows:
                yield rows.set_column(0, "q_id", ids.take(rows.column(0)))


def _hits(
    sent: list[Broadcast],
    items: DataFrame,
    item_id: str,
    vector: str,
    dim: int,
    encoder: Callable[[], Encoder] | None,
    carry: tuple[str, ...],
    named: bool,
    top: int,
) -> DataFrame:
    """Ranked hits of all queries in ``sent``; one pass over ``items``.

    Each batch of items is turned into vectors once and multiplied with one block of
    queries after the other. With several blocks, batches are gathered up to a fixed size
    first, so that a block is not opened for a handful of items.
    """
    source = items.select(vector, item_id, *carry)
    packed = source.schema[vector].dataType == T.BinaryType()
    if encoder is None:
        source = source.filter(F.octet_length(vector) == 4 * dim if packed else F.size(vector) == dim)
    id_field = T.StructField("q_id", T.StringType() if named else T.LongType())
    kept = [source.schema[name] for name in (item_id, *carry)]
    schema = T.StructType(
        [id_field, T.StructField("top_k", T.LongType()), T.StructField("score", T.DoubleType())]
        + kept
    )
    names = [f.name for f in schema]

    def local_best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_matrix = encoder() if encoder else lambda vectors: vec.matrix(vectors, dim)
        found = [_Found(block, names) for block in sent]
        one = _Queries(*sent[0].value) if len(sent) == 1 else None
        gathered: list[tuple] = []

        def search() -> None:
            for block in found:
                queries = one or _Queries(*block.block.value)
                for each in gathered:
                    block.add(queries, *each)
                if one is None:
                    vars(block.block).pop("_value", None)  # this worker's copy; read again when needed
            gathered.clear()

        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rank = pc.rank(batch.column(1), "ascending", tiebreaker="first").to_numpy()
            x = to_matrix(batch.column(0))
            gathered.append((x, rank, batch))
            held += x.nbytes
            if one is not None or held >= _GATHERED_BYTES:
                search()
                held = 0
        search()
        for block in found:
            yield from block.hand_on(block.block.value[0])

    found = source.mapInArrow(local_best, schema)
    by_score = Window.partitionBy("q_id").orderBy(F.desc("score"), F.asc(item_id))
    ranked = found.withColumn("rk", F.row_number().over(by_score))
    # The literal limit lets Spark cut each partition before the shuffle.
    ranked = ranked.filter((F.col("rk") <= top) & (F.col("rk") <= F.col("top_k")))
    return ranked.select("q_id", item_id, "score", "rk", *carry)


def usable_queries(queries: DataFrame, dim: int) -> DataFrame:
    """Queries that can find something, as ``q_id, embedding, top_k, min_score``."""
    finite = F.forall("embedding", lambda v: F.coalesce(F.abs(v) < math.inf, F.lit(False)))
    named = queries.schema["q_id"].dataType == T.StringType()
    return queries.filter(
        (F.size("embedding") == dim)
        & F.exists("embedding", lambda v: v != 0)
        & finite
        & F.col("top_k").between(MIN_TOP_K, MAX_TOP_K)
    ).select(
        F.col("q_id").cast("string" if named else "bigint").alias("q_id"),
        "embedding",
        F.col("top_k").cast("bigint").alias("top_k"),
        F.col("min_score").cast("double").alias("min_score"),
    )


def top_k(
    queries: DataFrame,
    items: DataFrame,
    item_id: str = "chunk_id",
    vector: str = "embedding",
    dim: int = vec.DIMENSION,
    encoder: Callable[[], Encoder] | None = None,
    carry: tuple[str, ...] = (),
    block_bytes: int = QUERY_BLOCK_BYTES,
    seed: DataFrame | None = None,
) -> DataFrame:
    """The ``top_k`` items of each query by cosine, ties by rising id.

    ``queries`` has ``q_id, embedding, top_k, min_score``; a null ``min_score`` keeps all.
    Rows of ``queries`` without a vector of ``dim`` finite elements, not all 0, find
    nothing, and such items cannot be found. Those of ``items`` may be packed. With ``encoder``, column ``vector`` of ``items`` holds
    texts that are turned into vectors on the fly and never stored. ``carry`` columns
    come back with each hit.

    Queries are sent to the tasks in blocks of at most ``block_bytes``, however many there
    are; ``items`` are read, and encoded, once. Each query has its own ``q_id``, and
    ``top_k`` is at most ``MAX_TOP_K``, so what a task keeps for a block is bounded, too.

    Each task hands on at most ``top_k`` rows for each query. For tables of very many parts
    ``seed`` may name a small part of ``items``, such as one of its files: it is searched
    first, and what scores below its ``top_k``-th hit cannot be a hit at all and is never
    handed on. The result is the same.
    """
    if seed is not None:
        first = top_k(queries, seed, item_id, vector, dim, encoder, (), block_bytes)
        reached = first.groupBy("q_id").agg(
            F.count("*").alias("seeded"), F.min("score").alias("reached")
        )
        full = F.when(F.col("seeded") == F.col("top_k"), F.col("reached"))
        queries = queries.join(reached, "q_id", "left").withColumn(
            "min_score", F.greatest("min_score", full)
        )
    named = queries.schema["q_id"].dataType == T.StringType()
    usable = usable_queries(queries, dim)
    sent = _sent_blocks(usable, dim, max(1, block_bytes // (8 * dim)))
    return _hits(sent, items, item_id, vector, dim, encoder, carry, named, MAX_TOP_K)


def _ranked(found: DataFrame, item_id: str, carry: tuple[str, ...]) -> DataFrame:
    """The best of all partial results of each query."""
    by_score = Window.partitionBy("q_id").orderBy(F.desc("score"), F.asc(item_id))
    ranked = found.withColumn("rk", F.row_number().over(by_score))
    ranked = ranked.filter((F.col("rk") <= MAX_TOP_K) & (F.col("rk") <= F.col("top_k")))
    return ranked.select("q_id", item_id, "score", "rk", *carry)


def partial_hits(queries: pa.Table, items: pa.Table, dim: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The best items of one block for each query of another: at most ``top_k`` rows a query.

    ``names`` are those of the result: ``q_id, top_k, score``, the item's id and what it carries.
    """
    ids, matrix, k, floor = _arrays(queries, dim)
    q = _Queries(ids, matrix, k, floor)
    rank = pc.rank(items.column(names[3]), "ascending", tiebreaker="first").to_numpy()
    x = vec.list_matrix(items.column("vector").combine_chunks(), dim)
    best = np.full((len(q.k), int(q.k.max(initial=1))), -math.inf)
    for qi, xi, scores in _best_of_batch(q, best, x, rank):
        if len(qi):
            part = items.take(pa.array(xi)).combine_chunks()
            kept = [part.column(c).chunk(0) for c in names[3:]]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(qi)), pa.array(q.k[qi]), pa.array(scores), *kept], names
            )


def _item_rows(items: DataFrame, item_id: str, vector: str, dim: int, carry: tuple[str, ...]) -> DataFrame:
    """Items that can be found, with their vectors as ``vector`` (array of float)."""
    found = items.filter(F.size(vector) == dim)
    return found.select(item_id, *carry, F.col(vector).alias("vector"))


def _hit_schema(queries: DataFrame, items: DataFrame, item_id: str, carry: tuple[str, ...]) -> T.StructType:
    own = [queries.schema["q_id"], T.StructField("top_k", T.LongType()), T.StructField("score", T.DoubleType())]
    return T.StructType([*own, *[items.schema[name] for name in (item_id, *carry)]])


def top_k_two_sided(
    queries: DataFrame,
    items: DataFrame,
    item_id: str = "chunk_id",
    vector: str = "embedding",
    dim: int = vec.DIMENSION,
    carry: tuple[str, ...] = (),
    query_block_bytes: int = 8 << 20,
    item_block_bytes: int = 16 << 20,
) -> DataFrame:
    """``top_k`` for queries that are as many as the items: the same rows, another way.

    Both sides are packed into blocks and stored; each block of one meets each of the other by a
    join on group numbers (``blocks.meet``), so no query passes the driver and none is sent to all
    tasks. A pair of blocks hands on at most ``top_k`` rows a query, and a window ranks what
    is left. What is moved is each side once for every block of the other.
    """
    usable = usable_queries(queries, dim)
    rows = _item_rows(items, item_id, vector, dim, carry)
    schema = _hit_schema(usable, items, item_id, carry)
    names = [f.name for f in schema]
    ours = stored(blocks.packed(usable, max(1, query_block_bytes // (8 * dim))), "query-blocks")
    theirs = stored(blocks.packed(rows, max(1, item_block_bytes // (4 * dim))), "item-blocks")
    left, right = max(1, theirs.count()), max(1, ours.count())

    def work(block: pa.Table, asked: pa.Table) -> Iterator[pa.RecordBatch]:
        return partial_hits(asked, block, dim, names)

    def numbered(frame: DataFrame, groups: int) -> DataFrame:
        return frame.withColumn("block_group", F.pmod("block_group", F.lit(groups)))

    found = blocks.meet(numbered(theirs, left), numbered(ours, right), left, right, work, schema)
    return _ranked(found, item_id, carry)
