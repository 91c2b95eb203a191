"""Hard negatives by inner products over an STR-packed R-tree.

Rows are sorted into slabs by the coordinate that varies most, each slab into tiles by the
next ones, down to leaves; every block of tiles is a small tree whose nodes have a smallest box.
A box and a query give an interval for the inner products of all rows in the box, coordinate
by coordinate. Each query takes boxes from its own queue, the one with the highest upper end
first, and leaves out those whose interval lies outside its score window or strictly below the
k-th score it has. All queries of a block go on at once: in each round every query opens one box,
and queries that open the same box share a matrix product.

Blocks of queries and blocks of rows meet by a join (``operators.blocks``), so neither side
passes the driver or is sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from citemill.functions import vectors as vec
from citemill.llm.common import stored
from citemill.operators import blocks

LEAF, FANOUT = 64, 8
_BLOCK_ROWS, _QUERY_ROWS, _SLAB_BLOCKS = 8192, 4096, 8
_NONE = -np.inf


def tiles(x: np.ndarray, order: list[int], size: int) -> list[np.ndarray]:
    """Rows in tiles of at most ``size``: sorted by the first coordinate and cut into slabs, each of
    these by the next, so that all coordinates get about equally many cuts."""
    parts, left = [np.arange(len(x))], list(order)
    while left:
        at, *left = left
        made = []
        for part in parts:
            count = -(-len(part) // size)
            slabs = int(np.ceil(count ** (1 / (len(left) + 1))))
            width = -(-count // slabs) * size
            part = part[np.argsort(x[part, at], kind="stable")]
            made += [part[k : k + width] for k in range(0, len(part), width)]
        parts = made
        if max(map(len, parts)) <= size:
            break
    return [p[k : k + size] for p in parts for k in range(0, len(p), size)]


class Tree:
    """A tree over the rows of a block: leaves first, then nodes over ``FANOUT`` neighbours each."""

    def __init__(self, x: np.ndarray, leaves: list[np.ndarray]):
        self.rows = np.concatenate(leaves)
        sizes = np.array([len(p) for p in leaves])
        self.begins = np.concatenate(([0], np.cumsum(sizes)))
        x = x[self.rows]
        low, high = [np.minimum.reduceat(x, self.begins[:-1])], [np.maximum.reduceat(x, self.begins[:-1])]
        self.children: list[np.ndarray] = [np.empty(0, np.int64)] * len(leaves)
        first, count = 0, len(leaves)
        while count > FANOUT:
            starts = np.arange(0, count, FANOUT)
            self.children += [np.arange(first + s, first + min(s + FANOUT, count)) for s in starts]
            low.append(np.minimum.reduceat(low[-1], starts))
            high.append(np.maximum.reduceat(high[-1], starts))
            first, count = first + count, len(starts)
        self.top = np.arange(first, first + count)
        self.low, self.high = np.concatenate(low), np.concatenate(high)
        self.leaves = len(leaves)


@dataclass
class Queries:
    """Vectors with their labels, own ids, score windows (both ends count) and whether labels must agree."""

    x: np.ndarray
    label: np.ndarray
    own: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool


def search(tree: Tree, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, q: Queries, k: int):
    """The first ``k`` rows of each query in the tree, by falling score, then rising id.

    Returns query numbers, ids and scores, and the number of leaves opened.
    """
    n, nodes = len(q.x), len(tree.low)
    up, down = np.maximum(q.x, 0), np.minimum(q.x, 0)
    queue = np.full((n, nodes), _NONE)
    best = np.full((n, k), _NONE)
    best_ids = np.full((n, k), np.iinfo(np.int64).max)
    opened = 0

    def put(some: np.ndarray, boxes: np.ndarray) -> None:
        low, high = tree.low[boxes].T, tree.high[boxes].T
        most = up[some] @ high + down[some] @ low
        least = up[some] @ low + down[some] @ high
        queue[some[:, None], boxes[None, :]] = np.where(least > q.high[some, None], _NONE, most)

    put(np.arange(n), tree.top)
    going = np.arange(n)
    while len(going):
        box = queue[going].argmax(axis=1)
        most = queue[going, box]
        # Equal to the k-th score may still win by its id.
        on = most >= np.maximum(np.maximum(q.low[going], best[going, -1]), np.finfo(float).min)
        going, box = going[on], box[on]
        queue[going, box] = _NONE
        order = np.argsort(box, kind="stable")
        chosen, first = np.unique(box[order], return_index=True)
        for node, some in zip(chosen.tolist(), np.split(going[order], first[1:])):
            if node >= tree.leaves:
                put(some, tree.children[node])
                continue
            opened += len(some)
            part = tree.rows[tree.begins[node] : tree.begins[node + 1]]
            scores = q.x[some] @ x[part].T
            agree = labels[part][None, :] == q.label[some, None]
            fits = (agree == q.same) & (scores <= q.high[some, None]) & (scores >= q.low[some, None])
            fits &= (scores >= best[some, -1:]) & (ids[part][None, :] != q.own[some, None])
            full = fits.any(axis=1)
            if not full.any():
                continue
            some = some[full]
            both = np.concatenate((best[some], np.where(fits[full], scores[full], _NONE)), axis=1)
            names = np.concatenate((best_ids[some], np.broadcast_to(ids[part], (len(some), len(part)))), axis=1)
            place = np.lexsort((names, -both), axis=-1)[:, :k]
            best[some], best_ids[some] = np.take_along_axis(both, place, 1), np.take_along_axis(names, place, 1)
    at, rank = np.nonzero(best > _NONE)
    return at, best_ids[at, rank], best[at, rank].astype(np.int64), opened


def usable(rows: DataFrame, dim: int, vec_id: str, label: str, vector: str, scale: int) -> DataFrame:
    """Rows that take part, as ``vec_id, label`` (bigint) and ``vector`` (array of int): ``floor(scale * x)``."""
    # Beyond this, sums would no longer be exact.
    most = float(int((2.0**53 / dim) ** 0.5))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    fine = F.forall("vector", lambda x: F.coalesce(F.abs(x) <= most, F.lit(False)))
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return (
        rows.filter(finite & (F.size(vector) == dim))
        .select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), whole.alias("vector"))
        .filter(fine & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
        .withColumn("vector", F.col("vector").cast("array<int>"))
    )


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    return vec.list_matrix(table.column("vector").chunk(0), dim).astype(np.float64) if table.num_rows else np.empty((0, dim))


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _found(items: DataFrame, item_groups: int, asked: DataFrame, dim: int, order: list[int], same: bool, k: int,
           keys: list[str], window: tuple[int, int]) -> DataFrame:
    """Ranked rows for each key of ``asked`` (keys, ``own``, ``label``, ``vector``, and ``bound``, a score)."""
    asked = stored(asked, "queries")
    _, groups = blocks.group_counts(1, asked.count(), 1, _QUERY_ROWS)
    low, high = window

    def work(block: pa.Table, queries: pa.Table) -> Iterator[pa.RecordBatch]:
        x = _matrix(block, dim)
        tree = Tree(x, tiles(x, order, LEAF))
        bound = queries.column("bound")
        ends = [np.full(queries.num_rows, s * np.inf) for s in (-1, 1)]
        if bound.null_count < len(bound):
            score = bound.to_numpy()
            ends = [-(-low * score // 100), high * score // 100]
        q = Queries(_matrix(queries, dim), _numbers(queries, "label"), _numbers(queries, "own"), *(e.astype(np.float64) for e in ends), same)
        at, ids, scores, _ = search(tree, x, _numbers(block, "vec_id"), _numbers(block, "label"), q, k)
        if len(at):
            columns = [queries.column(c).combine_chunks().take(pa.array(at)) for c in keys]
            columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids), pa.array(scores)], names=[*keys, "vec_id", "score"])

    schema = ", ".join(f"{c} bigint" for c in (*keys, "vec_id", "score"))
    query_blocks = blocks.packed(asked, _QUERY_ROWS, groups)
    found = blocks.meet(items, query_blocks, item_groups, groups, work, schema)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column, dim: int, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding",
         scale: int = 256, positives: int = 5, negatives: int = 5, window: tuple[int, int] = (80, 100)) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows of which ``anchor`` (over ``vec_id``) holds. An anchor's positives are the
    first other rows of its label; for each, its negatives are the first rows of other labels whose
    score is between the two percentages of the positive's. Components are ``floor(scale * x)``, scores
    inner products, higher ones first, ties by smaller id.

    Rows without an id or a label, or whose vector is null, of another size than ``dim``, or has
    a component that is null, not finite or too large for exact sums (beyond 2**53 / dim, squared),
    take no part. Rows with the anchor's own id are no other rows; apart from that, rows that repeat
    an id count each. Of anchors that repeat an id, the one with the smallest label and vector
    counts. An anchor without positives, and a positive without negatives, has no row. An empty
    table gives an empty one; other columns are ignored.
    """
    given = usable(rows, dim, vec_id, label, vector, scale)
    spread = given.agg(F.count("*"), *[F.var_pop(F.get("vector", F.lit(i))) for i in range(dim)]).first()
    count = spread[0]
    order = [int(i) for i in np.argsort([-(v or 0) for v in spread[1:]], kind="stable")]
    # Enough blocks for all tasks, though no larger than is good for memory.
    block_rows = int(np.clip(count // (2 * blocks.tasks(rows.sparkSession)), 1024, _BLOCK_ROWS))
    groups, _ = blocks.group_counts(count, 1, block_rows, 1)

    def arrange(slab: pa.Table) -> list[np.ndarray]:
        return tiles(_matrix(slab, dim), order[1:4], block_rows)

    slabs = given.repartitionByRange(F.get("vector", F.lit(order[0])), "vec_id").sortWithinPartitions(
        F.get("vector", F.lit(order[0])), "vec_id"
    )
    items = stored(blocks.packed(slabs, block_rows, groups, arrange, _SLAB_BLOCKS * block_rows), "r-tree")

    once = given.filter(anchor).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("first"))
    anchors = stored(once.select(F.col("vec_id").alias("anchor_id"), "first.*"), "anchors")
    none = F.lit(None).cast("bigint")
    asked = anchors.select("anchor_id", F.col("anchor_id").alias("own"), "label", "vector", none.alias("bound"))
    near = _found(items, groups, asked, dim, order[:4], True, positives, ["anchor_id"], window)
    near = near.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("rank").cast("bigint").alias("nth"), F.col("score").alias("positive_score"))
    asked = near.join(anchors, "anchor_id").select(
        "anchor_id", "positive_id", "nth", "positive_score", F.col("anchor_id").alias("own"), "label", "vector",
        F.col("positive_score").alias("bound"),
    )
    keys = ["anchor_id", "positive_id", "nth", "positive_score"]
    hard = _found(items, groups, asked, dim, order[:4], False, negatives, keys, window)
    return hard.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
