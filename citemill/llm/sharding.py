"""Contiguous shards of nearly equal size, none of which splits a group.

Groups are put in the order of their key. The smallest capacity that lets ``shards``
contiguous runs hold all groups is found by binary search, each capacity being checked by
filling shards greedily. The driver does the search over a summary: positions at which some
groups end. Where the search asks for the position just below a value that falls between two
known ones, and groups end in between that the summary leaves out, those stretches are
summed up more finely by one more job. The search ends when all its questions had exact
answers, so its result is that of a search over all groups, though the driver never holds
more than ``SUMMARY`` new positions a round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from citemill.llm.common import in_order, stored, unused

# Positions asked for in a round. About 1 MB on the driver, whatever the input.
SUMMARY = 20_000


class Ends:
    """Known positions at which groups end; ``solid`` tells that none lies up to the next."""

    def __init__(self, ends: np.ndarray, solid: np.ndarray):
        self.ends, self.solid = ends, solid
        self.total = int(ends[-1])
        self.vague: set[int] = set()

    def _at(self, x: int) -> int:
        i = int(np.searchsorted(self.ends, x, "right")) - 1
        if i + 1 < len(self.ends) and self.ends[i] < x and not self.solid[i]:
            self.vague.add(i)
        return i

    def upto(self, x: int) -> int:
        """The last known end not above ``x``."""
        return int(self.ends[self._at(x)])

    def above(self, x: int) -> int:
        """The first known end above the last one not above ``x``."""
        i = min(self._at(x), len(self.ends) - 2)
        if not self.solid[i]:
            self.vague.add(i)
        return int(self.ends[i + 1])

    def fits(self, start: int, capacity: int, shards: int) -> bool:
        """Whether the groups from ``start`` on fill ``shards`` shards at most."""
        for _ in range(shards):
            if start >= self.total:
                return True
            start = self.upto(start + capacity)
        return start >= self.total


def smallest_capacity(ends: Ends, largest: int, shards: int) -> int:
    low = max(largest, -(-ends.total // shards))
    high = -(-ends.total // shards) + largest  # always enough
    while low < high:
        middle = (low + high) // 2
        if ends.fits(0, middle, shards):
            high = middle
        else:
            low = middle + 1
    return low


def cuts(ends: Ends, capacity: int, shards: int) -> list[int]:
    """Where shards begin, the first left out.

    Each shard takes its share of what is left, if the rest then still fits; else it is
    filled to the capacity. No shard exceeds the capacity either way.
    """
    found, start = [], 0
    for left in range(shards, 1, -1):
        share = start + -(-(ends.total - start) // left)
        below, above = ends.upto(share), ends.above(share)
        near = above if below <= start or above - share < share - below else below
        if near > start + capacity or not ends.fits(near, capacity, left - 1):
            near = ends.upto(start + capacity)
        start = near
        found.append(start)
    return found


def _summed(groups: DataFrame, stretches: list[tuple[int, int]]) -> list:
    """First and last end and their number, for equal parts of stretches of positions."""
    parts = max(16, SUMMARY // len(stretches))
    condition, bucket = F.lit(False), F.lit(None).cast("bigint")
    for n, (low, high) in enumerate(stretches):
        inside = (F.col("end") > low) & (F.col("end") < high)
        width = max(1, -(-(high - low) // parts))
        condition = condition | inside
        bucket = F.when(inside, F.floor((F.col("end") - low) / width) + n * (parts + 1)).otherwise(bucket)
    return (
        groups.filter(condition)
        .groupBy(bucket.alias("bucket"))
        .agg(F.min("end").alias("first"), F.max("end").alias("last"), F.count("*").alias("n"))
        .collect()
    )


def plan(groups: DataFrame, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    """Smallest capacity and cuts for groups that end at the positions ``end``."""
    solid_gaps: set[tuple[int, int]] = set()
    known = {0, total}
    vague = [(0, total)]
    while True:
        if vague:
            rows = _summed(groups, vague)
            inside = {v for r in rows for v in (r["first"], r["last"])}
            loose = {(r["first"], r["last"]) for r in rows if r["n"] > 2}
            known |= inside
            ends = np.array(sorted(known), np.int64)
            # Between two buckets nothing ends; within one, only if it has more than two ends.
            for low, high in vague:
                own = ends[(ends >= low) & (ends <= high)]
                solid_gaps |= {g for g in zip(own[:-1].tolist(), own[1:].tolist()) if g not in loose}
        gaps = zip(ends[:-1].tolist(), ends[1:].tolist())
        search = Ends(ends, np.array([g in solid_gaps for g in gaps], bool))
        capacity = smallest_capacity(search, largest, shards)
        found = cuts(search, capacity, shards)
        if not search.vague:
            return capacity, found
        by_width = sorted(search.vague)
        # At most so many stretches a round, so that the condition stays small.
        vague = [(int(ends[i]), int(ends[i + 1])) for i in by_width[:256]]


def minimax_shards(rows: DataFrame, group: str, size: str, row_id: str, shards: int) -> DataFrame:
    """``rows`` with ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 in each shard).

    Rows of equal ``group`` share a shard; groups follow each other in the order of their
    key, rows of a group in the order of ``row_id``, equal ids in any order. A null group is
    a group like others, before all. Sizes must be integers; null or below 1 counts as 1
    for the search only. An empty table gives an empty one. Columns called like the new ones
    are replaced; other columns are kept. One shuffle of the given rows by range of group and
    id; a group that holds a third of all rows is spread over many tasks.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    rows = rows.drop("shard", "slot")
    keep = rows.columns
    weight, begin, nth = unused(rows, "weight", "start", "nth")
    sized = F.greatest(F.coalesce(F.col(size).cast("bigint"), F.lit(1)), F.lit(1))
    keys = list(dict.fromkeys([group, row_id]))
    placed, total = in_order(
        stored(rows.withColumn(weight, sized), "shard-rows"), keys, {begin: weight, nth: None}, "shard-order"
    )
    if not total[nth]:
        return rows.selectExpr("*", "cast(null as int) shard", "cast(null as bigint) slot")
    groups = stored(
        placed.groupBy(F.col(group))
        .agg(F.max(F.col(begin) + F.col(weight)).alias("end"), F.sum(weight).alias("weight"))
        .select("end", "weight"),
        "shard-groups",
    )
    largest = groups.agg(F.max("weight")).first()[0]
    _, starts = plan(groups, total[begin], largest, shards)
    shard = sum((F.col(begin) >= s).cast("int") for s in starts) if starts else F.lit(0)
    dealt = placed.withColumn("shard", shard.cast("int"))
    first, so_far = {}, 0
    for row in sorted(dealt.groupBy("shard").count().collect(), key=lambda r: r["shard"]):
        first[row["shard"]] = so_far
        so_far += row["count"]
    offset = F.coalesce(*[F.when(F.col("shard") == k, F.lit(v).cast("bigint")) for k, v in first.items()])
    return dealt.select(*keep, "shard", (F.col(nth) - offset).alias("slot"))
