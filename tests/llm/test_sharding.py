import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from citemill.llm import sharding


def smallest(sizes, shards):
    """Smallest largest sum of contiguous runs, by trying capacities upwards from the bound."""

    def needed(capacity):
        runs, left = 1, capacity
        for s in sizes:
            if s > left:
                runs, left = runs + 1, capacity
            left -= s
        return runs

    capacity = max(max(sizes), -(-sum(sizes) // shards))
    while needed(capacity) > shards:
        capacity += 1
    return capacity


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, g string, size long").repartition(5)


@pytest.mark.parametrize("seed,shards", [(1, 4), (2, 7), (3, 24)])
def test_capacity_is_the_smallest_and_groups_stay_whole(spark, monkeypatch, seed, shards):
    monkeypatch.setattr(sharding, "SUMMARY", 20)  # so that the summary is refined many times
    r = random.Random(seed)
    rows = [(n, f"{r.randrange(150):05d}", r.randrange(1, 50)) for n in range(600)]
    rows += [(1000 + n, "00077", 9) for n in range(300)]  # a third of all rows
    found = sharding.minimax_shards(table(spark, rows), "g", "size", "id", shards).collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, g, s in rows:
        sizes[g] = sizes.get(g, 0) + s
    by_shard, groups = {}, {}
    for x in found:
        by_shard.setdefault(x.shard, []).append(x)
        groups.setdefault(x.g, set()).add(x.shard)
    assert all(len(s) == 1 for s in groups.values())
    order = [next(iter(groups[g])) for g in sorted(groups)]
    assert order == sorted(order) and set(by_shard) <= set(range(shards))
    largest = max(sum(x.size for x in xs) for xs in by_shard.values())
    assert largest <= smallest([sizes[g] for g in sorted(sizes)], shards)
    for xs in by_shard.values():
        assert sorted(x.slot for x in xs) == list(range(len(xs)))


def test_search_over_known_ends_is_exact():
    r = random.Random(5)
    for _ in range(50):
        sizes = [r.randrange(1, 40) for _ in range(r.randrange(1, 60))]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        known = sharding.Ends(ends, np.ones(len(sizes), bool))
        shards = r.randrange(1, 9)
        assert sharding.smallest_capacity(known, max(sizes), shards) == smallest(sizes, shards)
        assert not known.vague


def test_odd_rows(spark):
    rows = [(1, None, 5), (2, None, None), (None, "a", 3), (3, "a", 0), (3, "a", 0), (4, "b", -7)]
    frame = table(spark, rows).withColumns({"shard": F.lit("x"), "_weight": F.lit(1), "_part": F.lit("p")})
    found = sharding.minimax_shards(frame, "g", "size", "id", 3)
    assert found.columns == ["id", "g", "size", "_weight", "_part", "shard", "slot"]
    got = found.collect()
    assert len(got) == 6 and {x["_part"] for x in got} == {"p"}
    assert len({x.shard for x in got if x.g is None}) == 1
    assert sharding.minimax_shards(table(spark, rows), "g", "size", "id", 1).filter("shard <> 0").isEmpty()
    empty = sharding.minimax_shards(table(spark, rows).limit(0), "g", "size", "id", 3)
    assert empty.isEmpty() and empty.columns[-2:] == ["shard", "slot"]
    with pytest.raises(ValueError):
        sharding.minimax_shards(frame, "g", "size", "id", 0)
