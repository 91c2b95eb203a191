"""Connected components of a table of links, never gathered in one place.

Rounds of two star steps: every node points its larger neighbours, then its smaller ones,
to the smallest it knows, until all links lead to the smallest node of their component. The
number of rounds grows with the logarithm of the longest path. Minima are pre-aggregated and
joins are left to adaptive execution, so a hub may hold most links.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from citemill.functions.joins import same_key
from citemill.llm.common import stored


def unite(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Merge the sets of linked positions; ``parent`` holds each set's smallest position."""
    while len(left):
        a, b = parent[left], parent[right]
        apart = a != b
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        if not len(left):
            return
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def _pointed(links: DataFrame) -> DataFrame:
    """Links with the smallest neighbour of their first node."""
    least = links.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("least"))
    return links.join(least, same_key("a", "k")).select("a", "b", "least")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for all nodes but labels.

    ``links`` has two columns ``a`` and ``b`` of one ordered type. Links that are null, repeated, reversed or
    of a node with itself change nothing. No links give no rows.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(links.filter("a <> b").distinct(), "links")
    before = None
    while True:
        mark = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == before or not mark[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
        before = mark
        both = links.union(links.select("b", "a"))
        large = (
            _pointed(both)
            .filter("b > a")
            .select(F.col("b").alias("a"), F.least("least", "a").alias("b"))
            .distinct()
        )
        small = _pointed(large)
        links = stored(
            small.select("a", F.col("least").alias("b"))
            .union(small.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")))
            .distinct(),
            "links",
        )
