"""Join conditions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def same_key(left: str, right: str) -> Column:
    """Equality of two keys, for joins with rows that were grouped by ``right`` before.

    Grouped rows are already parted by their key, and Spark would use that for the join;
    adaptive execution splits the rows of a skewed key only where both sides were shuffled
    for the join itself. The second, implied key makes it do so. A side small enough is
    broadcast as ever.
    """
    return (F.col(left) == F.col(right)) & (F.xxhash64(left) == F.xxhash64(right))
