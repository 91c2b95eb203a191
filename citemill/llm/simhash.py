"""Near duplicates by 64-bit SimHash fingerprints, linked at a few differing bits.

Candidates come from a ring of segments, one more than the bits that may differ. For any two
fingerprints near enough there is a segment from which every chain of ``l`` consecutive
segments differs in ``l - 1`` bits at most, the chain's share of the budget. So the first
segment is equal and serves as the key; inside a key, chains of growing length prune pairs
before the full Hamming distance is taken.

Only different fingerprints are compared, and a key hands on a spanning forest of its links,
not its pairs. Keys of more than ``CROWDED`` fingerprints are divided by the chain's second
segment, with one bit left out for each bit it may differ in; if that is not enough, by all
points half the distance away: two fingerprints that share such a point are near, and two
that are near share one. Nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from citemill.llm.common import byte_buffer, each_batch, stored
from citemill.llm.components import components, unite

SHINGLE, SEED, BITS = 4, 42, 64
DISTANCE = 4
CROWDED = 2048
_AT_ONCE = 1 << 16
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(body: bytes) -> int:
    """The fingerprint of a UTF-8 text, as a signed 64-bit integer; 0 if it has no word."""
    words = body.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(SHINGLE, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1]
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(BITS, np.int64)
    for low in range(0, len(starts), _AT_ONCE):
        spans = zip(starts[low : low + _AT_ONCE].tolist(), ends[low + width - 1 :][:_AT_ONCE].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(set_bits * 2 > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(rows: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row_id`` and ``fp`` (long) for each row; a null text counts as empty. No shuffle."""
    given = rows.select(F.col(row_id).alias("row_id"), F.col(text).cast("binary").alias("body"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, at = byte_buffer(batch.column("body"))
        found = [fingerprint(data[a:b].tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_id"), pa.array(found, pa.int64())], names=["row_id", "fp"]
        )

    kind = given.schema["row_id"].dataType.simpleString()
    return given.mapInArrow(each_batch(run), f"row_id {kind}, fp long")


def _segments(distance: int) -> list[tuple[int, int]]:
    """First bit and width of each segment of the ring."""
    number = distance + 1
    edges = [BITS * k // number for k in range(number + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _mask(low: int, width: int) -> int:
    return ((1 << width) - 1) << low


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _and(fp: Column, mask: int) -> Column:
    return fp.bitwiseAND(F.lit(_signed(mask)).cast("bigint"))


def _forest(groups: DataFrame, distance: int) -> DataFrame:
    """Links between the fingerprints of each group, which agree in segment ``ring``.

    ``groups`` has ``ring``, ``key``, ``fp`` and at most ``CROWDED`` rows for each ring and key.
    """
    segments = _segments(distance)
    chains = np.zeros((len(segments), len(segments) - 1), np.uint64)
    for first in range(len(segments)):
        mask = _mask(*segments[first])
        for length in range(1, len(segments)):
            mask |= _mask(*segments[(first + length) % len(segments)])
            chains[first, length - 1] = mask

    def links(ring: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        rows = len(fp)
        bits = fp.view(np.uint64)
        new = np.empty(rows, bool)
        new[0] = True
        new[1:] = (ring[1:] != ring[:-1]) | (key[1:] != key[:-1])
        group = np.cumsum(new) - 1
        left_over = np.append(np.flatnonzero(new)[1:], rows)[group] - np.arange(rows)
        parent = np.arange(rows)
        at, shift = np.arange(rows), 0
        while True:
            shift += 1
            at = at[left_over[at] > shift]
            if not len(at):
                break
            a = at[parent[at] != parent[at + shift]]
            for length in range(chains.shape[1]):
                apart = (bits[a] ^ bits[a + shift]) & chains[ring[a], length]
                a = a[np.bitwise_count(apart) <= length + 1]
            unite(parent, a, a + shift)
        linked = np.flatnonzero(parent != np.arange(rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(fp[linked]), pa.array(fp[parent[linked]])], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            kept.append(tuple(batch.column(n).to_numpy(zero_copy_only=False) for n in ("ring", "key", "fp")))
            if sum(len(x[0]) for x in kept) < _AT_ONCE:
                continue
            ring, key, fp = (np.concatenate(x) for x in zip(*kept))
            # The last group may go on in the next batch.
            last = int(np.flatnonzero((ring != ring[-1]) | (key != key[-1]))[-1]) + 1 if (
                (ring[0] != ring[-1]) or (key[0] != key[-1])
            ) else 0
            if last:
                yield links(ring[:last], key[:last], fp[:last])
            kept = [(ring[last:], key[last:], fp[last:])]
        if sum(len(x[0]) for x in kept):
            yield links(*(np.concatenate(x) for x in zip(*kept)))

    return (
        groups.select("ring", "key", "fp")
        .repartition("ring", "key")
        .sortWithinPartitions("ring", "key")
        .mapInArrow(run, "a long, b long")
    )


def _split(groups: DataFrame, crowded: int, purpose: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows of groups that are not crowded, and those that are, or none."""
    names = ["ring", "key"]
    hot = stored(groups.groupBy(*names).count().filter(F.col("count") > crowded).select(*names), purpose)
    if hot.isEmpty():
        return groups, None
    return groups.join(hot, names, "left_anti"), groups.join(hot, names, "left_semi")


def near_links(prints: DataFrame, distance: int = DISTANCE, crowded: int = CROWDED) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints ``fp`` within ``distance`` bits.

    ``prints`` must hold each once. The links join the same sets as all near pairs would;
    they need not be pairs themselves.
    """
    segments = _segments(distance)
    if distance == 0:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    keyed = prints.select(
        "fp",
        F.posexplode(F.array(*[_and(F.col("fp"), _mask(*s)) for s in segments])).alias("ring", "key"),
    )
    plain, hot = _split(keyed, crowded, "crowded-segments")
    links = _forest(plain, distance)
    if hot is None:
        return links
    # The chain's second segment, with each of its bits left out in turn.
    variants = [
        F.array(*[
            _and(F.col("fp"), _mask(*segments[ring]) | (_mask(*following) ^ (1 << bit)))
            for bit in range(following[0], following[0] + following[1])
        ])
        for ring, following in enumerate(segments[1:] + segments[:1])
    ]
    chosen = F.coalesce(*[F.when(F.col("ring") == k, v) for k, v in enumerate(variants)])
    widest = max(width for _, width in segments)
    finer = hot.select("fp", "ring", F.posexplode(chosen).alias("skip", "rest"))
    # Keys of different bits left out must not meet, so the bit goes into the ring's number.
    finer = finer.select("fp", (F.col("ring") + len(segments) * F.col("skip")).alias("ring"), F.col("rest").alias("key"))
    plain, hot = _split(finer, crowded, "crowded-chains")
    links = links.union(_forest(plain.withColumn("key", F.struct("ring", "key")).select(
        F.pmod("ring", F.lit(len(segments))).cast("int").alias("ring"), F.xxhash64("key").alias("key"), "fp"
    ), distance))
    if hot is None:
        return links
    return links.union(_halfway(hot, segments, distance, widest))


def _halfway(groups: DataFrame, segments: list[tuple[int, int]], distance: int, widest: int) -> DataFrame:
    """Links through shared points half the distance away, over the bits a group leaves free."""
    by_ring = []
    for skip in range(widest):
        for ring, following in enumerate(segments[1:] + segments[:1]):
            fixed = _mask(*segments[ring]) | (_mask(*following) & ~(1 << (following[0] + skip)))
            free = [b for b in range(BITS) if not fixed >> b & 1] if skip < following[1] else []
            flips = [sum(1 << b for b in c) for n in range(distance // 2 + 1) for c in combinations(free, n)]
            by_ring.append((ring + len(segments) * skip, [_signed(f) for f in flips]))
    spark = groups.sparkSession
    # A fixed table: how a group's free bits can be flipped.
    flips = spark.createDataFrame([x for x in by_ring if x[1]], "ring int, flips array<bigint>")
    points = groups.join(F.broadcast(flips), "ring").select("ring", "key", "fp", F.explode("flips").alias("flip"))
    points = points.select("ring", "key", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    least = F.min("fp").over(Window.partitionBy("ring", "key", "point"))
    return points.select(F.col("fp").alias("a"), least.alias("b")).filter("a <> b").distinct()


def near_duplicates(rows: DataFrame, row_id: str = "doc_id", text: str = "text",
                    distance: int = DISTANCE, crowded: int = CROWDED) -> DataFrame:
    """One row per given row: its id, ``fingerprint`` (16 hexadecimal digits), ``component_id``.

    A component is all that links of at most ``distance`` differing bits connect; its id is
    the smallest row id in it, null ids apart. Texts without words have fingerprint zero and
    link like any other. Rows that repeat get equal results; other columns are ignored; an
    empty table gives an empty one. The distance must be even for the split of very crowded keys.
    """
    if distance % 2:
        raise ValueError("the distance must be even")
    prints = stored(fingerprints(rows, row_id, text), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("row_id").alias("least")), "fingerprint-nodes")
    labels = components(near_links(nodes.select("fp"), distance, crowded))
    labelled = nodes.join(labels, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")
    )
    labelled = stored(labelled, "fingerprint-labels")
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    by_print = labelled.join(smallest, "label").select(F.col("fp").alias("print"), "component_id")
    by_print = stored(by_print, "fingerprint-components")
    return prints.join(by_print, F.col("fp") == F.col("print")).select(
        F.col("row_id").alias(row_id),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
