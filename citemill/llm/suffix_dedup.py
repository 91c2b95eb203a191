"""Passages that occur more than once, found by suffix arrays and removed byte by byte.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else as well. To
bring equal strings together, each start is filed under the smallest hash of the ``GRAM``-byte
strings inside its window, which depends on the window alone. Consecutive starts filed
together make a record: its hash, place and a checksum. What follows works on records whose
hash occurs again:

1. records with equal content at different places are repeated as a whole;
2. of different records under one hash, one of each content goes, with its bytes, to a task
   that sorts their suffixes and compares neighbours;
3. hashes whose different records are more than ``CROWDED`` or 2 MB file each single window by
   a 128-bit checksum instead, so no task has to hold them together.

Suffixes are put in order in two stages: those smaller than their successors are sorted
directly, the others are induced from them in one scan over the buckets of first bytes.
Texts move as checksums until a task needs their bytes. Copies of a text are one text here.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from citemill.functions.joins import same_key
from citemill.llm.common import byte_buffer, each_batch, runs, stored, unused

LENGTH, GRAM = 200, 64
CROWDED = 4096
_WINDOW = LENGTH - GRAM + 1
_PIECE = 1 << 20
_CROWDED_BYTES = 2 << 20
_AT_ONCE = 1 << 14  # windows written out to be sorted; more only if all begin alike
_FAR = 255  # stands between records; no byte of UTF-8
_NOISE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64)
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
        0xFF51AFD7ED558CCD, 0xA24BAED4963EE407)


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each position, by doubling their number."""
    found, width = _NOISE[data], 1
    for factor in _MIX:
        found = (found[:-width] * np.uint64(factor)) ^ found[width:]
        found ^= found >> np.uint64(29)
        found *= np.uint64(0xBF58476D1CE4E5B9)
        width *= 2
    return found


def _slide(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` of each ``width`` consecutive values, from running values of blocks."""
    number = len(values) - width + 1
    blocks = np.pad(values, (0, -len(values) % width), mode="edge").reshape(-1, width)
    upto = best.accumulate(blocks, axis=1).ravel()
    onward = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(onward[:number], upto[width - 1 : width - 1 + number])


def records(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Records of concatenated texts: hash, first start, number of starts, places of the hash.

    ``ends`` tells where the texts end. Texts shorter than ``LENGTH`` have none.
    """
    empty = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return empty, empty, empty, empty
    grams = _grams(data)
    least = _slide(grams, _WINDOW, np.minimum)
    starts = np.arange(len(least))
    text = np.searchsorted(ends, starts, "right")
    valid = starts + LENGTH <= ends[text]
    if not valid.any():
        return empty, empty, empty, empty
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new & valid)
    stop = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True)) + 1
    # A gram is an anchor if some window's smallest hash is its own.
    edge = np.zeros(_WINDOW - 1, np.uint64)
    most = _slide(np.concatenate((edge, np.where(valid, least, np.uint64(0)), edge)), _WINDOW, np.maximum)
    anchors = np.flatnonzero((most == grams) & (most != 0))
    value, owner = grams[anchors], np.searchsorted(ends, anchors, "right")
    begins = np.flatnonzero(np.append(True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])))
    places = np.diff(np.append(begins, len(anchors)))
    return least[first].view(np.int64), first, stop - first, places


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[int], np.ndarray, np.ndarray]]:
    """Different texts of a batch in runs of about a piece: rows, offsets inside, bytes, ends."""
    data, at = byte_buffer(batch.column("body"))
    _, rows = np.unique(batch.column("k").to_numpy(), return_index=True)
    row, inside, parts, held = [], [], [], 0
    for r in np.sort(rows).tolist():
        low, high = int(at[r]), int(at[r + 1])
        for x in range(low, max(low + 1, high - LENGTH + 1), _PIECE):
            part = data[x : min(x + _PIECE + LENGTH - 1, high)]
            row.append(r)
            inside.append(x - low)
            parts.append(part)
            held += len(part)
            if held >= _PIECE:
                yield row, inside, np.concatenate(parts), np.cumsum([len(p) for p in parts])
                row, inside, parts, held = [], [], [], 0
    if row:
        yield row, inside, np.concatenate(parts), np.cumsum([len(p) for p in parts])


def _filed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    keys, sizes = batch.column("k").to_numpy(), batch.column("size").to_numpy()
    for row, inside, data, ends in _pieces(batch):
        h, first, number, places = records(data, ends)
        if not len(h):
            continue
        which = np.searchsorted(ends, first, "right")
        begin = np.concatenate(([0], ends[:-1]))[which]
        own = np.array(row)[which]
        view = memoryview(data)
        sums = [
            xxhash.xxh64_intdigest(view[a : a + n + LENGTH - 1]) for a, n in zip(first.tolist(), number.tolist())
        ]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(h),
                pa.array(np.array(sums, np.uint64).view(np.int64)),
                pa.array(keys[own]),
                pa.array(sizes[own]),
                pa.array(first - begin + np.array(inside)[which]),
                pa.array(number),
                pa.array(places),
            ],
            names=["h", "rec", "k", "size", "a", "n", "places"],
        )


def _sort_directly(text: np.ndarray, starts: np.ndarray, depth: int) -> None:
    """Sort ``starts`` in place by the ``depth`` bytes from each.

    First by a word of 8 bytes, then whole windows of a few words at a time, so that not all
    windows are written out at once.
    """
    if not len(starts):
        return
    width = min(8, depth)
    words = np.zeros((len(starts), 8), np.uint8)
    words[:, :width] = np.lib.stride_tricks.sliding_window_view(text, width)[starts]
    words = words.view(">u8").ravel().astype(np.uint64)
    order = np.argsort(words, kind="stable")
    starts[:] = starts[order]
    words = words[order]
    edges = np.concatenate(([0], np.flatnonzero(words[1:] != words[:-1]) + 1, [len(words)]))
    windows = np.lib.stride_tricks.sliding_window_view(text, depth)
    for first, last in runs(edges, _AT_ONCE, len(edges)):
        part = starts[edges[first] : edges[last]]
        part[:] = part[np.argsort(windows[part].view(f"S{depth}").ravel(), kind="stable")]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` but its last ``depth``, by the ``depth`` bytes that follow each.

    The last ``depth + 1`` bytes must be equal and not smaller than others. Equal strings follow
    each other in any order.
    """
    n = len(text) - depth
    here = text[:n]
    turn = np.where(here != text[1 : n + 1], np.arange(n), n - 1)
    turn = np.minimum.accumulate(turn[::-1])[::-1]
    small = (text[turn] < text[turn + 1]) | (turn == n - 1)
    direct = np.flatnonzero(small)
    _sort_directly(text, direct, depth)
    counts = np.bincount(here, minlength=256)
    small_counts = np.bincount(here[direct], minlength=256)
    bucket = np.concatenate(([0], np.cumsum(counts)))
    split = bucket[1:] - small_counts
    order = np.empty(n, np.int64)
    taken = np.concatenate(([0], np.cumsum(small_counts)))
    for c in np.flatnonzero(small_counts).tolist():
        order[split[c] : bucket[c + 1]] = direct[taken[c] : taken[c + 1]]
    head = bucket[:-1].copy()

    def induce(found: np.ndarray) -> None:
        before = found[found > 0] - 1
        before = before[~small[before]]
        first = here[before]
        by_first = np.argsort(first, kind="stable")
        before = before[by_first]
        values, begin, number = np.unique(first[by_first], return_index=True, return_counts=True)
        for c, b, m in zip(values.tolist(), begin.tolist(), number.tolist()):
            order[head[c] : head[c] + m] = before[b : b + m]
            head[c] += m

    for c in np.flatnonzero(counts).tolist():
        at = bucket[c]
        while at < head[c]:  # suffixes of one repeated byte fill their own bucket
            upto = int(head[c])
            induce(order[at:upto])
            at = upto
        induce(order[split[c] : bucket[c + 1]])
    return order


def repeated_starts(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Marks of all starts whose window occurs again in these strings, and where each begins."""
    joined = bytes([_FAR]).join(parts) + bytes([_FAR]) * (LENGTH + 9)
    text = np.frombuffer(joined, np.uint8)
    sizes = np.array([len(p) for p in parts])
    begin = np.concatenate(([0], np.cumsum(sizes[:-1] + 1)))
    change = np.zeros(len(text) + 1, np.int32)
    np.add.at(change, begin, sizes >= LENGTH)
    np.add.at(change, begin + np.maximum(sizes - LENGTH + 1, 0), -(sizes >= LENGTH).astype(np.int32))
    valid = np.cumsum(change) > 0
    order = suffix_order(text, LENGTH)
    order = order[valid[order]]
    one, two = order[:-1], order[1:]
    words = np.lib.stride_tricks.sliding_window_view(text, 8).copy().view(np.uint64).ravel()
    # The common prefix of neighbours is long enough if all its words are equal; the last
    # word parts most of them.
    for at in (LENGTH - 8, *range(0, LENGTH - 8, 8)):
        alike = words[one + at] == words[two + at]
        one, two = one[alike], two[alike]
    marks = np.zeros(len(text), bool)
    marks[one] = marks[two] = True
    return marks, begin


def _span_rows(k: np.ndarray, size: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(x.astype(np.int64)) for x in (k, size, start, end)], names=["k", "size", "start", "end"]
    )


def _sorted_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of records that are not repeated as a whole; rows come in the order of ``h``."""

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        marks, begin = repeated_starts([r[5] for r in rows])
        k, size, a, whole = (np.array([r[c] for r in rows]) for c in (1, 2, 3, 4))
        edges = np.diff(np.concatenate(([False], marks)).astype(np.int8), append=np.int8(0))
        low, high = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        which = np.searchsorted(begin, low, "right") - 1
        wanted = ~whole[which]
        low, high, which = low[wanted], high[wanted], which[wanted]
        shift = a[which] - begin[which]
        return _span_rows(k[which], size[which], low + shift, high + shift + LENGTH - 1)

    rows: list[tuple] = []
    held = 0
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("h", "k", "size", "a", "whole", "bytes")]
        for row in zip(*columns):
            if rows and row[:4] == rows[-1][:4]:
                continue
            if held >= _PIECE and row[0] != rows[-1][0]:
                yield spans(rows)
                rows, held = [], 0
            rows.append(row)
            held += len(row[5])
    if rows:
        yield spans(rows)


def _window_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for row in zip(*[batch.column(n).to_pylist() for n in ("k", "size", "a", "whole", "bytes")]):
        k, size, a, whole, body = row
        n = len(body) - LENGTH + 1
        sums = b"".join(xxhash.xxh128_digest(body[i : i + LENGTH]) for i in range(n))
        pair = np.frombuffer(sums, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(np.full(n, k)), pa.array(np.full(n, size)),
             pa.array(a + np.arange(n)), pa.array(np.full(n, whole))],
            names=["w1", "w2", "k", "size", "start", "whole"],
        )


def text_keys(rows: DataFrame, row_id: str, text: str) -> DataFrame:
    """Row id, checksum ``k`` and ``size`` of each text, and the text as bytes; null is empty."""
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return rows.select(
        F.col(row_id).alias("row_id"), body.alias("body")
    ).select("row_id", F.xxhash64("body").alias("k"), F.octet_length("body").cast("bigint").alias("size"), "body")


def repeated_spans(rows: DataFrame, row_id: str = "doc_id", text: str = "text",
                   crowded: int = CROWDED) -> DataFrame:
    """For each different text that has any, ``spans``: array of (start, end), in bytes.

    Texts are told by ``k`` and ``size`` (see ``text_keys``). Spans may touch or overlap.
    ``whole`` tells that the text has copies and is long enough, so that all of it goes;
    its spans are then left out. An empty table gives an empty one.
    """
    texts = text_keys(rows, row_id, text)
    copies = texts.groupBy("k", "size").agg(F.count("*").alias("copies"), F.min("row_id").alias("least"))
    copies = stored(copies.filter(F.col("size") >= LENGTH), "texts")
    filed = texts.filter(F.col("size") >= LENGTH).select("k", "size", "body").mapInArrow(
        each_batch(_filed), "h long, rec long, k long, size long, a long, n long, places long"
    )
    # Hashes are counted in the tasks first and records looked up by a join, which splits the
    # records of a passage that is in many texts. Making records twice is cheaper than keeping them.
    again = filed.groupBy("h").agg(F.count("*").alias("records"), F.max("places").alias("most"))
    again = again.filter("records > 1 or most > 1").select(F.col("h").alias("h_"))
    filed = stored(filed.join(again, same_key("h", "h_"), "left_semi"), "recurring-records")

    place = F.xxhash64("k", "size", "a")
    contents = filed.groupBy("h", "rec").agg(
        F.min(place).alias("low"), F.max(place).alias("high"), F.max("places").alias("places"),
        F.min(F.struct("k", "size", "a", "n")).alias("at"),
    )
    contents = contents.select(
        "h", "rec", "places", "at.*", (F.col("low") != F.col("high")).alias("whole")
    )
    contents = stored(contents, "record-contents")
    repeated = contents.filter("whole").select(F.col("h").alias("h_"), F.col("rec").alias("rec_"))
    spans = filed.join(repeated, same_key("h", "h_") & (F.col("rec") == F.col("rec_"))).select(
        "k", "size", F.col("a").alias("start"), (F.col("a") + F.col("n") + LENGTH - 1).alias("end")
    )

    mixed = contents.groupBy("h").agg(
        F.count("*").alias("contents"), F.sum(F.col("n") + LENGTH - 1).alias("bytes"), F.max("places").alias("most")
    )
    much = (F.col("contents") > 1) & (F.col("bytes") > _CROWDED_BYTES)
    mixed = mixed.filter("contents > 1 or most > 1").select(
        F.col("h").alias("h_"), ((F.col("contents") > crowded) | much).alias("crowded")
    )
    mixed = stored(mixed, "mixed-hashes")
    wanted = contents.join(mixed, same_key("h", "h_")).groupBy("k", "size").agg(
        F.collect_list(F.struct("h", "a", "n", "whole", "crowded")).alias("wanted")
    )
    wanted = wanted.join(copies, ["k", "size"])
    cut = texts.join(
        wanted.select(F.col("k").alias("k_"), F.col("size").alias("size_"), "least", "wanted"),
        (F.col("k") == F.col("k_")) & (F.col("size") == F.col("size_")) & F.col("row_id").eqNullSafe(F.col("least")),
    )
    cut = cut.select("k", "size", "body", F.explode("wanted").alias("w")).select(
        "w.h", "k", "size", "w.a", "w.whole", "w.crowded",
        F.substring("body", (F.col("w.a") + 1).cast("int"), (F.col("w.n") + LENGTH - 1).cast("int")).alias("bytes"),
    )
    span_schema = "k long, size long, start long, end long"
    apart = cut.filter(~F.col("crowded")).drop("crowded")
    found = (
        apart.repartition("h").sortWithinPartitions("h", "k", "size", "a").mapInArrow(_sorted_spans, span_schema)
    )
    spans = spans.union(found)
    if not mixed.filter("crowded").isEmpty():
        windows = cut.filter("crowded").mapInArrow(
            each_batch(_window_rows), "w1 long, w2 long, k long, size long, start long, whole boolean"
        )
        at = F.xxhash64("k", "size", "start")
        twice = windows.groupBy(F.col("w1").alias("v1"), F.col("w2").alias("v2")).agg(
            F.min(at).alias("low"), F.max(at).alias("high")
        ).filter("low <> high")
        single = windows.filter("not whole").join(twice, same_key("w1", "v1") & (F.col("w2") == F.col("v2")))
        spans = spans.union(single.select("k", "size", "start", (F.col("start") + LENGTH).alias("end")))
    by_text = spans.groupBy("k", "size").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    by_text = copies.join(by_text, ["k", "size"], "left").withColumn("whole", F.col("copies") > 1)
    by_text = by_text.filter("whole or spans is not null").select(
        "k", "size", "whole", F.when(~F.col("whole"), F.col("spans")).alias("spans")
    )
    return stored(by_text, "repeated-spans")


def remove(body: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of ``body``, and how many bytes in how many runs went."""
    kept, at, removed, number, last = [], 0, 0, 0, -1
    for low, high in sorted(spans):
        if low > last:
            kept.append(body[at:low])
            number += 1
            removed += high - low
        elif high > last:
            removed += high - last
        if high > last:
            last = at = high
    kept.append(body[at:])
    return b"".join(kept), removed, number


def _left(body: bytes, spans: list[dict]) -> tuple[bytes, int, int]:
    return remove(body, [(s["start"], s["end"]) for s in spans])


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    found = [
        _left(body, spans) for body, spans in zip(batch.column("body").to_pylist(), batch.column("spans").to_pylist())
    ]
    yield pa.RecordBatch.from_arrays(
        [
            batch.column("k"), batch.column("size"),
            pa.array([x[1] for x in found], pa.int64()),
            pa.array([x[2] for x in found], pa.int64()),
            pa.array([hashlib.sha256(x[0]).hexdigest() for x in found], pa.string()),
        ],
        names=["k", "size", "n_removed", "n_spans", "kept_sha256"],
    )


_CUT = "k long, size long, n_removed long, n_spans long, kept_sha256 string"


def _kept(rows: DataFrame, spans: DataFrame, row_id: str, text: str) -> DataFrame:
    """What is left of the texts of which a part goes; these have no copies."""
    part = spans.filter(~F.col("whole")).select(F.col("k").alias("k_"), F.col("size").alias("size_"), "spans")
    texts = text_keys(rows, row_id, text)
    joined = texts.join(part, (F.col("k") == F.col("k_")) & (F.col("size") == F.col("size_")))
    return joined.select("k", "size", "body", "spans").mapInArrow(each_batch(_cut), _CUT)


def repeat_report(rows: DataFrame, row_id: str = "doc_id", text: str = "text",
                  crowded: int = CROWDED) -> DataFrame:
    """One row per given row: its id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    All matches are judged on the given texts; null counts as empty; texts under ``LENGTH``
    bytes lose nothing, even if they repeat. Rows that repeat are copies, whatever their ids.
    Other columns are ignored; an empty table gives an empty one.
    """
    spans = repeated_spans(rows, row_id, text, crowded)
    kept = _kept(rows, spans, row_id, text)
    whole = spans.filter("whole").select(
        "k", "size", F.col("size").alias("n_removed"), F.lit(1).cast("bigint").alias("n_spans"),
        F.sha2(F.lit(b""), 256).alias("kept_sha256"),
    )
    changed = stored(kept.unionByName(whole), "changed-texts").withColumnsRenamed({"k": "k_", "size": "size_"})
    texts = text_keys(rows, row_id, text)
    texts = texts.select("row_id", "k", "size", F.sha2("body", 256).alias("sha"))
    none = F.lit(0).cast("bigint")
    return texts.join(changed, (F.col("k") == F.col("k_")) & (F.col("size") == F.col("size_")), "left").select(
        F.col("row_id").alias(row_id),
        F.col("size").alias("n_bytes"),
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )


def without_repeats(rows: DataFrame, row_id: str = "doc_id", text: str = "text",
                    crowded: int = CROWDED) -> DataFrame:
    """``rows`` with what is left of ``text``; all rows and columns stay.

    Bytes are removed, so a character that loses some of its bytes loses all of them.
    A null text stays null; a text that loses all becomes empty. Texts move once, to their
    spans, and are cut where they meet them; columns are of types Arrow can hold.
    """
    given = rows.columns
    k, size, whole, spans, body, left = unused(rows, "k", "size", "whole", "spans", "body", "left")
    found = repeated_spans(rows, row_id, text, crowded)
    found = found.withColumnsRenamed({"k": k, "size": size, "whole": whole, "spans": spans})
    content = F.col(text).cast("binary")
    joined = rows.join(found, (F.xxhash64(content) == F.col(k)) & (F.octet_length(content) == F.col(size)), "left")
    part = F.col(spans).isNotNull()
    other = F.when(F.col(whole), F.lit("")).when(~part, F.col(text)).alias(text)
    joined = joined.select(
        *[other if c == text else F.col(c) for c in given], F.when(part, content).alias(body), spans
    )

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bodies, places = batch.column(body).to_pylist(), batch.column(spans).to_pylist()
        rest = [None if p is None else _left(b, p)[0] for b, p in zip(bodies, places)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in given), pa.array(rest, pa.binary())], names=[*given, left]
        )

    schema = T.StructType([*joined.select(*given).schema, T.StructField(left, T.BinaryType())])
    return joined.mapInArrow(each_batch(cut), schema).select(*[
        F.coalesce(valid_text(F.col(left)), F.col(c)).alias(c) if c == text else F.col(c) for c in given
    ])


def valid_text(body: Column) -> Column:
    """Bytes as text without what is not valid UTF-8."""
    return F.replace(F.make_valid_utf8(body.cast("string")), F.lit("\N{REPLACEMENT CHARACTER}"), F.lit(""))
