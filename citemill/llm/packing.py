"""Documents as token ids, cut into pieces and packed into as few sequences as can be.

Packing is vector best fit over a histogram. A bin has three capacities: tokens, documents
and attention cost (the sum of squared lengths). Lengths are taken from the longest down;
all pieces of a length go to the bins whose residual capacities, after taking as many as
fit under every constraint, have the smallest weighted norm. Bins in the same state are
handled together, so the plan depends on the number of different lengths and not on the
number of pieces. Each piece finds its place by its rank among all pieces in order of length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from citemill.llm.common import byte_buffer, each_batch, in_order, runs, stored, unused

END = 0
_RUN_BYTES, _RUN_ROWS = 2 << 20, 4096


class Ids:
    """Ids of texts by a vocabulary of ``tokenizers``, as little-endian unsigned 32-bit bytes.

    ``tiktoken`` merges the same vocabulary in half the time. It joins any two tokens whose
    bytes make a token, ``tokenizers`` only those its file lists. If each token by itself is
    put together again from its bytes, the two never differ: two parts of a token that the file
    does not list as its merge would have come up, and been left apart, there too. That is
    checked for the whole vocabulary at the start; if it fails, ``tokenizers`` does it all.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        special = self.tokenizer.get_added_tokens_decoder()
        vocabulary = {t: n for t, n in self.tokenizer.get_vocab().items() if n not in special}
        model, alphabet = self.tokenizer.model, byte_letters()
        self.fast = None
        if all([x.id for x in model.tokenize(t)] == [n] for t, n in vocabulary.items()):
            ranks = {bytes(map(alphabet.__getitem__, t)): n for t, n in vocabulary.items()}
            self.fast = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def batch(self, texts: list[str]) -> list[bytes]:
        if self.fast:
            return [self.fast.encode_to_numpy(t).astype("<u4").tobytes() for t in texts]
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in such vocabularies: itself if it can be seen, else the
    next from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}


_ids: dict[str, Ids] = {}


def ids_by(path: str, pattern: str) -> Ids:
    """The worker's encoder for a vocabulary file, made once."""
    if path not in _ids:
        _ids[path] = Ids(path, pattern)
    return _ids[path]


def pieces(rows: DataFrame, path: str, pattern: str, most: int, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents: row id, ``piece``, ``start``, ``length``, ``ids``.

    A document is the ids of its text and one ``END``; a null text counts as empty. Documents
    of more than ``most`` ids are cut into pieces of ``most``, of which the first may be shorter. ``ids``
    holds little-endian unsigned 32-bit integers. No shuffle; rows that repeat are repeated.
    """
    given = rows.select(F.col(row_id).alias("row_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    end = np.array([END], "<u4").tobytes()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encoder = ids_by(path, pattern)
        _, offsets = byte_buffer(batch.column("body"))
        for first, last in runs(offsets, _RUN_BYTES, _RUN_ROWS):
            part = batch.slice(first, last - first)
            row, number, start, length, ids = [], [], [], [], []
            for k, found in enumerate(encoder.batch(part.column("body").to_pylist())):
                found += end
                total = len(found) // 4
                at = 0
                size = total % most or most
                while at < total:
                    number.append(0 if not at else number[-1] + 1)
                    row.append(k)
                    start.append(at)
                    length.append(size)
                    ids.append(found[4 * at : 4 * (at + size)])
                    at, size = at + size, most
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("row_id").take(pa.array(row)),
                    pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["row_id", "piece", "start", "length", "ids"],
            )

    kind = given.schema["row_id"].dataType.simpleString()
    found = given.mapInArrow(
        each_batch(run), f"row_id {kind}, piece int, start long, length long, ids binary"
    )
    return found.withColumnRenamed("row_id", row_id)


@dataclass
class Limits:
    """Capacities of a sequence and the weights of their residuals in the norm."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.02, 0.2)


@dataclass
class Plan:
    """Where the pieces go that follow each other in order of length, from ``first`` on.

    Of each step, bins from ``bin`` on take ``each`` pieces of ``length`` one after another,
    the first of them at ``offset``.
    """

    first: list[int] = field(default_factory=list)
    length: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    each: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    bins: int = 0


def best_fit(histogram: dict[int, int], limits: Limits) -> Plan:
    """A plan for so many pieces of each length, the longest first.

    A piece that exceeds a limit by itself gets a bin of its own.
    """
    capacity = np.array([limits.tokens, limits.documents, limits.attention], np.float64)
    weights = np.array(limits.weights)
    groups = np.zeros((0, 5), np.int64)  # first bin, bins, residual tokens, documents, attention
    plan, nth = Plan(), 0

    def step(length: int, first_bin: int, each: int, offset: int, number: int) -> None:
        nonlocal nth
        plan.first.append(nth)
        plan.length.append(length)
        plan.bin.append(first_bin)
        plan.each.append(each)
        plan.offset.append(offset)
        nth += number

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        need = np.array([max(length, 1), 1, max(length * length, 1)], np.int64)
        while left:
            fits = (groups[:, 2:] // need).min(axis=1) if len(groups) else np.zeros(0, np.int64)
            open_ = np.flatnonzero(fits > 0)
            if not len(open_):
                bins = left
                each = int((capacity // need).min())
                if each > 0:
                    bins = -(-left // each)
                row = np.array([[plan.bins, bins, limits.tokens, limits.documents, limits.attention]], np.int64)
                plan.bins += bins
                if each == 0:
                    step(length, int(row[0, 0]), 1, 0, left)
                    left = 0
                    continue
                groups = np.concatenate((groups, row))
                continue
            rest = (groups[open_, 2:] - fits[open_, None] * need) / capacity * weights
            chosen = int(open_[np.argmin((rest * rest).sum(axis=1))])
            first, bins, *residual = groups[chosen].tolist()
            each = int(fits[chosen])
            full = min(bins, left // each)
            offset = limits.tokens - residual[0]
            new = []
            if full:
                step(length, first, each, offset, full * each)
                new.append([first, full, *(np.array(residual) - each * need)])
                left -= full * each
            if full < bins:
                some = left if left < each else 0
                if some:
                    step(length, first + full, some, offset, some)
                    new.append([first + full, 1, *(np.array(residual) - some * need)])
                    left, full = 0, full + 1
                if full < bins:
                    new.append([first + full, bins - full, *residual])
            groups = np.concatenate((np.delete(groups, chosen, axis=0), np.array(new, np.int64)))
            groups = groups[(groups[:, 2:] > 0).all(axis=1)]
    return plan


def pack(rows: DataFrame, length: str, order: list[str], limits: Limits) -> DataFrame:
    """``rows`` with ``sequence_id`` and ``offset`` (long), the place each takes.

    ``length`` is an integer column; null or negative counts as 0, and such rows fit like pieces of one token. ``order`` tells rows of one length apart; where it doesn't, any order holds. The driver sees one
    number for each length. Columns named like the new ones are replaced; an empty table
    gives an empty one.
    """
    rows = rows.drop("sequence_id", "offset")
    size, nth = unused(rows, "size", "nth")
    keep = rows.columns
    sized = rows.withColumn(size, -F.greatest(F.coalesce(F.col(length).cast("bigint"), F.lit(0)), F.lit(0)))
    sized = stored(sized, "pieces")
    histogram = {-r["size"]: r["count"] for r in sized.groupBy(F.col(size).alias("size")).count().collect()}
    plan = best_fit(histogram, limits)
    placed, _ = in_order(sized, [size, *order], {nth: None}, "pieces-by-length")
    steps = [np.array(x, np.int64) for x in (plan.first, plan.length, plan.bin, plan.each, plan.offset)]
    schema = rows.selectExpr("*", "0L sequence_id", "0L offset").limit(0).schema
    for column in schema:
        column.nullable = True

    def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        first, long, bin_, each, offset = steps
        rank = batch.column(nth).to_numpy(zero_copy_only=False)
        k = np.searchsorted(first, rank, "right") - 1
        within = rank - first[k]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c) for c in keep],
                pa.array(bin_[k] + within // each[k]),
                pa.array(offset[k] + within % each[k] * long[k]),
            ],
            names=[*keep, "sequence_id", "offset"],
        )

    return placed.mapInArrow(each_batch(place), schema)
