"""Byte-level BPE: distinct words of a batch are merged by rank, each once, and looked up.

Texts are split into words by Spark's regular expressions. In the tasks, the words of an
Arrow batch become numbers of distinct words; words not seen before by the worker are taken as
arrays of bytes and merged in rounds, in each of which every word merges its pair of lowest
rank, the leftmost of equals. Ranks are ids, as in the file: for every two tokens whose bytes
together are a token, the rank map has that token. Long words go through a queue instead, in
time in proportion to their length but for a logarithm.

Decoding joins the binary pieces of all ids. Nothing is shuffled.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from citemill.llm.common import byte_buffer, each_batch, runs, unused
from citemill.llm.merging import Pairs

# The characters of Unicode white space, for Java's regular expressions.
BLANK = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_RUN_WORDS, _RUN_ROWS = 1 << 20, 8192
_KEPT_WORDS = 300_000  # merged words that a worker keeps
_SHORT = 48  # bytes of a word that is merged in rounds


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file, whose size does not depend on any data."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(n) for t, n in (x.split() for x in lines if x.strip())}


class Encoding:
    """The rank map of a vocabulary, and the words merged so far."""

    def __init__(self, ranks: dict[bytes, int]):
        self.pairs = Pairs(
            {
                (ranks[token[:cut]], ranks[token[cut:]]): rank
                for token, rank in ranks.items()
                for cut in range(1, len(token))
                if token[:cut] in ranks and token[cut:] in ranks
            }
        )
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pieces = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token
        self.pieces = pa.array(pieces, pa.large_binary())
        self._forget()

    def _forget(self) -> None:
        self.words: dict[bytes, int] = {}
        self.begins, self.ids = np.zeros(1, np.int64), np.empty(0, np.int32)

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and how many each has."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        long = size > _SHORT
        short = np.flatnonzero(~long)
        data = np.frombuffer(b"".join([words[k] for k in short.tolist()]), np.uint8)
        ids, word = self.pairs.rounds(self.single[data], np.repeat(short, size[short]))
        for k in np.flatnonzero(long).tolist():
            found = self.pairs.queue(self.single[np.frombuffer(words[k], np.uint8)].tolist())
            at = int(np.searchsorted(word, k))
            ids = np.concatenate((ids[:at], np.array(found, np.int32), ids[at:]))
            word = np.concatenate((word[:at], np.full(len(found), k), word[at:]))
        return ids, np.bincount(word, minlength=len(words))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Each word's number in the store of merged words, where those go that are new."""
        if len(self.words) > _KEPT_WORDS:
            self._forget()
        known = self.words
        fresh = [w for w in words if w not in known]
        ids, counts = self.merged(fresh)
        known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
        self.ids = np.concatenate((self.ids, ids))
        self.begins = np.concatenate((self.begins, self.begins[-1] + np.cumsum(counts)))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def encoded(self, words: pa.Array, texts: np.ndarray) -> pa.ListArray:
        """Ids of texts, given all their words and the number of words before each text and the last."""
        if not len(words):
            return pa.ListArray.from_arrays(pa.array(np.zeros(len(texts), np.int32)), pa.array([], pa.int32()))
        distinct = words.dictionary_encode()
        number = self.numbers(distinct.dictionary.to_pylist())[distinct.indices.to_numpy()]
        begin, count = self.begins[number], np.diff(self.begins)[number]
        upto = np.cumsum(count)
        ids = self.ids[np.repeat(begin - (upto - count), count) + np.arange(upto[-1])]
        bounds = np.concatenate(([0], upto))[texts]
        return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))

    def decoded(self, lists: pa.ListArray) -> list[bytes]:
        """The bytes of lists of ids; ids that are null or not in the vocabulary have none."""
        flat = lists.flatten()
        number = flat.fill_null(-1).to_numpy() if flat.null_count else flat.to_numpy()
        known = (number >= 0) & (number < len(self.pieces))
        found = self.pieces.take(pa.array(np.where(known, number, 0))) if len(self.pieces) else self.pieces
        content, places = byte_buffer(found)
        raw = content.tobytes()
        bounds = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        if known.all():
            at = places[bounds].tolist()
            return [raw[a:b] for a, b in zip(at[:-1], at[1:])]
        return [
            b"".join(raw[places[k] : places[k + 1]] for k in range(a, b) if known[k])
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
        ]


_encodings: dict[str, Encoding] = {}


def encoding_of(path: str) -> Encoding:
    """The worker's encoding for a file, made once."""
    if path not in _encodings:
        _encodings[path] = Encoding(read_ranks(path))
    return _encodings[path]


def words_of(text: Column, pattern: str) -> Column:
    """The pattern's matches, which together make up the whole text; null counts as empty."""
    spelled = pattern.replace(r"[^\s", f"[^{BLANK}").replace(r"\S", f"[^{BLANK}]").replace(r"\s", f"[{BLANK}]")
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(spelled), F.lit(0))


def encode(
    rows: DataFrame,
    path: str,
    pattern: str,
    text: str = "text",
    then: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """``rows`` with ``ids`` (array of int); a null text counts as empty, which has none.

    A column ``ids`` is replaced. Rows that repeat are encoded alike; an empty table gives
    an empty one. ``then`` is applied to each batch of the result inside the task, so that ids
    need not leave it; what it returns has ``schema``.
    """
    rows = rows.drop("ids")
    (words,) = unused(rows, "words")
    names = rows.columns
    full = rows.selectExpr("*", "cast(null as array<int>) ids").schema

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encoding = encoding_of(path)
        lists = batch.column(words)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        for first, last in runs(offsets, _RUN_WORDS, _RUN_ROWS):
            part = batch.slice(first, last - first)
            own = lists.values.slice(offsets[first], offsets[last] - offsets[first]).cast(pa.binary())
            ids = encoding.encoded(own, offsets[first : last + 1] - offsets[first])
            made = pa.RecordBatch.from_arrays([*[part.column(c) for c in names], ids], names=[*names, "ids"])
            yield then(made) if then else made

    return rows.withColumn(words, words_of(F.col(text), pattern)).mapInArrow(each_batch(run), schema if then else full)


def decode(rows: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``rows`` with the bytes of their ids, joined, in ``to`` (binary).

    A null list counts as empty; ids that are null or not in the vocabulary count as none.
    """
    rows = rows if to == ids else rows.drop(to)
    (given,) = unused(rows, "given")
    names = [c for c in rows.columns if c != to]
    source = rows.select(*names, F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")).alias(given))
    schema = rows.select(*names).selectExpr("*", f"cast(null as binary) `{to}`").schema

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        made = pa.array(encoding_of(path).decoded(batch.column(given)), pa.binary())
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], made], names=[*names, to])

    return source.mapInArrow(each_batch(run), schema)
