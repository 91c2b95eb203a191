"""SentencePiece byte-pair models: encoding that keeps source offsets, and decoding.

A text is normalised by the longest prefix that the model's compiled character map holds,
character by character where it holds none, and each byte of the result remembers where in
the source it came from. Pieces are merged by score, the leftmost of equals, and each piece's
place in the normalised text is carried back to the bytes of the source.

A piece can only reach across two neighbouring bytes that follow each other in some piece, so
texts are cut wherever they don't, and each different cut is merged once. All of a batch is
cut, looked up and laid out as arrays. Nothing is shuffled.

Inside, a space stands for the mark that the model writes for it, in pieces and texts alike.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from citemill.llm.common import byte_buffer, each_batch, runs, unused
from citemill.llm.merging import Pairs

MARK, SPACE, UNKNOWN_CHARACTER = "▁".encode(), b" ", "�".encode()
# Kinds of pieces and of models in the model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
_RUN_BYTES, _RUN_ROWS = 4 << 20, 8192
_KEPT_WORDS = 400_000  # merged words that a worker keeps
_SHORT = 48  # symbols of a word that is merged in a plain list


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and contents of the fields of a message in the wire format of protocol buffers."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, message[at : at + size]
        at += size


class CharacterMap:
    """A compiled character map: a double-array trie over bytes, then what its keys become."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = memoryview(compiled[4 : 4 + size]).cast("I") if size else None
        self.strings = compiled[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """What the longest key at a place becomes, and the key's size; None if there is no key."""
        units, node, found = self.units, 0, None
        unit = units[0]
        for n in range(at, len(text)):
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            node ^= text[n]
            unit = units[node]
            if unit & 0x800000FF != text[n]:
                break
            if unit >> 8 & 1:
                found = units[node ^ (unit >> 10) << ((unit & 512) >> 6)] & 0x7FFFFFFF, n + 1 - at
        if found is None:
            return None
        return self.strings[found[0] : self.strings.index(b"\0", found[0])], found[1]


def _character(text: bytes, at: int) -> int:
    """Size of the character at a place; 0 if the bytes there are none."""
    lead = text[at]
    size = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
    try:
        text[at : at + size].decode()
    except UnicodeDecodeError:
        return 0
    return size if at + size <= len(text) else 0


class Model:
    """A byte-pair model with byte fallback, read from its file."""

    def __init__(self, content: bytes):
        fields = list(_fields(content))
        pieces = [dict(_fields(x)) for n, x in fields if n == 1]
        trainer = dict(_fields(next((x for n, x in fields if n == 2), b"")))
        normalizer = dict(_fields(next((x for n, x in fields if n == 3), b"")))
        denormalizer = dict(_fields(next((x for n, x in fields if n == 5), b"")))
        kinds = [p.get(3, NORMAL) for p in pieces]
        texts = [p.get(1, b"") for p in pieces]
        if trainer.get(3, 1) != BPE or not trainer.get(35, 0) or kinds.count(BYTE) != 256:
            raise ValueError("not a byte-pair model with byte fallback")
        if not {*kinds} <= {NORMAL, UNKNOWN, CONTROL, BYTE} or trainer.get(24, 0) or denormalizer.get(2):
            raise ValueError("user-defined pieces, unused pieces, suffixed spaces and denormalisation are not supported")
        if not normalizer.get(5, 1) or any(SPACE in t for t in texts):
            raise ValueError("spaces must be escaped")
        self.prefix, self.squeezed = normalizer.get(3, 1), normalizer.get(4, 1)
        self.characters = CharacterMap(normalizer.get(2, b""))
        self.plain = self.characters.units is None and not self.squeezed

        self.inner = inner = [t.replace(MARK, SPACE) for t in texts]
        self.ids = {t: n for n, (t, kind) in enumerate(zip(inner, kinds)) if kind == NORMAL}
        # Higher scores merge first; pieces of one score share a rank.
        scores = [struct.unpack("<f", p.get(2, bytes(4)))[0] for p in pieces]
        order = {s: n for n, s in enumerate(sorted({*scores}, reverse=True))}
        self.rank = {t: order[scores[n]] for t, n in self.ids.items()}
        self.byte_ids = [-1] * 256
        for n, kind in enumerate(kinds):
            if kind == BYTE:
                self.byte_ids[int(texts[n][1:-1], 16)] = n
        self.is_byte = np.array([kind == BYTE for kind in kinds])
        self.sizes = np.array([1 if kind == BYTE else len(t) for t, kind in zip(inner, kinds)], np.int32)
        surface = trainer.get(44, " ⁇ ".encode())
        self.shown = [
            bytes([int(t[1:-1], 16)]) if kind == BYTE else b"" if kind == CONTROL else surface if kind == UNKNOWN else i
            for t, i, kind in zip(texts, inner, kinds)
        ]
        self.shown_array = pa.array(self.shown, pa.large_binary())
        self.starts_spaced = np.array([k == NORMAL and i[:1] == SPACE for k, i in zip(kinds, inner)])
        self.normal = np.array([k == NORMAL for k in kinds])

        joined = np.zeros((256, 256), bool)
        joined[:, 0x80:0xC0] = True  # inside a character
        for t in self.ids:
            b = np.frombuffer(t, np.uint8)
            joined[b[:-1], b[1:]] = True
        self.cut = ~joined.ravel()
        self._tables()
        self._forget()

    def _tables(self) -> None:
        """Symbols of all characters, and for every two symbols that make a piece its rank and id."""
        symbols = dict(self.ids)
        for c in {c for t in self.ids for c in t.decode()}:
            symbols.setdefault(c.encode(), len(symbols) + len(self.shown))
        self.symbol = np.full(0x110000, -1, np.int32)
        for t, n in symbols.items():
            if len(text := t.decode()) == 1:
                self.symbol[ord(text)] = n
        made = {}
        for t, n in self.ids.items():
            for k in range(1, len(t)):
                left, right = symbols.get(t[:k]), symbols.get(t[k:])
                if left is not None and right is not None:
                    made[left, right] = n
        self.pairs = Pairs(made, {n: self.rank[t] for t, n in self.ids.items()})

    def _forget(self) -> None:
        """Empty the store of merged words: each word's number, where its ids begin, and the ids."""
        self.words: dict[bytes, int] = {}
        self.word_begins, self.word_ids = np.zeros(1, np.int64), np.empty(0, np.int32)

    # --- normalisation

    def normalised(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """A text as it is merged, and for each of its bytes, and the end, the place in the source."""
        out, places, at = bytearray(), [], 0

        def prefix(at: int) -> tuple[bytes, int]:
            found = self.characters.longest(text, at) if self.characters.units is not None else None
            if found is None:
                size = _character(text, at)
                found = (text[at : at + size], size) if size else (UNKNOWN_CHARACTER, 1)
            return found

        if self.squeezed:
            while at < len(text) and prefix(at)[0] == SPACE:
                at += prefix(at)[1]
        if at == len(text):
            return b"", np.zeros(1, np.int64)
        if self.prefix:
            out += SPACE
            places.append(at)
        spaced = bool(self.squeezed)
        while at < len(text):
            became, size = prefix(at)
            became = became.lstrip(SPACE) if spaced else became
            if became:
                inner = became.replace(MARK, SPACE)
                out += inner
                places += [at] * len(inner)
                spaced = bool(self.squeezed) and became.endswith(SPACE)
            at += size
        if self.squeezed:
            while out.endswith(SPACE):
                at = places.pop()
                del out[-1]
        return bytes(out), np.array([*places, at], np.int64)

    # --- merging

    def merged(self, word: bytes) -> tuple[int, ...]:
        """Ids of a word by itself."""
        text = word.decode()
        symbols = self.symbol[np.frombuffer(text.encode("utf-32-le"), "<u4")].tolist()
        found: list[int] = []
        at = 0
        for n in self.pairs.queue(symbols):
            if 0 <= n < len(self.shown):
                found.append(n)
                at += len(self.inner[n])
            else:  # a character that is no piece, spelled in bytes
                size = _character(word, at)
                found += map(self.byte_ids.__getitem__, word[at : at + size])
                at += size
        return tuple(found)

    # --- a run of texts

    def laid_out(self, data: np.ndarray, offsets: np.ndarray):
        """Normalised bytes of all texts, where each text begins, and their places in the source.

        The places are None where those of a text are its own, one byte further on.
        """
        content = data.tobytes()
        if self.plain and self.prefix and MARK not in content and _valid(content):
            full = offsets[:-1][np.diff(offsets) > 0]
            return np.insert(data, full, SPACE[0]), offsets + np.searchsorted(full, offsets), None
        texts = [self.normalised(content[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        joined = np.frombuffer(b"".join(t for t, _ in texts), np.uint8)
        starts = np.cumsum([0, *[len(t) for t, _ in texts]])
        return joined, starts, [places for _, places in texts]

    def pieces(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all normalised texts, and how many ids each has."""
        texts = len(starts) - 1
        if not len(data):
            return np.empty(0, np.int32), np.zeros(texts, np.int64)
        cut = np.empty(len(data), bool)
        cut[1:] = self.cut[(data[:-1].astype(np.uint16) << 8) | data[1:]]
        cut[starts[:-1][starts[:-1] < len(data)]] = True
        cut[0] = True
        first = np.flatnonzero(cut)
        bounds = np.append(first, len(data)).astype(np.int64)
        cuts = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        number = self._numbers(cuts.dictionary.to_pylist())
        sizes, begins, flat = np.diff(self.word_begins)[number], self.word_begins[number], self.word_ids
        index = cuts.indices.to_numpy()
        count = sizes[index]
        upto = np.cumsum(count)
        shift = begins[index] - (upto - count)
        ids = flat[np.repeat(shift, count) + np.arange(upto[-1])]
        # Cuts before each text's begin, and so ids.
        before = np.searchsorted(first, starts)
        return ids, np.diff(np.concatenate(([0], upto))[before])

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word in the store, where those go that are new."""
        if len(self.words) > _KEPT_WORDS:
            self._forget()
        known = self.words
        fresh = [w for w in words if w not in known]
        first = len(self.word_begins) - 1
        ids, counts = self.merged_together(fresh)
        known.update(zip(fresh, range(first, first + len(fresh))))
        self.word_ids = np.concatenate((self.word_ids, ids))
        self.word_begins = np.concatenate((self.word_begins, self.word_begins[-1] + np.cumsum(counts)))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def merged_together(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words and how many each has; in each round every word merges one pair."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        lead = (np.frombuffer(b"".join(words), np.uint8) & 0xC0) != 0x80
        upto = np.concatenate(([0], np.cumsum(lead)))[np.cumsum(size)]
        lengths = np.diff(upto, prepend=0)
        alone = lengths > _SHORT
        some = [w for w, a in zip(words, alone) if not a]
        place = np.flatnonzero(~alone)
        left = np.repeat(place, lengths[place])  # the word of each symbol
        code = np.frombuffer(b"".join(some).decode().encode("utf-32-le"), "<u4")
        symbols, left = self.pairs.rounds(self.symbol[code], left)
        # Words with characters that are no pieces are spelled in bytes one by one.
        odd = np.zeros(len(words), bool)
        odd[left[(symbols < 0) | (symbols >= len(self.shown))]] = True
        odd |= alone
        plain = ~odd[left]
        symbols, left = symbols[plain], left[plain]
        slow = {k: self.merged(words[k]) for k in np.flatnonzero(odd).tolist()}
        if slow:
            symbols = np.concatenate((symbols, np.fromiter(chain.from_iterable(slow.values()), np.int32)))
            left = np.concatenate((left, np.repeat(list(slow), [len(x) for x in slow.values()])))
        order = np.argsort(left, kind="stable")
        return symbols[order].astype(np.int32), np.bincount(left, minlength=len(words))

    def spans(self, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, starts: np.ndarray, places) -> tuple[np.ndarray, np.ndarray]:
        """Where each piece begins and ends in the bytes of its own source text."""
        end = np.cumsum(self.sizes[ids], dtype=np.int64)
        begin = end - self.sizes[ids]
        at = np.flatnonzero(self.is_byte[ids])
        if len(at):
            # Of a character spelled in bytes the last byte has all of it, the others nothing.
            place = begin[at]
            inside = (data[place] & 0xC0) == 0x80
            begin[at] = np.maximum.accumulate(np.where(inside, -1, place))
            more = place + 1
            last = (more >= len(data)) | ((data[np.minimum(more, len(data) - 1)] & 0xC0) != 0x80)
            end[at] = np.where(last, more, begin[at])
        text = np.repeat(np.arange(len(counts)), counts)
        begin -= starts[text]
        end -= starts[text]
        if places is None:
            return np.maximum(begin - 1, 0), np.maximum(end - 1, 0)
        shift = np.cumsum([0, *map(len, places)])[:-1]
        flat = np.concatenate(places) if places else np.empty(0, np.int64)
        return flat[begin + shift[text]], flat[end + shift[text]]

    # --- decoding

    def decoded(self, ids: list[int]) -> str:
        """The text of one list of ids; ids beyond the vocabulary count as unknown."""
        out, held, seen = [], b"", False
        for n in ids:
            known = 0 <= n < len(self.shown)
            if known and self.is_byte[n]:
                held += self.shown[n]
                continue
            out.append(_characters(held))
            held = b""
            piece = self.shown[n] if known else self.shown[int(np.flatnonzero(~self.normal & ~self.is_byte)[0])]
            if known and self.starts_spaced[n] and (self.prefix or self.squeezed) and not seen and not any(out):
                piece = piece[1:]
                seen = not self.squeezed
            out.append(piece.decode())
        return "".join([*out, _characters(held)])


def _valid(content: bytes) -> bool:
    try:
        content.decode()
    except UnicodeDecodeError:
        return False
    return True


def _characters(content: bytes) -> str:
    """Bytes as text; each byte that is part of no character becomes a mark for that."""
    if _valid(content):
        return content.decode()
    out, at = [], 0
    while at < len(content):
        size = _character(content, at)
        out.append(content[at : at + size].decode() if size else "�")
        at += size or 1
    return "".join(out)


_models: dict[str, Model] = {}


def model_of(path: str) -> Model:
    """The worker's model for a file, read once."""
    if path not in _models:
        with open(path, "rb") as file:
            _models[path] = Model(file.read())
    return _models[path]


def encode(
    rows: DataFrame,
    path: str,
    text: str = "text",
    then: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """``rows`` with ``ids, begins, ends`` (arrays of int): each piece and its bytes in the source.

    A null text counts as empty and has no pieces. Pieces follow each other and together hold
    the whole text; a mark put before the text has no bytes of its own, and of a character
    that is spelled in bytes the last piece has all bytes. Bytes that are no UTF-8 are read as
    the model's library does. Columns named like the new ones are replaced; rows that repeat
    are encoded alike, and an empty table gives an empty one. A word of any length takes time
    in proportion to its length, but for a logarithm.

    ``then`` is applied to each batch of the result inside the task, so that lists need not
    leave it; what it returns has ``schema``.
    """
    rows = rows.drop("ids", "begins", "ends")
    (body,) = unused(rows, "body")
    given = rows.withColumn(body, F.coalesce(F.col(text), F.lit("")).cast("binary"))
    names = rows.columns
    new = "cast(null as array<int>)"
    full = rows.selectExpr("*", f"{new} ids", f"{new} begins", f"{new} ends").schema

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        data, offsets = byte_buffer(batch.column(body))
        for first, last in runs(offsets, _RUN_BYTES, _RUN_ROWS):
            part = batch.slice(first, last - first)
            source = data[offsets[first] : offsets[last]]
            normal, starts, places = model.laid_out(source, offsets[first : last + 1] - offsets[first])
            ids, counts = model.pieces(normal, starts)
            begin, end = model.spans(ids, counts, normal, starts, places)
            bounds = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in (ids, begin, end)]
            columns = [part.column(c) for c in names]
            made = pa.RecordBatch.from_arrays([*columns, *lists], names=[*names, "ids", "begins", "ends"])
            yield then(made) if then else made

    return given.mapInArrow(each_batch(run), schema if then else full)


def decode(rows: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids in ``to``; a null list counts as empty.

    Control pieces are not shown, unknown ones as the model says; bytes that make no character
    become U+FFFD each. The space that the model put before the text goes. A column ``to`` is
    replaced; a null or unknown id within a list counts as an unknown piece.
    """
    rows = rows if to == ids else rows.drop(to)
    (given,) = unused(rows, "given")
    listed = F.coalesce(F.transform(ids, lambda x: F.coalesce(x, F.lit(-1))), F.array().cast("array<int>"))
    names = [c for c in rows.columns if c != to]
    source = rows.select(*names, listed.cast("array<int>").alias(given))
    schema = source.drop(given).withColumn(to, F.lit("").cast("string")).schema
    schema[to].nullable = True

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        made = pa.array(texts_of(model_of(path), batch.column(given)), pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], made], names=[*names, to])

    return source.mapInArrow(each_batch(run), schema)


def texts_of(model: Model, lists: pa.ListArray) -> list[bytes]:
    """Texts of lists of ids, of which none is null."""
    bounds = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    odd = (flat < 0) | (flat >= len(model.shown))
    shown = model.shown_array.take(pa.array(np.where(odd, 0, flat)))
    content, places = byte_buffer(shown)
    starts = places[bounds]
    full = np.diff(bounds) > 0
    head, head_odd = flat[bounds[:-1][full]], odd[bounds[:-1][full]]
    head = np.where(head_odd, 0, head)
    lead = np.zeros(len(bounds) - 1, np.int64)
    lead[full] = model.starts_spaced[head] & ~head_odd & bool(model.prefix)
    # What is not plainly a list of pieces that begins with one goes the long way.
    slow = np.zeros(len(lead), bool)
    slow[full] = head_odd | ~model.normal[head] | bool(model.squeezed)
    slow[np.searchsorted(bounds, np.flatnonzero(odd), "right") - 1] = True
    raw = content.tobytes()
    if not _valid(raw):
        slow |= [not _valid(raw[a:b]) for a, b in zip(starts[:-1], starts[1:])]
    return [
        model.decoded(flat[bounds[k] : bounds[k + 1]].tolist()).encode() if slow[k] else raw[a:b]
        for k, (a, b) in enumerate(zip((starts[:-1] + lead).tolist(), starts[1:].tolist()))
    ]
