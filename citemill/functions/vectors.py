"""Vector helpers that work on one Arrow batch at a time inside a task."""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

# Size of a vector, and the characters of which tokens consist.
DIMENSION = 384
TOKEN_CHARACTERS = b"abcdefghijklmnopqrstuvwxyz0123456789"

_ROWS_SUMMED = 1024

_IN_TOKEN = np.zeros(256, dtype=bool)
_IN_TOKEN[list(TOKEN_CHARACTERS)] = True


def tokens(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """All tokens of a batch in order, and the row each one is from.

    Works on the bytes of the whole batch at once. Bytes of other than ASCII characters
    are never token characters, so a token cannot begin or end inside a character.
    """
    texts = pc.fill_null(texts, "").cast(pa.string())
    _, ends, characters = texts.buffers()
    offsets = np.frombuffer(ends, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(characters or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = _IN_TOKEN[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    row_starts = offsets[:-1][offsets[:-1] < len(data)]
    begins[row_starts] = inside[row_starts]
    per_row = np.diff(np.searchsorted(np.flatnonzero(begins), offsets))
    letters = data[inside]
    bounds = np.append(np.flatnonzero(begins[inside]), len(letters)).astype(np.int32)
    found = pa.StringArray.from_buffers(
        len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(letters)
    )
    return np.repeat(np.arange(len(texts)), per_row), found


def lowered(texts: pa.Array) -> pa.Array:
    """Texts in lower case as Python has it; those of ASCII alone, as most are, all at once."""
    plain = pc.string_is_ascii(texts)
    low, other = pc.ascii_lower(texts), pc.fill_null(pc.invert(plain), False)
    if not pc.any(other).as_py():
        return low
    fixed = pa.array([t.lower() for t in texts.filter(other).to_pylist()], texts.type)
    return pc.replace_with_mask(low, other, fixed)


@functools.lru_cache(1 << 17)
def _digest(token: str) -> bytes:
    return hashlib.md5(token.encode()).digest()


def _hash_cells(texts: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell of row * dim + dimension, sign) of every token of the lower-cased texts."""
    rows, found = tokens(texts)
    dims, signs = _hashed(found, dim)
    return rows * dim + dims, signs


def _hashed(found: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(dimension, sign) of each token."""
    coded = found.dictionary_encode()
    # The first four bytes of a token's digest choose the dimension, the top bit of the fifth
    # the sign. Common tokens are hashed once for all batches of a worker.
    digests = b"".join(map(_digest, coded.dictionary.to_pylist()))
    dims = np.frombuffer(digests, ">u4")[::4].astype(np.int64) % dim
    signs = np.where(np.frombuffer(digests, np.uint8)[4::16] < 128, 1.0, -1.0)
    codes = coded.indices.to_numpy()
    return dims[codes], signs[codes]


def hash_counts(texts: pa.Array, dim: int = DIMENSION) -> np.ndarray:
    """Signed token counts hashed to ``dim`` dimensions, one row for each text.

    Counts are whole numbers, so dot products and norms of them are exact.
    """
    rows, found = tokens(texts)
    dims, signs = _hashed(found, dim)
    counts = np.empty((len(texts), dim), np.float32)
    # Sums in double precision are made for some rows at a time, as those of a whole batch are many MB.
    for a in range(0, len(texts), _ROWS_SUMMED):
        part = counts[a : a + _ROWS_SUMMED]
        some = slice(*np.searchsorted(rows, (a, a + len(part))))
        cells = (rows[some] - a) * dim + dims[some]
        part[:] = np.bincount(cells, weights=signs[some], minlength=part.size).reshape(part.shape)
    return counts


def hash_windows(words: pa.Array, first: np.ndarray, last: np.ndarray, dim: int = DIMENSION) -> np.ndarray:
    """``hash_counts`` of texts that are runs of ``words`` between blanks, ``first`` up to ``last``.

    However many runs a word is in, its tokens are hashed once.
    """
    rows, found = tokens(words)
    dims, signs = _hashed(found, dim)
    a, b = np.searchsorted(rows, first), np.searchsorted(rows, last)
    count = b - a
    place = np.arange(count.sum()) + np.repeat(a - (np.cumsum(count) - count), count)
    cells = np.repeat(np.arange(len(first)) * dim, count) + dims[place]
    counts = np.bincount(cells, weights=signs[place], minlength=len(first) * dim)
    return counts.astype(np.float32).reshape(len(first), dim)


def hash_weights(texts: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same counts as (row, dimension, weight) triples; a weight may cancel to 0."""
    cells, signs = _hash_cells(texts, dim)
    used, where = np.unique(cells, return_inverse=True)
    weights = np.bincount(where, weights=signs, minlength=len(used)).astype(np.int64)
    return used // dim, used % dim, weights


def list_matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Matrix of a list column whose lists all have ``dim`` elements."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), dim)


def packed_matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Matrix of a column of packed vectors, each of ``dim`` elements and none null."""
    _, ends, data = vectors.buffers()
    wide = pa.types.is_large_binary(vectors.type)
    first = int(np.frombuffer(ends, np.int64 if wide else np.int32)[vectors.offset]) if len(vectors) else 0
    values = np.frombuffer(data or b"", np.uint8)[first : first + 4 * dim * len(vectors)]
    return values.view(np.float32).reshape(len(vectors), dim)


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Matrix of a column of lists or of packed vectors."""
    return list_matrix(vectors, dim) if pa.types.is_list(vectors.type) else packed_matrix(vectors, dim)


def _as_binary(values: np.ndarray, lengths: np.ndarray, valid: pa.Array) -> pa.Array:
    ends = np.append(0, np.cumsum(lengths, dtype=np.int64) * 4)
    if ends[-1] >= 1 << 31:
        raise ValueError("a batch of vectors is too large")
    buffers = [valid.buffers()[1], pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values, np.float32))]
    return pa.Array.from_buffers(pa.binary(), len(lengths), buffers)


def matrix_packed(matrix: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Packed vectors of a matrix, null where ``matrix_lists`` has null, and what is wrong with them."""
    rows, dim = matrix.shape
    with np.errstate(over="ignore"):
        values = np.ascontiguousarray(matrix, dtype=np.float32)
    finite = np.isfinite(values).all(axis=1)
    broken = pa.array(np.full(rows, "not_finite", object), pa.string(), mask=finite)
    return _as_binary(values.ravel(), np.full(rows, dim), pa.array(matrix.any(axis=1))), broken


def pack(vectors: Column) -> Column:
    """Lists of floats as bytes, four an element; a list with a null in it has no such form."""

    @F.arrow_udf("binary")
    def packed(lists: pa.Array) -> pa.Array:
        values = lists.flatten()
        if values.null_count:
            raise ValueError("vector with a null element")
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        return _as_binary(values.to_numpy(), lengths, lists.is_valid())

    return packed(vectors)


def unpack(vectors: Column) -> Column:
    """The lists of floats that ``pack`` was given."""

    @F.arrow_udf("array<float>")
    def unpacked(column: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy() // 4
        values = np.frombuffer(b"".join(v for v in column.to_pylist() if v is not None), np.float32)
        ends = pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32))
        return pa.ListArray.from_arrays(ends, pa.array(values), mask=pc.is_null(column))

    return unpacked(vectors)


def matrix_lists(matrix: np.ndarray) -> pa.Array:
    """List column of a matrix; null for rows without length, which have no direction."""
    rows, dim = matrix.shape
    values = np.ascontiguousarray(matrix, dtype=np.float32).ravel()
    empty = ~matrix.any(axis=1)
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * np.int32(dim))
    return pa.ListArray.from_arrays(offsets, pa.array(values), mask=pa.array(empty))
