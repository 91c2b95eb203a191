"""Fill-in-the-middle: documents cut at lines or characters and put in another order.

Cuts are chosen over characters and made in bytes. What lies between the two is a sparse index
of exceptions: the places of characters of several bytes, and how many bytes too many all of
them have so far. A cut is converted by one search in that index; where a text is plain
ASCII nothing is recorded and the two numbers are the same. A batch has one index for all its
texts. Nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from citemill.llm.common import byte_buffer, each_batch, runs, unused

# Marks before the three parts, and names of the forms.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
_RUN_BYTES, _RUN_ROWS = 16 << 20, 8192


class Exceptions:
    """Characters of several bytes in a buffer of UTF-8: where they begin, and excess bytes so far."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        more = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate(([0], np.cumsum(more)))
        # The same places counted in characters.
        self.characters = self.at - self.excess[:-1]

    def to_bytes(self, characters: np.ndarray) -> np.ndarray:
        return characters + self.excess[np.searchsorted(self.characters, characters)]

    def to_characters(self, places: np.ndarray) -> np.ndarray:
        """For places at which a character begins, or the end."""
        return places - self.excess[np.searchsorted(self.at, places)]


@dataclass
class Cutting:
    """How documents are cut: at lines or characters, how often, and in which order.

    ``rate`` and ``spm_rate`` are percentages, of documents that are cut and of those among them
    whose suffix comes first. ``seed`` and the document's id decide everything.
    """

    unit: str = "line"
    rate: int = 100
    spm_rate: int = 50
    seed: int = 7

    def __post_init__(self) -> None:
        if self.unit not in ("line", "character"):
            raise ValueError(self.unit)


def draws(ids: list, seed: int) -> np.ndarray:
    """Four numbers below 2**32 a row, from the seed and the id; a null id counts as none."""
    digests = b"".join(hashlib.sha256(f"{seed}:{'' if x is None else x}".encode()).digest()[:16] for x in ids)
    return np.frombuffer(digests, ">u4").reshape(-1, 4).astype(np.int64)


def _units(data: np.ndarray, offsets: np.ndarray, known: Exceptions, unit: str):
    """How many units each text has, and a function from a text's unit to where that ends in bytes.

    Unit 0 ends where the text begins.
    """
    if unit == "character":
        first = known.to_characters(offsets)
        return np.diff(first), lambda n: known.to_bytes(first[:-1] + n)
    feeds = np.flatnonzero(data == 10)
    upto = np.searchsorted(feeds, offsets)
    full = np.diff(offsets) > 0
    open_ = np.zeros(len(full), bool)
    open_[full] = data[offsets[1:][full] - 1] != 10
    number = np.diff(upto) + open_

    def end(n: np.ndarray) -> np.ndarray:
        closed = n <= np.diff(upto)
        place = upto[:-1] + n - 1
        ends = feeds[np.clip(place, 0, max(len(feeds) - 1, 0))] + 1 if len(feeds) else np.zeros(len(n), np.int64)
        return np.where(n == 0, offsets[:-1], np.where(closed, ends, offsets[1:]))

    return number, end


def transform(rows: DataFrame, cutting: Cutting = Cutting(), row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``rows`` with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` (long) and ``output``.

    Prefix, middle and suffix are parted by two cuts among the units' ends, the text's begin
    included; a part may be empty. A text that is empty, holds one of the marks or is not drawn
    stays as it is (``plain``), and its two counts are null. A null text counts as empty and a
    null id as an empty one; rows that repeat come out alike. Columns named like the new ones
    are replaced; an empty table gives an empty one. Texts are taken whole, of any length.
    """
    new = ["n", "form", "prefix_chars", "middle_chars", "output"]
    (body,) = unused(rows, "body")
    (number,) = unused(rows, "number")
    given = rows.withColumn(body, F.coalesce(F.col(text), F.lit(""))).withColumn(number, F.col(row_id).cast("string"))
    names = [c for c in rows.columns if c not in new]
    kinds = ["bigint", "string", "bigint", "bigint", "string"]
    schema = given.selectExpr(*[f"`{c}`" for c in names], *[f"cast(null as {k}) {c}" for c, k in zip(new, kinds)]).schema
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = byte_buffer(batch.column(body))
        for first, last in runs(offsets, _RUN_BYTES, _RUN_ROWS):
            part = batch.slice(first, last - first)
            own, at = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            drawn = draws(part.column(number).to_pylist(), cutting.seed)
            known = Exceptions(own)
            n, end = _units(own, at, known, cutting.unit)
            cuts = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
            content = own.tobytes()
            one, two = end(cuts[:, 0]), end(cuts[:, 1])
            here = known.to_characters(at[:-1])
            ahead, upto = known.to_characters(one) - here, known.to_characters(two) - here
            plain = (n == 0) | (drawn[:, 2] % 100 >= cutting.rate) | _holding(own, at, marks)
            spm = drawn[:, 3] % 100 < cutting.spm_rate
            outputs = []
            p, s, m = marks
            for a, x, y, b, stays, swapped in zip(at[:-1].tolist(), one.tolist(), two.tolist(), at[1:].tolist(), plain.tolist(), spm.tolist()):
                if stays:
                    outputs.append(content[a:b])
                elif swapped:
                    outputs.append(b"".join((s, content[y:b], p, content[a:x], m, content[x:y])))
                else:
                    outputs.append(b"".join((p, content[a:x], s, content[y:b], m, content[x:y])))
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(c) for c in names],
                    pa.array(n.astype(np.int64)),
                    pa.array(np.where(plain, PLAIN, np.where(spm, SPM, PSM)).tolist(), pa.string()),
                    pa.array(ahead, pa.int64(), mask=plain),
                    pa.array(upto - ahead, pa.int64(), mask=plain),
                    _strings(outputs),
                ],
                names=[*names, *new],
            )

    return given.mapInArrow(each_batch(run), schema)


def _strings(parts: list[bytes]) -> pa.Array:
    """The bytes as an Arrow string column, unchanged even if they are no UTF-8."""
    bounds = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(parts), pa.py_buffer(bounds), pa.py_buffer(b"".join(parts)))


def _holding(data: np.ndarray, offsets: np.ndarray, marks: list[bytes]) -> np.ndarray:
    """Whether each text holds one of the marks, all of which are three bytes that begin and end alike."""
    start = np.flatnonzero(data[: max(len(data) - 2, 0)] == marks[0][0])
    start = start[data[start + 2] == marks[0][2]]
    start = start[np.isin(data[start + 1], [m[1] for m in marks])]
    text = np.searchsorted(offsets, start, "right") - 1
    text = text[start + 3 <= offsets[text + 1]]
    found = np.zeros(len(offsets) - 1, bool)
    found[text] = True
    return found


def restored(output: Column, form: Column) -> Column:
    """The text before it was cut, from an output and its form alone. Built-in expressions."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        # Marks stand once each, so the first of each is it.
        two = F.instr(output, second)
        three = F.instr(output, MIDDLE)
        size = len(first)
        return (
            F.substr(output, F.lit(size + 1), two - size - 1),
            F.substr(output, two + size, three - two - size),
            F.substr(output, three + size),
        )

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    back, front, between = parts(SUFFIX, PREFIX)
    return (
        F.when(form == PSM, F.concat(prefix, middle, suffix))
        .when(form == SPM, F.concat(front, between, back))
        .otherwise(output)
    )
