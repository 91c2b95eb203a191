"""Languages by nearest centroid.

A text becomes a vector of its byte pairs and triples (letters in lower case, all else a
blank), hashed into ``DIMS`` places, damped, weighted by inverse document frequency and
normalised. Each language has up to ``CENTROIDS`` clustered centroids; the nearest by cosine
gives the language, and a text farther from it than the language's own sample bears out is
rejected, unless it is too short for that to mean anything.

The model is fitted on a bounded sample: about ``SAMPLE`` texts a language, chosen by a hash
of their ids. Predictions read whole texts, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from citemill.llm.common import byte_buffer, each_batch, runs, stored, unused

SAMPLE = 1500  # texts a language, in expectation
DIMS = 8192
CENTROIDS = 4
ROUNDS = 8
# A text is rejected below this part of the cosine that all but a thousandth of the sample reach.
SLACK = 0.5
# Shorter texts share little with any centroid, whatever their language; distance says nothing.
EVIDENCE = 64  # bytes

_RUN_BYTES, _RUN_ROWS = 1 << 20, 256
_FOLD = np.full(256, 32, np.uint32)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[128:] = np.arange(128, 256)


@dataclass
class Model:
    """Languages, the owner of each centroid, centroids by row, weights, lowest cosines."""

    languages: list[str]
    owner: np.ndarray
    centroids: np.ndarray
    weights: np.ndarray
    lowest: np.ndarray


def _places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs and triples that begin at each byte; ``DIMS`` for those left out."""
    code = _FOLD[data]
    pair = (code[:-1] << np.uint32(8)) | code[1:]
    triple = (pair[:-1] << np.uint32(8)) | code[2:]

    def hashed(grams: np.ndarray, seed: int) -> np.ndarray:
        return (grams * np.uint32(2654435761) + np.uint32(seed)) * np.uint32(0x9E3779B1) >> np.uint32(19)

    blank = pair == 0x2020
    pairs, triples = hashed(pair, 17), hashed(triple, 91)
    pairs[blank] = DIMS
    triples[blank[:-1] | blank[1:]] = DIMS
    return pairs, triples


def counts(data: np.ndarray, offsets: np.ndarray, first: int, last: int) -> np.ndarray:
    """Counts of the texts ``first`` to ``last``, a row each. Long texts are done in pieces."""
    found = np.zeros((last - first, DIMS), np.float32)
    low, high = int(offsets[first]), int(offsets[last])
    if last - first == 1:
        for at in range(low, high, _RUN_BYTES):
            piece = data[at : min(at + _RUN_BYTES + 2, high)]
            if len(piece) > 2:
                pairs, triples = _places(piece)
                for grams in (pairs[:_RUN_BYTES], triples[:_RUN_BYTES]):
                    found[0] += np.bincount(grams, minlength=DIMS + 1)[:DIMS]
        return found
    if high - low > 2:
        pairs, triples = _places(data[low:high])
        for row in range(first, last):
            a, b = int(offsets[row]) - low, int(offsets[row + 1]) - low
            if b - a > 2:
                both = np.concatenate((pairs[a : b - 1], triples[a : b - 2]))
                found[row - first] = np.bincount(both, minlength=DIMS + 1)[:DIMS]
    return found


def _padded(text: Column) -> Column:
    """Lower case between blanks, null where there is no letter to go by."""
    return F.when(
        text.rlike(r"\p{L}"), F.concat(F.lit(" "), F.lower(text), F.lit(" ")).cast("binary")
    )


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.maximum(length, 1e-12)


def _weighted(dense: np.ndarray, weights: np.ndarray) -> None:
    """Turn counts into damped, weighted unit rows in place: a language's sample is held once."""
    for a in range(0, len(dense), _RUN_ROWS):
        rows = dense[a : a + _RUN_ROWS]
        rows[:] = _unit(np.log1p(rows) * weights)


def _total(rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Sum of the wanted rows, added in their order, without a copy of all of them."""
    total = None
    for a in range(0, len(wanted), _RUN_ROWS):
        part = rows[wanted[a : a + _RUN_ROWS]]
        total = (part if total is None else np.concatenate((total[None], part))).sum(axis=0)
    return total


def cluster(rows: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Unit centroids of unit rows: farthest first, then spherical k-means; none is empty."""
    chosen = _unit(rows.mean(axis=0, keepdims=True))
    seeds = [int(np.argmax(rows @ chosen[0]))]
    for _ in range(1, min(k, len(rows))):
        nearest = (rows @ rows[seeds].T).max(axis=1)
        seeds.append(int(np.argmin(nearest)))
    centroids = rows[list(dict.fromkeys(seeds))]
    for _ in range(rounds):
        nearest = np.argmax(rows @ centroids.T, axis=1)
        sums = [_total(rows, np.flatnonzero(nearest == c)) for c in range(len(centroids)) if (nearest == c).any()]
        centroids = _unit(np.array(sums, np.float32))
    return centroids


def fit(rows: DataFrame, row_id: str, text: str, lang: str, sample: int = SAMPLE,
        centroids: int = CENTROIDS) -> Model:
    """A model from the rows that have a language and a text with a letter.

    Two jobs read the table, first for counts, then for the sampled texts. The driver gets
    document frequencies (one row a task) and the centroids.
    """
    spark = rows.sparkSession
    usable = rows.select(
        F.col(row_id).alias("row_id"), F.col(lang).alias("lang"), _padded(F.col(text)).alias("body")
    ).filter("lang is not null and body is not null")
    shares = {
        r["lang"]: min(1.0, sample / r["count"])
        for r in rows.filter(F.col(lang).isNotNull()).groupBy(F.col(lang).alias("lang")).count().collect()
    }
    if not shares:
        return Model([], np.zeros(0, int), np.zeros((0, DIMS), np.float32), np.ones(DIMS, np.float32), np.zeros(0))
    draw = F.pmod(F.xxhash64(F.col("row_id").cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    wanted = F.coalesce(*[F.when(F.col("lang") == name, F.lit(share)) for name, share in shares.items()])

    def sparse(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = byte_buffer(batch.column("body"))
        for first, last in runs(offsets, _RUN_BYTES, _RUN_ROWS):
            dense = counts(data, offsets, first, last)
            where, place = np.nonzero(dense)
            at = np.searchsorted(where, np.arange(last - first + 1)).astype(np.int32)
            part = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("row_id"),
                    part.column("lang"),
                    pa.ListArray.from_arrays(at, pa.array(place.astype(np.int32))),
                    pa.ListArray.from_arrays(at, pa.array(dense[where, place])),
                ],
                names=["row_id", "lang", "place", "times"],
            )

    kind = usable.schema["row_id"].dataType.simpleString()
    drawn = stored(
        usable.filter(draw < wanted).mapInArrow(
            each_batch(sparse), f"row_id {kind}, lang string, place array<int>, times array<float>"
        ),
        "language-sample",
    )
    seen = drawn.select(F.explode("place").alias("place")).groupBy("place").count().collect()
    frequency = np.zeros(DIMS)
    for row in seen:
        frequency[row["place"]] = row["count"]
    weights = (np.log((1 + drawn.count()) / (1 + frequency)) + 1).astype(np.float32)

    def clustered(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row_id")
        dense = np.zeros((len(group), DIMS), np.float32)
        for k, (place, times) in enumerate(zip(group["place"], group["times"])):
            dense[k, place] = times
        _weighted(dense, weights)
        middle = cluster(dense, centroids, ROUNDS)
        nearest = (dense @ middle.T).max(axis=1)
        lowest = float(np.quantile(nearest, 0.001)) * SLACK
        return pd.DataFrame(
            {"lang": group["lang"].iloc[0], "centroid": list(middle.astype(np.float32)), "lowest": lowest}
        )

    found = (
        drawn.groupBy("lang")
        .applyInPandas(clustered, "lang string, centroid array<float>, lowest double")
        .toPandas()
    )
    languages = sorted(found["lang"].unique())
    lowest = found.groupby("lang")["lowest"].first()
    found = found.sort_values("lang", kind="stable")
    return Model(
        languages,
        np.array([languages.index(x) for x in found["lang"]]),
        np.stack([np.asarray(c, np.float32) for c in found["centroid"]]),
        weights,
        np.array([lowest[x] for x in languages]),
    )


def predict(rows: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``rows`` with ``lang_pred`` (string), ``score`` (cosine, 0 to 1) and ``rejected``.

    New columns replace given ones of their names. A text that is null or has no letter is
    ``und`` with score 0 and rejected, as is every text if the model has no language. Ties
    go to the language that sorts first. An empty table gives an empty one.
    """
    rows = rows.drop("lang_pred", "score", "rejected")
    (body,) = unused(rows, "body")
    given = rows.withColumn(body, _padded(F.col(text)))
    schema = rows.selectExpr(
        "*", "'' lang_pred", "0.0D score", "true rejected"
    ).limit(0).schema
    for field in schema:
        field.nullable = True
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model = shared.value
        column = batch.column(body)
        data, offsets = byte_buffer(column)
        best = np.zeros(batch.num_rows, np.float64)
        lang = np.full(batch.num_rows, -1)
        for first, last in runs(offsets, _RUN_BYTES, _RUN_ROWS) if model.languages else ():
            vectors = _unit(np.log1p(counts(data, offsets, first, last)) * model.weights)
            cosine = vectors @ model.centroids.T
            nearest = np.argmax(cosine, axis=1)
            best[first:last] = cosine[np.arange(len(cosine)), nearest]
            lang[first:last] = model.owner[nearest]
        lang[~column.is_valid().to_numpy(zero_copy_only=False)] = -1
        best = np.where(lang < 0, 0.0, np.clip(best, 0.0, 1.0))
        names = np.array([*model.languages, "und"], object)[lang]
        lowest = np.append(model.lowest, np.inf)[lang]
        far = (best < lowest) & ((np.diff(offsets) >= EVIDENCE) | (lang < 0))
        kept = [batch.column(n) for n in batch.schema.names if n != body]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(names, pa.string()), pa.array(best), pa.array(far)],
            names=[*(n for n in batch.schema.names if n != body), "lang_pred", "score", "rejected"],
        )

    return given.mapInArrow(each_batch(run), schema)


def held_out(row_id: Column) -> Column:
    """Rows that are never learned from: a fifth by checksum of the id, and those without id."""
    return F.coalesce(F.crc32(row_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))
