import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citemill.functions import vectors as vec
from citemill.operators import embed


def counts(text, dim):
    out = np.zeros(dim)
    for token in re.split("[^a-z0-9]+", text.lower()):
        if token:
            digest = hashlib.md5(token.encode()).hexdigest()
            out[int(digest[:8], 16) % dim] += 1 if digest[8] < "8" else -1
    return out


TEXTS = ["Hello hello, world 42!", "", "é ü", None, "a-b a", "x" * 5000, "Größe des Waldes"]


def test_hash_counts_equal_brute_force():
    texts = pa.array([None if t is None else t.lower() for t in TEXTS])
    for part in (texts, texts.slice(2, 3)):
        for row, text in zip(vec.hash_counts(part, 16), part.to_pylist()):
            assert (row == counts(text or "", 16)).all()


def test_tokens_do_not_cross_rows():
    rows, found = vec.tokens(pa.array(["ab", "cd", "", "ef gh"]))
    assert rows.tolist() == [0, 1, 3, 3] and found.to_pylist() == ["ab", "cd", "ef", "gh"]


def test_embedded_texts(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, chunk_text string")
    for row in embed.embed_chunks(df).collect():
        want = counts(TEXTS[row.i] or "", 384)
        assert row.embedding == (list(want) if want.any() else None)


def test_long_form_equals_vectors(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    cells = embed.hash_weights(docs, text="text").filter("weight <> 0")
    dense = embed.embed_chunks(docs, text="text").select("doc_id", F.posexplode("embedding"))
    dense = dense.filter("col <> 0").select("doc_id", "pos", F.col("col").cast("bigint"))
    assert cells.exceptAll(dense).isEmpty() and dense.exceptAll(cells).isEmpty()


def test_other_encoder_is_loaded_once_per_task_and_called_on_batches(spark):
    loads, calls = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)

        def encode(texts):
            calls.add(1)
            return np.array([[len(t), 1.0] for t in texts.to_pylist()])

        return encode

    df = spark.range(0, 5000, 1, 2).select(F.format_string("%05d", "id").alias("chunk_text"))
    found = embed.embed_chunks(df, load, 2)
    assert {tuple(r.embedding) for r in found.select("embedding").distinct().collect()} == {(5, 1)}
    assert loads.value == 2 and calls.value <= 4


def test_wrong_dimension_stops_the_job(spark):
    df = spark.createDataFrame([("a",)], "chunk_text string")
    made = embed.embed_chunks(df, lambda: (lambda texts: np.ones((len(texts), 3))), 2)
    with pytest.raises(Exception, match="encoder gave"):
        made.collect()


def test_metadata(spark):
    df = spark.createDataFrame([("c1", "d", "word"), ("c2", "d", "?!")], "chunk_id string, doc_id string, chunk_text string")
    rows = embed.embedding_metadata(embed.embed_chunks(df), embed.HASH_MODEL, snapshot_id=7).collect()
    assert [(r.chunk_id, r.embedding_model, r.vector_dimension, r.snapshot_id) for r in rows] == [
        ("c1", embed.HASH_MODEL, 384, 7)
    ]


def test_sums_in_runs_of_rows_are_those_of_the_batch(monkeypatch):
    texts = pa.array(["", "one two", None, "two two 2", "...", "a b c d e f g", "one", "é one", ""])
    whole = vec.hash_counts(texts, 7)
    rows, dims, weights = vec.hash_weights(texts, 7)
    want = np.zeros((len(texts), 7))
    want[rows, dims] = weights
    assert (whole == want).all() and whole.dtype == np.float32
    for run in (1, 2, 4, 9):
        monkeypatch.setattr(vec, "_ROWS_SUMMED", run, raising=False)
        assert (vec.hash_counts(texts, 7) == whole).all()
    assert vec.hash_counts(texts[:0], 7).shape == (0, 7)
