import datetime as dt

import numpy as np
import pytest

from citemill.operators import chunk
from citemill.plans import pipeline

SCHEMA = "doc_id string, filename string, content string, file_type string"


def day(n):
    return dt.datetime(2024, 1, n, tzinfo=dt.timezone.utc)


def document(name, *parts):
    """A text of which each part makes a chunk of its own, and its overlap with the next."""
    return name, f"{name}.txt", "".join(p.ljust(150, ".") for p in parts), "txt"


def counting(spark):
    encoded = spark.sparkContext.accumulator(0)

    def load():
        def encode(texts):
            encoded.add(len(texts))
            return np.ones((len(texts), 4), np.float32)

        return encode

    return encoded, load


def renewed(spark, store, rows, n, load):
    frame = spark.createDataFrame(rows, SCHEMA)
    made = pipeline.reingest_changed(frame, store, day(n), load=load)
    want = chunk.chunk_fixed(frame, carry=("filename", "file_type")).select("chunk_id", "doc_id", "chunk_text")
    live = pipeline.live_points(store).select("chunk_id", "doc_id", "text")
    assert sorted(map(tuple, live.collect())) == sorted(map(tuple, want.collect()))
    return {r.change: r.chunks for r in made.collect()}


def test_only_what_differs_is_encoded_and_written(spark, tmp_path):
    store = pipeline.collection(spark, str(tmp_path / "c"), 4, by_chunk=True)
    encoded, load = counting(spark)
    first = [document("a", *"xyz"), document("b", *"pq"), document("c", "m")]
    assert renewed(spark, store, first, 1, load) == {"new": 6, "changed": 0, "gone": 0, "same": 0}
    assert encoded.value == 6
    # a loses its last part, b changes its first, c goes, d comes; what is alike is not touched.
    second = [document("a", *"xy"), document("b", *"Pq"), document("d", *"kl")]
    found = renewed(spark, store, second, 2, load)
    assert found == {"new": 2, "changed": 2, "gone": 2, "same": 2}
    assert encoded.value == 6 + 4
    assert store.rows().filter("snapshot_id = 2").count() == 6  # two of them withdraw
    assert pipeline.searchable(store).count() == 6
    # The same again writes nothing.
    assert renewed(spark, store, second, 3, load) == {"new": 0, "changed": 0, "gone": 0, "same": 6}
    assert encoded.value == 10 and store.log().count() == 2
    # What was withdrawn may come back; an empty source withdraws all.
    assert renewed(spark, store, first, 4, load)["new"] == 2
    assert renewed(spark, store, [], 5, load) == {"new": 0, "changed": 0, "gone": 6, "same": 0}
    assert pipeline.live_points(store, day(2)).count() == 6
    store.compact("chunk_id", day(6))
    assert pipeline.live_points(store).isEmpty()


def test_collections_of_the_other_kind_are_refused(spark, tmp_path):
    frame = spark.createDataFrame([document("a", "x")], SCHEMA)
    by_document = pipeline.collection(spark, str(tmp_path / "d"), 4)
    by_chunk = pipeline.collection(spark, str(tmp_path / "e"), 4, by_chunk=True)
    with pytest.raises(ValueError):
        pipeline.reingest_changed(frame, by_document, day(1))
    with pytest.raises(ValueError):
        pipeline.upsert(frame, by_chunk, day(1))
