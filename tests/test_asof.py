import random

import pytest
from pyspark.sql import functions as F

from citemill.operators import asof, tables as tb

LEFT, RIGHT = "k string, t long, n long, v string", "k string, t long, i long, v string"


def plainly(left, right):
    found = {}
    for k, t, n, _ in left:
        earlier = [(rt, i, v) for rk, rt, i, v in right if rk is not None and rk == k and rt is not None and t is not None and rt <= t]
        found[n] = max(earlier)[1:] if earlier else (None, None)
    return found


@pytest.mark.parametrize("batch", [10_000, 5])
def test_last_rows_equal_brute_force(spark, batch):
    """One key has most rows of both sides; many tasks, small batches, ties."""
    r = random.Random(batch)
    key = lambda: r.choice(["hot"] * 7 + list("abc"))
    left = [(key(), r.randrange(200), n, "own") for n in range(700)] + [(None, 3, 900, "x"), ("a", None, 901, "x"), ("only", 9, 902, "x")]
    right = [(key(), r.randrange(200), i, f"v{i}" if i % 5 else None) for i in range(60)] + [(None, 1, 99, "null"), ("other", 1, 98, "o"), ("hot", None, 97, "x")]
    keep = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = asof.as_of_join(
            spark.createDataFrame(left, LEFT).repartition(4), spark.createDataFrame(right, RIGHT).repartition(3), "k", "t", "i", ("i", "v")
        ).collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert len(found) == len(left)
    assert {x.n: (x.i, x.v) for x in found} == plainly(left, right)


def test_empty_sides(spark):
    left, right = spark.createDataFrame([("a", 1, 1, "x")], LEFT), spark.createDataFrame([("a", 1, 1, "y")], RIGHT)
    assert [x.v for x in asof.as_of_join(left, right, "k", "t", "i", ("v",)).collect()] == ["y"]
    assert [x.v for x in asof.as_of_join(left, right.limit(0), "k", "t", "i", ("v",)).collect()] == [None]
    assert asof.as_of_join(left.limit(0), right, "k", "t", "i", ("v",)).isEmpty()


def test_chunks_are_traced_to_the_version_they_were_cut_from(spark):
    documents = spark.createDataFrame(
        [("d", "d.txt", "one", 3, 1), ("d", "d.txt", "two words", 9, 4), ("e", "e.md", "other", 5, 2)],
        "doc_id string, filename string, content string, file_size int, snapshot_id long",
    )
    log = spark.sql("select * from values (1L, timestamp'2024-01-01', 'append'), (2L, timestamp'2024-01-02', 'append'), (4L, timestamp'2024-01-04', 'append') t(snapshot_id, committed_at, operation)")
    chunks = spark.createDataFrame(
        [("c1", "d", 0, "fixed", 1), ("c2", "d", 0, "fixed", 3), ("c3", "d", 0, "fixed", 5), ("c4", "e", 0, "fixed", 1), ("c5", "x", 0, "fixed", 9)],
        "chunk_id string, doc_id string, chunk_index int, chunking_strategy string, snapshot_id long",
    )
    found = {x.chunk_id: x for x in tb.version_lineage(chunks, documents, log).collect()}
    assert {c: x.document_snapshot for c, x in found.items()} == {"c1": 1, "c2": 1, "c3": 4, "c4": None, "c5": None}
    assert (found["c2"].file_size, found["c3"].file_size, found["c3"].operation) == (3, 9, "append")
    assert found["c3"].file_hash == documents.filter("snapshot_id = 4").select(F.md5(F.encode("content", "UTF-8"))).first()[0]
