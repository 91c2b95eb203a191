import numpy as np
import pytest
from pyspark.sql import functions as F

from citemill.operators import embed, search
from citemill.plans import pipeline

DIM = 8
ITEMS = f"chunk_id string, embedding array<float>"
REQUESTS = "q_id bigint, embedding array<float>, top_k int, min_score double"


def exact(queries, items):
    """Brute force in double precision, ties by id."""
    out = set()
    for q, qv, k, floor in queries:
        a = np.array(qv, dtype=np.float32).astype(float)
        scored = []
        for i, v in items:
            b = np.array(v if v is not None and None not in v else [], dtype=np.float32).astype(float)
            if len(b) != len(a) or not np.isfinite(b).all() or not b.any() or not a.any():
                continue
            score = (a * b).sum() / (np.sqrt((a**2).sum()) * np.sqrt((b**2).sum()))
            if floor is None or score >= floor:
                scored.append((-score, i))
        out |= {(q, i, rk) for rk, (_, i) in enumerate(sorted(scored)[:k], 1)}
    return out


def found(spark, queries, items, partitions=3, **options):
    requests = spark.createDataFrame(queries, REQUESTS)
    stored = spark.createDataFrame(items, ITEMS).repartition(partitions)
    hits = search.top_k(requests, stored, dim=DIM, **options)
    return {(r.q_id, r.chunk_id, r.rk) for r in hits.collect()}


def data(n, q, seed, k=5, floor=None):
    rng = np.random.default_rng(seed)
    items = [(f"c{i:05d}", rng.normal(size=DIM).tolist()) for i in range(n)]
    queries = [(j, rng.normal(size=DIM).tolist(), k, floor) for j in range(q)]
    return queries, items


@pytest.mark.parametrize("n, q, k, floor", [(500, 7, 5, None), (3, 2, 5, None), (400, 300, 1, 0.5)])
def test_equals_brute_force(spark, n, q, k, floor):
    queries, items = data(n, q, n, k, floor)
    assert found(spark, queries, items) == exact(queries, items)


def test_small_batches_and_query_blocks(spark):
    queries, items = data(600, 20, 1)
    want = exact(queries, items)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "37")
    try:
        assert found(spark, queries, items) == want
        assert found(spark, queries, items, block_bytes=8 * DIM * 4) == want
    finally:
        spark.conf.set(key, before)


def test_a_third_of_all_rows_are_copies(spark):
    queries, items = data(900, 6, 2, k=20)
    copy = queries[0][1]
    items = [(i, copy if n % 3 == 0 else v) for n, (i, v) in enumerate(items)]
    assert found(spark, queries, items) == exact(queries, items)


def test_near_ties_are_ranked_in_double_precision(spark):
    base = np.ones(DIM, dtype=np.float32)
    items = []
    for i in range(200):
        v = base.copy()
        v[i % DIM] += np.float32(1e-6) * (i % 23)
        items.append((f"c{i:03d}", v.tolist()))
    queries = [(0, base.tolist(), 10, None), (1, (base + np.arange(DIM) * 1e-3).tolist(), 10, None)]
    assert found(spark, queries, items) == exact(queries, items)


def test_rows_without_direction_are_left_out(spark):
    queries, items = data(30, 2, 3, k=20)
    items += [("z1", [0.0] * DIM), ("z2", None), ("z3", [1.0] * 3), ("z4", [float("nan")] * DIM)]
    items += [("z5", [float("inf")] + [1.0] * (DIM - 1)), ("z6", [1.0, None] * (DIM // 2))]
    queries += [(8, [0.0] * DIM, 3, None), (9, None, 3, None), (10, [1.0], 3, None)]
    for q, bad in enumerate((float("nan"), float("inf"), -float("inf"), None), 11):
        queries.append((q, [bad] + [1.0] * (DIM - 1), 3, None))
    queries.append((20, [1.0] * DIM, 0, None))
    usable = [q for q in queries if q[0] < 8]
    assert found(spark, queries, items) == exact(usable, items)


def test_very_long_and_very_short_vectors(spark):
    queries, items = data(60, 5, 8, k=20)
    scale = [1e-30, 1e-20, 1.0, 1e20, 1e30]
    items = [(i, [scale[n % 5] * e for e in v]) for n, (i, v) in enumerate(items)]
    assert found(spark, queries, items) == exact(queries, items)


def test_vectors_in_double_precision(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=DIM)
    items = [(f"c{i:03d}", (base + 1e-9 * rng.normal(size=DIM)).tolist()) for i in range(99)]
    stored = spark.createDataFrame(items, "chunk_id string, embedding array<double>")
    query = rng.normal(size=DIM)
    requests = spark.createDataFrame([(1, query.tolist(), 20, None)], REQUESTS.replace("float", "double"))
    hits = search.top_k(requests, stored, dim=DIM).orderBy("rk").collect()
    def score(v):
        v = np.array(v)
        return (v * query).sum() / (np.sqrt((query**2).sum()) * np.sqrt((v**2).sum()))
    want = sorted(items, key=lambda item: (-score(item[1]), item[0]))[:20]
    assert [h.chunk_id for h in hits] == [i for i, _ in want]


def test_each_query_has_its_own_limits(spark):
    queries, items = data(200, 4, 4)
    queries = [(j, v, 1 + 3 * j, (None, 0.2, 0.9, -1.0)[j]) for j, v, _, _ in queries]
    assert found(spark, queries, items) == exact(queries, items)


def test_seed_does_not_change_the_result(spark):
    queries, items = data(700, 9, 7, k=6)
    queries[3] = (3, queries[3][1], 6, 0.6)
    items = [(i, queries[0][1] if n % 3 == 0 else v) for n, (i, v) in enumerate(items)]
    want = exact(queries, items)
    for size in (3, 50, 700):
        seed = spark.createDataFrame(items[-size:], ITEMS)
        assert found(spark, queries, items, seed=seed) == want


def test_no_query_finds_nothing(spark):
    _, items = data(20, 1, 5)
    assert found(spark, [(1, None, 3, None)], items) == set()


def test_texts_and_stored_vectors_give_the_same_hits(spark, small):
    asked = spark.read.parquet(f"{small}/benchmark.parquet").selectExpr("item_id q_id", "text query")
    texts = spark.read.parquet(f"{small}/documents.parquet").selectExpr(
        "cast(doc_id as string) chunk_id", "text chunk_text"
    )
    on_the_fly = pipeline.search_texts(asked, texts, 4, carry=("chunk_text",)).drop("text")
    stored = embed.embed_chunks(texts)
    hits = search.top_k(pipeline.embed_queries(asked, 4), stored)
    a, b = set(map(tuple, on_the_fly.collect())), set(map(tuple, hits.collect()))
    assert a == b and len(a) == 160


def test_named_queries_and_large_arrow_types(spark):
    asked = spark.createDataFrame([("first", "red fox"), ("second", "blue")], "q_id string, query string")
    texts = spark.createDataFrame([("a", "A blue sky"), ("b", "The red, red fox")], "chunk_id string, chunk_text string")
    key = "spark.sql.execution.arrow.useLargeVarTypes"
    for large in ("false", "true"):
        spark.conf.set(key, large)
        try:
            hits = pipeline.search_texts(asked, texts, 1, carry=()).collect()
            cells = embed.hash_weights(texts, "chunk_id", "chunk_text").count()
        finally:
            spark.conf.unset(key)
        assert {(h.q_id, h.chunk_id) for h in hits} == {("first", "b"), ("second", "a")}
        assert cells == 6


def test_hits_found_again_by_threshold(spark):
    """Hits above a score are those of the plain ranking that reach it."""
    queries, items = data(300, 5, 6, k=20)
    plain = spark.createDataFrame(items, ITEMS)
    every = search.top_k(spark.createDataFrame(queries, REQUESTS), plain, dim=DIM)
    limited = search.top_k(
        spark.createDataFrame([(q, v, k, 0.4) for q, v, k, _ in queries], REQUESTS), plain, dim=DIM
    )
    kept = every.filter(F.col("score") >= 0.4)
    assert kept.exceptAll(limited).isEmpty() and limited.exceptAll(kept).isEmpty()


def test_items_are_read_and_encoded_once_for_any_number_of_blocks(spark, tmp_path):
    queries, items = data(90, 40, 12)
    spark.createDataFrame(items, ITEMS).repartition(3).write.parquet(str(tmp_path / "items"))
    encoded = spark.sparkContext.accumulator(0)

    def load():
        def encode(lists):
            encoded.add(len(lists))
            return np.array(lists.to_pylist(), np.float32)

        return encode

    requests = spark.createDataFrame(queries, REQUESTS)
    stored = spark.read.parquet(str(tmp_path / "items"))
    hits = search.top_k(requests, stored, dim=DIM, encoder=load, block_bytes=8 * DIM * 3)
    assert hits._jdf.queryExecution().toString().count("Scan parquet") <= 2  # spark and physical plan
    assert {(r.q_id, r.chunk_id, r.rk) for r in hits.collect()} == exact(queries, items)
    assert encoded.value == 90
