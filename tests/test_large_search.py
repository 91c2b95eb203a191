"""Searches that read less, or take queries as many as items: all equal the plain one."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from citemill.functions import vectors as vec
from citemill.operators import blocks, cells, codes, embed, postings, search
from citemill.plans import pipeline
from tests.test_search import DIM, ITEMS, REQUESTS, data, exact


def rows(hits):
    return {(r.q_id, r.chunk_id, r.rk) for r in hits.collect()}


def odd_items(items):
    items = items + [("z1", [0.0] * DIM), ("z2", None), ("z3", [1.0] * 3), ("z4", [float("nan")] * DIM)]
    return items + [("z5", [float("inf")] + [1.0] * (DIM - 1)), ("z6", [1.0, None] * (DIM // 2))]


def cases():
    queries, items = data(600, 40, 3, k=7)
    yield "plain", queries, items
    copy = queries[0][1]
    yield "copies", queries, [(i, copy if n % 3 == 0 else v) for n, (i, v) in enumerate(items)]
    limited = [(j, v, 1 + j % 20, (None, 0.2, 0.9, -1.0)[j % 4]) for j, v, _, _ in queries]
    yield "limits", limited, odd_items(items)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, DIM))
    near = [(f"n{k:03d}", (centres[k % 5] + 0.05 * rng.normal(size=DIM)).astype(np.float32).tolist()) for k in range(500)]
    asked = [(j, (centres[j % 5] + 0.05 * rng.normal(size=DIM)).astype(np.float32).tolist(), 5, None) for j in range(20)]
    yield "clusters", asked, near
    yield "few", queries[:3], items[:4]
    yield "none", queries[:0], items[:4]
    yield "empty", queries[:3], items[:0]


@pytest.mark.parametrize("name, queries, items", list(cases()), ids=lambda x: x if isinstance(x, str) else "")
def test_all_ways_find_the_same(spark, name, queries, items):
    asked = spark.createDataFrame(queries, REQUESTS).repartition(3)
    held = spark.createDataFrame(items, ITEMS).repartition(4)
    usable = [x for x in items if x[1] is not None and len(x[1]) == DIM and all(v is not None and np.isfinite(v) for v in x[1]) and any(x[1])]
    want = exact(queries, usable) if queries and usable else set()
    small = 8 * DIM * 11
    assert rows(search.top_k_two_sided(asked, held, dim=DIM, query_block_bytes=small, item_block_bytes=small)) == want
    index = cells.build(held, dim=DIM, cells=9, sample=200)
    read = spark.sparkContext.accumulator(0)
    assert rows(cells.top_k(asked, index, read)) == want
    if name == "clusters":
        assert 0 < read.value < len(queries) * len(items) / 2
    listed = postings.build(held, dim=DIM)
    assert rows(postings.top_k(asked, listed, DIM)) == want
    coded = codes.encode(held, dim=DIM)
    assert rows(codes.top_k(asked, coded, held, dim=DIM, block_bytes=small)) == want


def test_no_query_comes_to_the_driver(spark, monkeypatch):
    queries, items = data(50, 30, 8, k=3)
    monkeypatch.setattr(search, "_sent_blocks", lambda *a: pytest.fail("sent from the driver"))
    asked, held = spark.createDataFrame(queries, REQUESTS), spark.createDataFrame(items, ITEMS)
    hits = search.top_k_two_sided(asked, held, dim=DIM)
    assert rows(hits) == exact(queries, items)
    assert hits._jdf.queryExecution().toString().count("CartesianProduct") == 0


def test_bounds_hold_for_every_item():
    rng = np.random.default_rng(6)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    centre, x, q = unit(rng.normal(size=8)), unit(rng.normal(size=(500, 8))), unit(rng.normal(size=(300, 8)))
    near = x @ centre
    for low, high in ((-1, 1), (0.2, 0.5), (-0.4, 0.0)):
        some = x[(near >= low) & (near <= high)]
        assert ((q @ some.T).max(axis=1) <= cells.reach(q @ centre, np.array(low), np.array(high), 8)).all()


def test_codes_take_a_quarter_and_their_intervals_hold(spark):
    queries, items = data(200, 10, 5)
    coded = codes.encode(spark.createDataFrame(items, ITEMS), dim=DIM).toArrow()
    assert all(len(c) == DIM for c in coded.column("code").to_pylist())
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    q, x = unit(np.array([v for _, v, _, _ in queries])), dict(items)
    low, high = codes.intervals(q, coded, DIM)
    true = q @ unit(np.array([x[i] for i in coded.column("chunk_id").to_pylist()])).T
    assert (low <= true).all() and (true <= high).all() and (high - low).max() < 0.05


def test_limits_leave_no_item_out():
    rng = np.random.default_rng(8)
    sparse = lambda n: rng.normal(size=(n, 30)) * (rng.random((n, 30)) < 0.2)
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    x, q = unit(sparse(800)), unit(sparse(60))
    q = q[np.abs(q).sum(axis=1) > 0]
    high, count = np.abs(x).max(axis=0), (x != 0).sum(axis=0)
    for floor in (0.1, 0.5, 0.9):
        wanted = postings.limits(q, np.full(len(q), floor), high, count)
        row, item = np.nonzero(q @ x.T >= floor)
        assert (np.abs(x[item]) >= wanted[row]).any(axis=1).all()


def test_few_postings_are_read_for_texts(spark, small):
    asked = spark.read.parquet(f"{small}/benchmark.parquet").selectExpr("item_id q_id", "text query")
    texts = spark.read.parquet(f"{small}/documents.parquet").selectExpr("cast(doc_id as string) chunk_id", "text chunk_text")
    held = embed.embed_chunks(texts)
    index, read = postings.build(held), spark.sparkContext.accumulator(0)
    requests = pipeline.embed_queries(asked, 4)
    found, want = rows(postings.top_k(requests, index, read=read)), rows(search.top_k(requests, held))
    assert found == want and len(want) == 160


def test_postings_are_summed_where_they_lie(spark):
    """No row for a pair of a query and an item: what is moved is some rows a task for each query."""
    queries, items = data(400, 30, 3, k=3)
    held = spark.createDataFrame([(i, v) for i, v in items], ITEMS).repartition(2)
    index = postings.build(held, dim=DIM)
    hits = postings.top_k(spark.createDataFrame(queries, REQUESTS), index, DIM)
    assert rows(hits) == exact(queries, items)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 0 and plan.count("HashAggregate") == 0


@pytest.mark.parametrize("limit", ["SHARD_ROWS", "SHARD_WEIGHTS", "SHARD_BYTES"])
def test_packed_vectors_copies_and_many_shards(spark, monkeypatch, limit):
    monkeypatch.setattr(postings, limit, 40)
    monkeypatch.setattr(postings, "_SLICE_ROWS", 16)
    queries, items = data(90, 12, 2, k=4)
    held = spark.createDataFrame(odd_items(items), ITEMS)
    held = held.filter("chunk_id <> 'z6'").unionByName(held.filter("chunk_id < 'i2'")).coalesce(1)
    asked = spark.createDataFrame(queries, REQUESTS)
    packed = held.withColumn("embedding", vec.pack(held["embedding"].cast("array<float>")))
    want = sorted(map(tuple, search.top_k(asked, held, dim=DIM).collect()))
    index = postings.build(packed, dim=DIM)
    assert index.shards.count() > 1
    assert sorted(map(tuple, postings.top_k(asked, index, DIM).collect())) == want
    assert sorted(map(tuple, search.top_k(asked, packed, dim=DIM).collect())) == want


def test_shards_in_memory_are_bounded_by_bytes(spark, monkeypatch):
    """A task that writes or reads an index holds some of its shards, however many there are."""
    monkeypatch.setattr(postings, "SHARD_ROWS", 10)
    monkeypatch.setattr(postings, "_SLICE_ROWS", 10)
    monkeypatch.setattr(postings, "GROUP_BYTES", 4096, raising=False)
    queries, items = data(600, 5, 3, k=4)
    index = postings.build(spark.createDataFrame(items, ITEMS).coalesce(1), dim=DIM)
    held = [pq.read_metadata(f.removeprefix("file://")) for f in index.shards.inputFiles()]
    groups = [m.row_group(k) for m in held for k in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 60
    most = max(sum(map(len, r)) for r in index.shards.collect())
    assert max(g.total_byte_size for g in groups) < 4096 + 2 * most
    assert rows(postings.top_k(spark.createDataFrame(queries, REQUESTS), index, DIM)) == exact(queries, items)


def test_vectors_for_an_index_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def load():
        def encode(texts):
            made.add(len(texts))
            return np.array([[len(t), 1.0, t.count("a")] for t in texts.to_pylist()], np.float32)

        return encode

    texts = spark.range(50).selectExpr("cast(id as string) chunk_id", "repeat('ab', cast(id as int)) chunk_text")
    for packed in (False, True):
        index = postings.build(embed.embed_chunks(texts, load, 3, packed=packed), dim=3)
        assert sum(blocks.read_stream(r.rows).num_rows for r in index.shards.collect()) == 50
        assert made.value == 50
        made.add(-50)


def test_shards_give_the_vectors_back(spark):
    rng = np.random.default_rng(9)
    sparse = rng.integers(1, 9, size=(70, DIM)) * (rng.random((70, DIM)) < 0.3)
    sparse[:, 0] = 1
    for kind, x, width in (("float", sparse, 1), ("float", sparse * 100, 4), ("float", sparse / 3, 4), ("double", sparse / 3, 8)):
        x = x.astype(np.float32 if kind == "float" else np.float64)
        items = spark.createDataFrame([(f"{n:03d}", v.tolist()) for n, v in enumerate(x)], f"chunk_id string, embedding array<{kind}>")
        found = {}
        for r in postings.build(items, dim=DIM).shards.collect():
            shard = postings._Shard(r.rows, r.starts, r.lists, DIM)
            assert blocks.read_stream(r.lists).schema.field("value").type.bit_width == 8 * width
            ids = shard.rows.column(0).to_pylist()
            some = np.arange(len(ids))[::-1]
            found |= {ids[i]: v for i, v in zip(some, shard.vectors(some))}
            unit = x[[int(i) for i in ids]].astype(np.float64)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            at = np.repeat(np.arange(DIM), np.diff(shard.starts))
            assert np.allclose(unit[shard.numbers, at], shard.weights, atol=1e-12)
            assert all((np.diff(shard.size[a:b]) <= 0).all() for a, b in zip(shard.starts, shard.starts[1:]))
        assert (np.array([found[f"{n:03d}"] for n in range(len(x))]) == x).all()
