import numpy as np
import pytest
from pyspark.sql import functions as F

from citemill.llm import negatives

ANCHOR = "vec_id % 10 = 0"
SCHEMA = "vec_id long, label int, embedding array<float>"


def plainly(rows, dim, every=10, positives=5, most=5, window=(80, 100)):
    """All scores of all anchors, from the definition."""
    items = []
    for number, label, v in rows:
        if number is None or label is None or v is None or len(v) != dim or any(x is None or not np.isfinite(x) for x in v):
            continue
        items.append((number, label, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    found = set()
    for a, label, v in items:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), b, other) for b, other, w in items if b != a)
        for s, p in [(-s, b) for s, b, other in scored if other == label][:positives]:
            fit = [(b, -t) for t, b, other in scored if other != label and window[0] * s <= -100 * t and -100 * t <= window[1] * s]
            found |= {(a, p, k + 1, b, s, t) for k, (b, t) in enumerate(fit[:most])}
    return found


def mined(frame, dim, **options):
    return [tuple(x) for x in negatives.mine(frame, F.expr(ANCHOR), dim, **options).collect()]


def vectors(n, dim, seed=1):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(4, dim))
    labels = r.integers(0, 4, n)
    x = centres[labels] + r.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    labels = np.where(r.random(n) < 0.3, (labels + 1) % 4, labels)
    return [(int(k), int(labels[k]), [float(v) for v in x[k].astype(np.float32)]) for k in range(n)]


@pytest.mark.parametrize("n, dim", [(700, 8), (400, 64), (30, 3)])
def test_rows_equal_brute_force(spark, monkeypatch, n, dim):
    monkeypatch.setattr(negatives, "_QUERY_ROWS", 23)
    rows = vectors(n, dim)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = mined(frame, dim)
    assert len(found) == len(set(found)) and set(found) == plainly(rows, dim)


def test_other_windows_and_numbers(spark):
    rows = vectors(300, 5, 7)
    found = mined(spark.createDataFrame(rows, SCHEMA), 5, positives=2, negatives=9, window=(30, 70))
    assert set(found) == plainly(rows, 5, positives=2, most=9, window=(30, 70)) and found


def test_copies_ties_and_rows_that_take_no_part(spark):
    rows = vectors(120, 4, 3)
    rows += [(1000 + k, k % 2, rows[10][2]) for k in range(300)]  # copies of one vector
    rows += [(2000 + k, 1, [0.0] * 4) for k in range(20)]
    nan = float("nan")
    rows += [(3000, None, rows[0][2]), (3010, 1, None), (3020, 1, [1.0, 2.0]), (3030, 1, [nan, 1.0, 1.0, 1.0]),
             (3040, 2, [float("inf")] * 4), (3050, 1, [None, 1.0, 1.0, 1.0]), (None, 1, rows[1][2]), (-10, 3, rows[2][2])]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = mined(frame, 4)
    assert len(found) == len(set(found)) and set(found) == plainly(rows, 4)
    huge = frame.union(spark.createDataFrame([(4000, 1, [3e30] * 4)], SCHEMA))
    assert set(mined(huge, 4)) == set(found)


def test_repeats_names_and_empty_tables(spark):
    rows = vectors(40, 3, 5)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", rank string, block int")
    once = set(mined(frame, 3))
    twice = mined(frame.union(frame), 3, positives=10, negatives=10)
    assert {(a, p, n) for a, p, _, n, _, _ in once} <= {(a, p, n) for a, p, _, n, _, _ in twice}
    assert mined(frame.limit(0), 3) == []
    assert mined(frame.filter("vec_id = 0"), 3) == []


def test_the_queue_leaves_boxes_out():
    r = np.random.default_rng(2)
    x = np.floor(256 * r.normal(size=(4000, 3)))
    tree = negatives.Tree(x, negatives.tiles(x, [0, 1, 2], negatives.LEAF))
    assert sorted(tree.rows.tolist()) == list(range(4000))
    labels, ids = np.zeros(4000, np.int64), np.arange(4000)
    q = negatives.Queries(x[:50], labels[:50], ids[:50], np.full(50, -np.inf), np.full(50, np.inf), True)
    at, found, scores, opened = negatives.search(tree, x, ids, labels, q, 5)
    assert len(at) == 250 and opened < 50 * tree.leaves / 4
    for k in range(50):
        s = x @ x[k]
        want = sorted((-s[j], j) for j in range(4000) if j != k)[:5]
        assert [(-a, b) for a, b in zip(scores[at == k], found[at == k])] == want
