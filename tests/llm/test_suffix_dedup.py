import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from citemill.llm import suffix_dedup as sd


def brute(texts):
    seen = {}
    for t in texts:
        for s in range(len(t) - sd.LENGTH + 1):
            w = t[s : s + sd.LENGTH]
            seen[w] = seen.get(w, 0) + 1
    found = []
    for t in texts:
        gone = np.zeros(len(t) + 2, np.int8)
        for s in range(len(t) - sd.LENGTH + 1):
            if seen[t[s : s + sd.LENGTH]] > 1:
                gone[s + 1 : s + 1 + sd.LENGTH] = 1
        kept = bytes(b for b, g in zip(t, gone[1:]) if not g)
        found.append((len(t), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return found


def texts():
    r = random.Random(3)
    base = ["".join(r.choice("abcdefg hij") for _ in range(1500)) for _ in range(5)]
    made = [
        "a" * 1000, "ab" * 400, "x" * 199, "x" * 199, "y" * 200, "y" * 200, "", None, "é" * 300, "z" * 250,
        ("q" * 137 + "r") * 4, "abc" * 70, "abc" * 66 + "a", "abc" * 80 + "Q", "W" + "abc" * 80, "\x00" * 150 + "n" * 100,
    ]
    for _ in range(80):
        source, at, n = r.choice(base), r.randrange(0, 1100), r.randrange(150, 420)
        front = "".join(r.choice("abcdefghijkl") for _ in range(r.randrange(0, 300)))
        made.append(front + source[at : at + n] + "".join(r.choice("mnopé") for _ in range(r.randrange(0, 300))))
    common = "".join(r.choice("qwertz ") for _ in range(260))
    made += [str(n) * r.randrange(3, 90) + common + "|" + str(n) * 40 for n in range(40)]
    return made + [base[0]] * 30  # copies of one text


@pytest.mark.parametrize("crowded,piece", [(4096, 1 << 20), (3, 700)])
def test_report_equals_brute_force(spark, monkeypatch, crowded, piece):
    """Also where hashes are filed by window, and where texts and tasks are cut into many pieces."""
    monkeypatch.setattr(sd, "_PIECE", piece)
    given = texts()
    frame = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(7)
    want = brute([(t or "").encode() for t in given])
    got = sd.repeat_report(frame.withColumn("k", F.lit("x")), crowded=crowded).collect()
    assert len(got) == len(given)
    for x in got:
        assert tuple(x)[1:] == want[x.doc_id], given[x.doc_id]


def test_suffix_order_is_sorted():
    r = random.Random(8)
    for letters in (b"ab", b"abcdefgh", bytes(range(250))):
        body = bytes(r.choice(letters) for _ in range(3000)) + b"aaaa" * 40
        text = np.frombuffer(body + bytes([255]) * 60, np.uint8)
        order = sd.suffix_order(text, 50)
        assert sorted(order.tolist()) == list(range(len(text) - 50))
        cut = [text[i : i + 50].tobytes() for i in order]
        assert cut == sorted(cut)


def test_records_cover_each_start_once():
    r = np.random.default_rng(1)
    parts = [r.integers(97, 100, n, dtype=np.uint8) for n in (0, 5, 199, 200, 201, 5000, 300)]
    ends = np.cumsum([len(p) for p in parts])
    h, first, number, places = sd.records(np.concatenate(parts), ends)
    starts = [s for a, n in zip(first, number) for s in range(a, a + n)]
    want = [s for e, p in zip(ends, parts) for s in range(e - len(p), e - sd.LENGTH + 1)]
    assert starts == want and (places >= 1).all() and len(h) == len(first)


def test_spans_are_merged():
    assert sd.remove(b"0123456789", [(2, 4), (3, 5), (7, 8), (5, 6)]) == (b"016" + b"89", 5, 2)
    assert sd.remove(b"abc", []) == (b"abc", 0, 0)


def test_rows_and_columns_stay(spark):
    given = texts()
    frame = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    frame = frame.withColumns({"kept": F.lit("k"), "_k": F.col("doc_id"), "size": F.lit(None).cast("int")})
    found = sd.without_repeats(frame)
    assert found.columns == frame.columns
    got = {x.doc_id: x for x in found.collect()}
    assert len(got) == len(given) and all(x["_k"] == x.doc_id and x.kept == "k" for x in got.values())
    report = {x.doc_id: x for x in sd.repeat_report(frame).collect()}
    for k, t in enumerate(given):
        if t is None or report[k].n_removed == 0:
            assert got[k].text == t
        elif t.isascii():
            assert hashlib.sha256(got[k].text.encode()).hexdigest() == report[k].kept_sha256
    assert sd.without_repeats(frame.limit(0)).isEmpty() and sd.repeat_report(frame.limit(0)).isEmpty()


def test_null_and_equal_ids(spark):
    t = "".join(random.Random(1).choice("abcdefgh") for _ in range(400))
    rows = [(None, t), (None, t[:250] + "#" * 50), (7, t), (7, "other text"), (7, t)]
    got = sd.repeat_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x.n_bytes, x.n_removed) for x in got) == [(10, 0), (300, 250), (400, 400), (400, 400), (400, 400)]


@pytest.mark.parametrize("most", [2 << 20, 3000])
def test_long_runs_in_many_texts(spark, monkeypatch, most):
    """Long different runs of one byte, all under one hash, by sorting and where they are too many bytes."""
    monkeypatch.setattr(sd, "_CROWDED_BYTES", most)
    given = ["-" * (250 + 7 * n) + f"{n} end" for n in range(60)] + ["=" * 400 + "x", "=" * 210 + "y"]
    frame = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(5)
    want = brute([t.encode() for t in given])
    for x in sd.repeat_report(frame).collect():
        assert tuple(x)[1:] == want[x.doc_id], given[x.doc_id]
