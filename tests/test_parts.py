"""Texts in parts give the chunks of the whole."""

import random

import pytest
from pyspark.sql import functions as F

from citemill.operators import chunk, parts as pt
from citemill.sources import files


def _texts():
    r = random.Random(5)
    letters = "abc é\U0001f600\n.\t  "
    made = {f"d{n}": "".join(r.choice(letters) for _ in range(r.choice((0, 1, 59, 60, 61, 300, 2000)))) for n in range(12)}
    return made | {"long": "x y" * 3000, "blank": " " * 700 + "end", "gap": "a" + " " * 500 + "b"}


def _parts(texts, most):
    r = random.Random(most)
    rows = []
    for doc, text in texts.items():
        at, part = 0, -3
        while at < len(text):
            n = r.randrange(0, most)
            rows.append((doc, part, text[at : at + n] if n else None, "c"))
            at, part = at + n, part + r.randrange(1, 4)
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("most", [4, 150, 5000])
@pytest.mark.parametrize("keep_empty", [False, True])
def test_parts_equal_whole(spark, most, keep_empty):
    texts = _texts()
    whole = spark.createDataFrame(list(texts.items()), "doc_id string, content string")
    rows = _parts(texts, most) + [(None, 1, "left out", "c"), ("d1", None, "left out", "c")]
    parts = spark.createDataFrame(rows, "doc_id string, part int, content string, label string").repartition(5)
    got = pt.chunk_fixed_parts(parts, 60, 13, keep_empty, carry=("label",), block_chars=200)
    want = chunk.chunk_fixed(whole, 60, 13, keep_empty).withColumn("label", F.lit("c"))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_no_overlap_and_no_rows(spark):
    parts = spark.createDataFrame([("a", 1, "abcde"), ("a", 2, "fghij")], "doc_id string, part int, content string")
    got = pt.chunk_fixed_parts(parts, 4, 0, block_chars=1).orderBy("chunk_index").collect()
    assert [(r.chunk_index, r.chunk_text) for r in got] == [(0, "abcd"), (1, "efgh"), (2, "ij")]
    assert pt.chunk_fixed_parts(parts.limit(0)).isEmpty()


def test_part_given_twice_stops(spark):
    parts = spark.createDataFrame([("a", 1, "abc"), ("a", 1, "abc")], "doc_id string, part int, content string")
    with pytest.raises(Exception, match="part given twice: a 1"):
        pt.chunk_fixed_parts(parts).collect()


def test_a_block_is_bounded(spark):
    rows = [("a", n, "é" * (n % 97)) for n in range(400)] + [("b", 0, "z" * 9000)]
    parts = spark.createDataFrame(rows, "doc_id string, part int, content string")
    made = pt.blocks(parts, 500, 40)
    assert made.agg(F.max(F.length("text"))).first()[0] == 540
    whole = sum(n % 97 for n in range(400))
    assert made.filter("doc_id = 'a'").count() == -(-whole // 500)


def test_files_in_byte_ranges(spark, tmp_path):
    r = random.Random(2)
    for n in range(4):
        lines = ["".join(r.choice("wörter und \r zeichen 😀") for _ in range(r.randrange(0, 90))) for _ in range(300)]
        end = ("\n", "\r\n")[n % 2]
        (tmp_path / f"file {n}+50%25.txt").write_bytes((end.join(lines) + end * (n // 2)).encode())
    (tmp_path / "other.csv").write_bytes(b"no")
    (tmp_path / "bad.txt").write_bytes(b"good\n\xff\xfe")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 3000)
    try:
        parts = files.text_parts(spark, str(tmp_path), part_bytes=700).cache()
        assert parts.groupBy("doc_id").count().agg(F.max("count")).first()[0] > 15
        assert parts.groupBy("doc_id", "part").count().filter("count > 1").isEmpty()
        assert [x.filename for x in parts.filter("content is null").collect()] == ["bad.txt"]
        whole = files.loaded(files.scan(spark, str(tmp_path))).filter("reject_reason is null")
        got = pt.chunk_fixed_parts(parts.filter("filename <> 'bad.txt'"), carry=("filename",), block_chars=1000)
        want = chunk.chunk_fixed(whole, carry=("filename",))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
