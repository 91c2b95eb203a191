import hashlib
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from citemill.operators import chunk
from citemill.plans import oracle


def documents(spark, texts):
    rows = [(str(i), t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id string, content string")


def by_document(chunks, column="chunk_text"):
    out = {}
    for row in sorted(chunks.collect(), key=lambda r: (r.doc_id, r.chunk_index)):
        assert row.chunk_index == len(out.get(row.doc_id, []))
        out.setdefault(row.doc_id, []).append(row[column])
    return out


def windows(text, size, overlap, keep):
    cut = [text[at : at + size].strip() for at in range(0, len(text), size - overlap)]
    return [c for c in cut if c or keep]


def random_texts(n, seed):
    rng = random.Random(seed)
    letters = "ab é\n\t 　\x1c😀.!? \r"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 900))) for _ in range(n)]


@pytest.mark.parametrize(
    "length, expected",
    [(0, []), (1, [1]), (150, [150]), (151, [151, 1]), (200, [200, 50]), (201, [200, 51]),
     (300, [200, 150]), (301, [200, 151, 1])],
)
def test_window_lengths(spark, length, expected):
    found = by_document(chunk.chunk_fixed(documents(spark, ["x" * length])), "chunk_size")
    assert found.get("0", []) == expected


def test_empty_windows_are_dropped_before_numbering(spark):
    texts = [" " * 200, "x" * 150 + " " * 200 + "y" * 150]
    dropped = by_document(chunk.chunk_fixed(documents(spark, texts)))
    assert dropped == {"1": ["x" * 150, "y" * 150, "y" * 50]}
    kept = by_document(chunk.chunk_fixed(documents(spark, texts), keep_empty=True))
    assert kept == {"0": ["", ""], "1": ["x" * 150, "", "y" * 150, "y" * 50]}


@pytest.mark.parametrize("size, overlap, keep", [(200, 50, False), (7, 3, True), (5, 0, False)])
def test_windows_equal_brute_force(spark, size, overlap, keep):
    texts = random_texts(60, size)
    found = by_document(chunk.chunk_fixed(documents(spark, texts), size, overlap, keep))
    for i, text in enumerate(texts):
        assert found.get(str(i), []) == windows(text, size, overlap, keep)


@pytest.mark.parametrize("size, overlap", [(50, 50), (50, 60), (0, 0), (10, -1)])
def test_bad_window_is_refused(spark, size, overlap):
    with pytest.raises(ValueError):
        chunk.chunk_fixed(documents(spark, ["x"]), size, overlap)


def test_long_text_is_cut_in_linear_time(spark):
    text = spark.range(1).select(
        F.lit("0").alias("doc_id"), F.expr("repeat('abcde fghé ', 500000)").alias("content")
    )
    row = chunk.chunk_fixed(text).agg(F.count("*"), F.max("chunk_index")).first()
    assert row[0] == -(-5_500_000 // 150) and row[1] == row[0] - 1


def test_ids_and_labels(spark):
    row = chunk.chunk_fixed(documents(spark, ["hello"])).first()
    assert row.chunk_id == hashlib.md5(b"0-0").hexdigest()[:16]
    assert row.chunking_strategy == "fixed-200-overlap-50"
    row = chunk.chunk_sentences(documents(spark, ["hello"])).first()
    assert row.chunk_id == hashlib.md5(b"0-0").hexdigest()[:16]
    assert row.chunking_strategy == "smart-500-overlap-100"


def test_sentence_chunks(spark):
    texts = [
        "aa bb cc. dd ee ff! gg hh ii? jj.",
        "...",
        "a sentence that is far longer than the limit. b",
        "x" * 10 + ". " + "y" * 9 + ".",
        "x" * 10 + ". " + "y" * 10 + ".",
    ]
    found = chunk.chunk_sentences(documents(spark, texts), 20, 2)
    rows = {}
    for r in sorted(found.collect(), key=lambda r: (r.doc_id, r.chunk_index)):
        rows.setdefault(r.doc_id, []).append((r.chunk_text, r.chunk_size))
    assert rows["0"] == [("aa bb cc dd ee ff", 18), ("ee ff gg hh ii jj", 17)]
    assert "1" not in rows
    long = "a sentence that is far longer than the limit"
    assert rows["2"] == [(long, len(long)), ("the limit b", 11)]
    assert rows["3"] == [("x" * 10 + " " + "y" * 9, 21)]
    assert rows["4"] == [("x" * 10, 11), ("x" * 10 + " " + "y" * 10, 21)]


def by_recursive_query(texts, size, overlap):
    rows = [(str(i), t, "x", "en") for i, t in enumerate(texts)]
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "source", "lang"])
    db = duckdb.connect()
    db.register("documents", frame)
    columns = "doc_id, chunk_index, chunk_text, chunk_size, chunk_id"
    return set(db.execute(f"{oracle.smart(size, overlap)} SELECT {columns} FROM smart").fetchall())


@pytest.mark.parametrize("size, overlap", [(500, 100), (40, 3), (1, 1)])
def test_sentence_chunks_equal_a_recursive_query(spark, size, overlap):
    texts = random_texts(80, 5) + ["", "no end"]
    found = chunk.chunk_sentences(documents(spark, texts), size, overlap)
    columns = ["doc_id", "chunk_index", "chunk_text", "chunk_size", "chunk_id"]
    got = [tuple(r) for r in found.select(*columns).collect()]
    assert set(got) == by_recursive_query(texts, size, overlap) and len(set(got)) == len(got)


def test_many_chunks_of_one_text_come_in_several_batches(spark):
    text = " ".join(f"s{i}." for i in range(6000))
    found = by_document(chunk.chunk_sentences(documents(spark, [text]), 1, 1))["0"]
    assert found == ["s0"] + [f"s{i} s{i + 1}" for i in range(5999)]


def test_sentence_overlap_must_be_positive(spark):
    with pytest.raises(ValueError):
        chunk.chunk_sentences(documents(spark, ["x"]), 20, 0)


def test_carried_columns_and_nulls(spark):
    rows = [("1", "hello there", "f"), ("2", None, "g")]
    docs = spark.createDataFrame(rows, "doc_id string, content string, filename string")
    for cut in (chunk.chunk_fixed, chunk.chunk_sentences):
        assert [r.filename for r in cut(docs, carry=("filename",)).collect()] == ["f"]


def test_chunk_ids_do_not_depend_on_partitioning(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumnRenamed("text", "content")
    one = chunk.chunk_fixed(docs.coalesce(1)).select("chunk_id", "chunk_text")
    many = chunk.chunk_fixed(docs.repartition(13)).select("chunk_id", "chunk_text")
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_chunks_encoded_by_words_have_the_vectors_of_their_texts(monkeypatch, spark):
    """Every word is hashed once, whatever the number of chunks that repeat it."""
    from citemill.functions import vectors as vec
    from citemill.operators import chunk, embed

    texts = [" ".join(f"Wo{i}rd{k % 7}-xİK {k * i} end." if k % 9 else f"S{k}! " for k in range(300)) for i in range(5)]
    texts += ["", "...", "aΣ b. CΣ d", "one"]
    for rows in (7, 2048):
        monkeypatch.setattr(chunk, "_ROWS_PER_BATCH", rows)
        rows_in = spark.createDataFrame([(str(n), t) for n, t in enumerate(texts)], "doc_id string, content string").coalesce(1)
        made = chunk.chunk_sentences(rows_in, 80, 20, load=embed.hash_text_encoder, packed=True).toArrow()
        want = vec.hash_counts(vec.pa.array([t.lower() for t in made["chunk_text"].to_pylist()]))
        assert made["embedding"].to_pylist() == vec.matrix_packed(want)[0].to_pylist()
        assert set(made["broken"].to_pylist()) == {None}
