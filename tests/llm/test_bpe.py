import hashlib
import random
import time

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from citemill.llm import bpe, queries

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def encoding(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    r = random.Random(1)
    letters = "ab 's\n\t.,é中　 1²'!#\U0001f642\x1c ​\u0085"
    made = ["".join(r.choice(letters) for _ in range(r.randrange(1, 40))) for _ in range(300)]
    return [*made, "", None, " ", "  a", "it's we'll 'tis", "<|endoftext|>", "a" * 2500, "word " * 5000, "\x00\x01"]


def test_ids_and_bytes(spark, encoding):
    given = texts()
    frame = spark.createDataFrame(list(enumerate(given)), "id long, text string").withColumns(
        {"ids": F.lit("x"), "words": F.lit(1), "decoded": F.lit(2)}
    )
    found = bpe.decode(bpe.encode(frame.repartition(4), PATH, PATTERN), PATH).collect()
    assert len(found) == len(given)
    for x in found:
        text = given[x.id] or ""
        assert x.ids == encoding.encode_ordinary(text), text
        assert bytes(x.decoded) == text.encode() and x.words == 1


def test_a_full_store_of_words_changes_nothing(ranks, encoding):
    words = [w.encode() for t in texts() for w in (t or "").split() if w]
    kept, bpe._KEPT_WORDS = bpe._KEPT_WORDS, 20
    try:
        own = bpe.Encoding(ranks)
        for k in range(0, len(words), 7):
            part = words[k : k + 7]
            ids = own.encoded(pa.array(part, pa.binary()), np.arange(len(part) + 1)).to_pylist()
            assert ids == [encoding._encode_single_piece(w) for w in part]
    finally:
        bpe._KEPT_WORDS = kept


def test_very_long_words_take_seconds(spark, encoding):
    r = random.Random(9)
    long = ["".join(r.choice("abcdefgh") for _ in range(100_000)), "ab" * 150_000]
    start = time.time()
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(long)], "id long, text string")
    found = {x.id: x.ids for x in bpe.encode(frame, PATH, PATTERN).collect()}
    assert time.time() - start < 60
    assert found == {k: encoding.encode_ordinary(t) for k, t in enumerate(long)}


def test_ids_beyond_the_vocabulary_have_no_bytes(spark):
    frame = spark.createDataFrame([(None,), ([],), ([64, None, 99_999, -1, 65],)], "ids array<int>")
    assert [bytes(x.decoded) for x in bpe.decode(frame, PATH).collect()] == [b"", b"", b"ab"]


def test_query_equals_the_library(spark, small, encoding):
    found = {x.doc_id: x for x in queries.op7_byte_bpe(spark, small).collect()}
    given = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(found) == len(given)
    for x in given:
        ids, made = encoding.encode_ordinary(x.text), found[x.doc_id]
        assert made.n_tokens == len(ids)
        assert made.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert made.decoded_sha256 == hashlib.sha256(x.text.encode()).hexdigest()


def test_documents(spark, small, encoding):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("text")
    for x in bpe.encode(rows, PATH, PATTERN).collect():
        assert x.ids == encoding.encode_ordinary(x.text)


def test_empty_table(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    assert bpe.encode(rows, PATH, PATTERN).isEmpty()
