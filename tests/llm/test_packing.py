import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from citemill.llm import packing

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def texts():
    r = random.Random(1)
    letters = "ab 's\n\t.,é中　 1²'!#\U0001f642\x1c ​\u0085"
    made = ["".join(r.choice(letters) for _ in range(r.randrange(1, 60))) for _ in range(1500)]
    return [*made, "", None, "<|endoftext|>", "word " * 9000, "it's 's"]


def test_ids_are_those_of_tokenizers(tokenizer):
    encoder = packing.ids_by(PATH, PATTERN)
    given = [t or "" for t in texts()]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in given]
    assert encoder.fast is not None and encoder.batch(given) == want
    encoder.fast, fast = None, encoder.fast
    assert encoder.batch(given[-200:]) == want[-200:]
    encoder.fast = fast


def test_pieces(spark, tokenizer):
    given = texts()
    frame = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").withColumn("ids", F.lit(1))
    got = {}
    for x in packing.pieces(frame.repartition(4), PATH, PATTERN, 256).collect():
        got.setdefault(x.doc_id, []).append(x)
    assert set(got) == set(range(len(given)))
    for k, t in enumerate(given):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        rows = sorted(got[k], key=lambda x: x.piece)
        assert b"".join(bytes(x.ids) for x in rows) == ids.tobytes()
        assert [x.piece for x in rows] == list(range(len(rows)))
        assert [x.start for x in rows] == np.cumsum([0, *[x.length for x in rows[:-1]]]).tolist()
        assert all(x.length == 256 for x in rows[1:]) and 1 <= rows[0].length <= 256
        assert len(rows) == -(-len(ids) // 256)


def check(lengths, limits, plan):
    """Every piece in order of length, its place; limits hold but for pieces alone."""
    bins = {}
    for k, first in enumerate(plan.first):
        last = plan.first[k + 1] if k + 1 < len(plan.first) else len(lengths)
        for n in range(last - first):
            b = plan.bin[k] + n // plan.each[k]
            bins.setdefault(b, []).append((plan.offset[k] + n % plan.each[k] * plan.length[k], plan.length[k]))
    assert sorted((x for b in bins.values() for _, x in b), reverse=True) == sorted(lengths, reverse=True)
    assert set(bins) == set(range(plan.bins))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        if len(held) > 1:
            assert at <= limits.tokens and len(held) <= limits.documents
            assert sum(x * x for _, x in held) <= limits.attention


@pytest.mark.parametrize("documents,attention", [(100, 10**6), (3, 10**6), (100, 3000)])
def test_every_limit_holds(documents, attention):
    r = random.Random(documents)
    limits = packing.Limits(100, documents, attention)
    for _ in range(30):
        lengths = [r.randrange(1, 101) for _ in range(r.randrange(1, 200))]
        histogram = {x: lengths.count(x) for x in set(lengths)}
        check(lengths, limits, packing.best_fit(histogram, limits))


def test_nearly_as_few_as_can_be():
    r = random.Random(4)
    lengths = [r.choice((2048, r.randrange(1, 2049), r.randrange(1, 300))) for _ in range(5000)]
    plan = packing.best_fit({x: lengths.count(x) for x in set(lengths)}, packing.Limits())
    check(lengths, packing.Limits(), plan)
    assert plan.bins <= 1.01 * sum(lengths) / 2048 + 1


def test_places_of_rows(spark):
    r = random.Random(7)
    rows = [(n, r.choice((64, 64, 64, r.randrange(1, 64)))) for n in range(3000)]  # most of one length
    frame = spark.createDataFrame(rows, "doc_id long, length long").withColumns({"offset": F.lit("x"), "_nth": F.lit("n"), "_size": F.lit(1)})
    found = packing.pack(frame.repartition(6), "length", ["doc_id"], packing.Limits(64, 64, 64 * 64))
    assert found.columns == ["doc_id", "length", "_nth", "_size", "sequence_id", "offset"]
    bins = {}
    for x in found.collect():
        assert x["_nth"] == "n"
        bins.setdefault(x.sequence_id, []).append((x.offset, x.length))
    assert sum(map(len, bins.values())) == 3000
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (2, 0), (3, -4), (None, 5), (4, 900)]
    frame = spark.createDataFrame(rows, "doc_id long, length long")
    got = packing.pack(frame, "length", ["doc_id"], packing.Limits(64, 64, 4096)).collect()
    assert len(got) == 6 and len({x.sequence_id for x in got if x.length == 900}) == 1
    assert [x.offset for x in got if x.length == 900] == [0]
    assert packing.pack(frame.limit(0), "length", ["doc_id"], packing.Limits()).isEmpty()
    assert zlib.crc32(b"") == 0
