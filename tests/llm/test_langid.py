import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from citemill.llm import langid


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return rows.withColumn("held_out", langid.held_out(F.col("doc_id")))


@pytest.fixture(scope="module")
def model(documents):
    return langid.fit(documents.filter("not held_out"), "doc_id", "text", "lang")


def test_held_out_accuracy(documents, model):
    found = langid.predict(documents.filter("held_out"), model)
    right, all_ = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert all_ > 150 and right >= 0.98
    assert found.filter("rejected").count() <= 1
    assert found.filter("score < 0 or score > 1").isEmpty()


def test_held_out_rows_teach_nothing(documents, model):
    other = documents.withColumn("lang", F.when(F.col("held_out"), "xx").otherwise(F.col("lang")))
    again = langid.fit(other.filter("not held_out"), "doc_id", "text", "lang")
    assert again.languages == model.languages and np.allclose(again.centroids, model.centroids)


def test_several_centroids_of_unit_length(model):
    assert np.allclose(np.linalg.norm(model.centroids, axis=1), 1, atol=1e-4)
    assert len(model.centroids) > len(model.languages)


def test_odd_texts(spark, model):
    rows = [
        (1, None), (2, ""), (3, "12 345 !?"), (4, "Жди меня " * 30), (5, "the"),
        (6, "that the and of " * 400_000), (6, "that the and of " * 400_000), (7, "中文字典 " * 40),
    ]
    frame = spark.createDataFrame(rows, "id long, text string")
    frame = frame.withColumns({"score": F.lit("s"), "_body": F.lit("b")})
    found = langid.predict(frame, model)
    assert found.columns == ["id", "text", "_body", "lang_pred", "score", "rejected"]
    got = {x.id: x for x in found.collect()}
    assert found.count() == 8 and got[1]["_body"] == "b"
    assert all(got[k].lang_pred == "und" and got[k].score == 0 and got[k].rejected for k in (1, 2, 3))
    assert got[4].lang_pred in model.languages and got[4].rejected and got[7].rejected
    assert not got[5].rejected  # too short for its distance to mean anything
    assert got[6].lang_pred == "en" and not got[6].rejected
    assert langid.predict(frame.limit(0), model).isEmpty()


def test_a_long_text_counts_the_same_in_pieces(monkeypatch):
    data = np.frombuffer(("The cat and l'été; " * 900).encode(), np.uint8)
    at = np.array([0, len(data)])
    whole = langid.counts(data, at, 0, 1)
    monkeypatch.setattr(langid, "_RUN_BYTES", 501)
    assert np.array_equal(langid.counts(data, at, 0, 1), whole)


def test_nothing_to_learn_from(spark, documents):
    bare = documents.limit(5).withColumn("lang", F.lit(None).cast("string"))
    model = langid.fit(bare, "doc_id", "text", "lang")
    assert {x.lang_pred for x in langid.predict(bare, model).collect()} == {"und"}


def test_ties_go_to_the_first_language():
    model = langid.Model(["aa", "bb"], np.array([0, 1]), np.ones((2, langid.DIMS), np.float32), np.ones(langid.DIMS, np.float32), np.zeros(2))
    assert model.owner[np.argmax(np.ones((1, 2)), axis=1)][0] == 0


def plain_prediction(model, text):
    """Language, cosine and rejection of one text, gram by gram, from the definition."""
    if text is None or not any(c.isalpha() for c in text):
        return "und", 0.0, True
    data = f" {text.lower()} ".encode()
    folded = [b if b >= 128 or ord("a") <= b <= ord("z") else 32 for b in data]
    times = {}
    for size, seed in ((2, 17), (3, 91)):
        for k in range(len(folded) - size + 1):
            gram = folded[k : k + size]
            if any(a == b == 32 for a, b in zip(gram, gram[1:])):
                continue
            number = 0
            for b in gram:
                number = number << 8 | b
            place = (number * 2654435761 + seed) % 2**32 * 0x9E3779B1 % 2**32 >> 19
            times[place] = times.get(place, 0) + 1
    weight = {p: math.log1p(n) * float(model.weights[p]) for p, n in times.items()}
    length = math.sqrt(sum(w * w for w in weight.values())) or 1.0
    cosines = [sum(w * float(c[p]) for p, w in weight.items()) / length for c in model.centroids]
    best = max(range(len(cosines)), key=lambda k: (cosines[k], -k))
    language = int(model.owner[best])
    score = min(max(cosines[best], 0.0), 1.0)
    return model.languages[language], score, score < model.lowest[language] and len(data) >= langid.EVIDENCE


def test_predictions_equal_plain_ones(spark, documents, model):
    extra = [(-1, None), (-2, ""), (-3, "1!"), (-4, "Жди меня " * 30), (-5, "the"), (-6, "Ÿ l'Été a  b"), (-7, "x\ty\n" * 30)]
    rows = documents.select("doc_id", "text").limit(150).union(spark.createDataFrame(extra, "doc_id long, text string"))
    found = langid.predict(rows, model).collect()
    assert len(found) == 157
    for x in found:
        lang, score, rejected = plain_prediction(model, x.text)
        assert (x.lang_pred, x.rejected) == (lang, rejected), x.doc_id
        assert abs(x.score - score) < 1e-5


def test_a_sample_is_weighted_and_summed_without_copies():
    """What stays small as the sample grows is what a worker holds beside it; the numbers are the same."""
    import tracemalloc

    rng = np.random.default_rng(3)
    counts = rng.integers(0, 3, (1500, langid.DIMS)).astype(np.float32)
    weights = rng.random(langid.DIMS).astype(np.float32) + 1
    want = langid._unit(np.log1p(counts) * weights)
    wanted = np.flatnonzero(rng.random(1500) < 0.9)
    tracemalloc.start()
    langid._weighted(counts, weights)
    total = langid._total(counts, wanted)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(counts, want) and np.array_equal(total, want[wanted].sum(axis=0))
    assert peak < 0.8 * counts.nbytes
