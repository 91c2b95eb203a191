import hashlib

from pyspark.sql import functions as F

from citemill.functions import ids, scores, text as tx


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expression(F.col("c"))).first()[0]


def test_strip_removes_what_python_strips(spark):
    edges = [chr(i) for i in range(0x3100) if not 0xD800 <= i < 0xE000]
    rows = [(i, c + "x" + c) for i, c in enumerate(edges)]
    found = spark.createDataFrame(rows, "i int, c string").select("i", tx.strip(F.col("c")))
    for i, stripped in found.collect():
        assert stripped == (edges[i] + "x" + edges[i]).strip()


def test_strip_markup(spark):
    assert one(spark, "<p>a &amp; <b>b</b></p> 1 < 2", tx.strip_markup) == "a &amp; b 1 < 2"


def test_previews(spark):
    assert one(spark, "hi", tx.source_preview) == "hi..."
    assert one(spark, "x" * 300, tx.source_preview) == "x" * 100 + "..."
    assert one(spark, "x" * 300, tx.preview) == "x" * 50


def test_file_types(spark):
    cases = {
        "/a/b/x.TXT": ("TXT", "txt"),
        "/a/b.c/x": ("", "c/x"),
        "x.tar.gz": ("gz", "gz"),
        ".hidden": ("", "hidden"),
        "a.": ("", ""),
        "plain": ("", "plain"),
    }
    for name, (loader, upload) in cases.items():
        assert one(spark, name, tx.loader_file_type) == loader, name
        assert one(spark, name, tx.upload_file_type) == upload, name


def test_universal_newlines(spark):
    assert one(spark, "a\r\nb\rc\nd", tx.universal_newlines) == "a\nb\nc\nd"


def test_quality(spark):
    assert one(spark, "One two. Three four five!", tx.words_per_sentence) == 2.5
    assert one(spark, "", tx.words_per_sentence) == 0.0
    assert one(spark, "write to a.b@example.com", tx.contains_pii) is True
    assert one(spark, "call +49 30 1234567 now", tx.contains_pii) is True
    assert one(spark, "a @ b, 12 34", tx.contains_pii) is False


def test_ids(spark):
    digest = hashlib.md5("größe.md".encode()).hexdigest()
    assert one(spark, "größe.md", ids.name_id) == digest[:16]
    assert one(spark, digest[:16], ids.point_id) == int(digest[:15], 16)
    assert one(spark, "f" * 16, ids.point_id) == 2**60 - 1


def test_confidence(spark):
    rows = [(0.8, "HIGH"), (0.7999999, "MEDIUM"), (0.6, "MEDIUM"), (0.5999999, "LOW"), (-1.0, "LOW")]
    for score, level in rows:
        assert one(spark, score, scores.confidence, "double") == level


def test_cosine(spark):
    rows = [([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), ([2.0, 0.0], [-3.0, 0.0])]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>")
    found = [r[0] for r in df.select(scores.cosine(F.col("a"), F.col("b"))).collect()]
    assert abs(found[0] - 0.5**0.5) < 1e-12 and found[1] is None and found[2] == -1.0
