import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from citemill.llm import warc

RECORDS = "record_id long, url string, captured timestamp, status int, headers map<string,string>, body string"


def at(minute):
    return datetime(2026, 1, 1, minute // 60, minute % 60)


@pytest.mark.parametrize(
    "url,want",
    [
        ("HTTP://User@WWW.Example.com:80/a/?utm_source=x&b=2&a=1#top", "example.com/a?a=1&b=2"),
        ("https://example.com:443", "example.com/"),
        ("http://example.com:8080/x//", "example.com:8080/x"),
        ("//Example.com/A?REF=1&b", "example.com/A?b"),
        ("  urn:some thing ", "urn:some thing"),
        ("", ""),
        (None, None),
    ],
)
def test_canonical_url(spark, url, want):
    frame = spark.createDataFrame([(url,)], "u string")
    assert frame.select(warc.canonical_url(F.col("u"))).first()[0] == want


def test_records_are_parsed(spark):
    block = (
        "WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: http://a.b/c\r\n\r\n"
        "HTTP/1.1 200 OK\r\nETag: \"x\"\r\nVia: a\r\nvia:  b: c \r\nbroken\r\n\r\nbody\r\n\r\nmore"
    )
    frame = spark.createDataFrame([(1, block, 9), (2, None, 9), (3, "", 9), (4, "WARC/1.0", 9)], "id long, record string, status long")
    got = {x.id: x for x in warc.parse_records(frame).collect()}
    assert got[1].warc == {"warc-type": "response", "warc-target-uri": "http://a.b/c"}
    assert (got[1].status, got[1].headers) == (200, {"etag": '"x"', "via": "a, b: c"})
    assert got[1].body == "body\r\n\r\nmore"
    assert all(got[k].status is None and got[k].headers == {} and got[k].body is None for k in (2, 3, 4))


@pytest.mark.parametrize("batch", [10_000, 7])
def test_latest_before_equals_brute_force(spark, batch):
    """Most rows under one key, in many tasks and small batches; times tie."""
    r = random.Random(5)
    rows = [(r.choice(["hot"] * 6 + list("abcd")), r.randrange(300), n, r.random() < 0.05) for n in range(1500)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame([*rows, (None, 1, 9000, True), ("a", None, 9001, False)], "key string, time long, id long, full boolean")
        got = {x.id: x.match for x in warc.latest_before(frame).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = {}
    for key, time, n, full in rows:
        if not full:
            earlier = [(t, i) for k, t, i, f in rows if k == key and f and t < time]
            want[n] = max(earlier)[1] if earlier else None
    assert got == want


def test_validators_and_headers(spark):
    old = {"etag": '"1"', "last-modified": "mon", "content-type": "text/html", "server": "a", "content-length": "5"}
    rows = [
        (1, "http://x/p", at(1), 200, old, "first"),
        (2, "http://x/p#f", at(2), 304, {"etag": 'W/"1"', "server": "b", "content-length": "0", "connection": "close", "age": "1"}, None),
        (3, "http://x/p", at(3), 304, {"etag": '"2"', "last-modified": "mon"}, None),
        (4, "http://x/p", at(4), 304, {"last-modified": "mon"}, None),
        (5, "http://x/p", at(5), 304, {"last-modified": "tue"}, None),
        (6, "http://x/p", at(6), 304, {}, None),
        (7, "http://x/p", at(7), 200, {}, "second"),
        (8, "http://x/p", at(8), 304, {"server": "c"}, None),
        (9, "http://x/p", at(1), 304, {"etag": '"1"'}, None),
        (10, "http://y/", at(9), 304, {}, None),
        (11, "http://x/p", at(9), 404, {}, "gone"),
        (12, None, at(9), 304, {}, None),
        (13, "http://x/p", None, 304, {}, None),
        (14, "http://x/p", at(9), None, None, None),
    ]
    frame = spark.createDataFrame(rows, RECORDS).withColumn("match", F.lit("extra"))
    got = {x.record_id: x for x in warc.resolve_revisits(frame).collect()}
    outcomes = {k: (x.outcome, x.refers_to) for k, x in got.items()}
    missing, mismatch = ("no_earlier_response", None), ("validator_mismatch", None)
    assert outcomes == {
        1: ("full", None), 2: ("resolved", 1), 3: mismatch, 4: ("resolved", 1), 5: mismatch, 6: mismatch,
        7: ("full", None), 8: ("resolved", 7), 9: missing, 10: missing, 11: ("other", None), 12: missing, 13: missing,
        14: ("other", None),
    }
    assert got[2].headers == {
        "etag": 'W/"1"', "last-modified": "mon", "content-type": "text/html", "server": "b", "content-length": "5", "age": "1"
    }
    assert (got[2].body, got[8].body, got[3].body) == ("first", "second", None)
    assert got[8].headers == {"server": "c"}


def test_empty_table(spark):
    assert warc.resolve_revisits(spark.createDataFrame([], RECORDS)).isEmpty()


def test_the_type_of_a_record_decides(spark):
    rows = [
        (1, "http://x/p", at(1), 200, {"etag": "1", "server": "a"}, "first", "response", "sha1:A"),
        (2, "http://x/p", at(2), 200, {"server": "b"}, "", "revisit", "sha1:A"),  # identical payload digest
        (3, "http://x/p", at(3), 304, {"etag": "1"}, None, "Revisit", None),
        (4, "http://x/p", at(4), 200, {"server": "c"}, "", "revisit", "sha1:B"),
        (5, "http://x/p", at(5), 200, {"etag": "1"}, "", "revisit", None),
        (6, "http://x/p", at(6), 200, {}, "asked", "request", None),
        (7, "http://x/p", at(7), 304, {"etag": "1"}, None, None, None),
        (8, "http://x/p", at(8), None, {"etag": "1"}, None, "revisit", None),
        (9, "http://x/p", at(9), 304, {"etag": "2"}, None, "revisit", "sha1:A"),
        (10, "http://x/p", at(10), 200, {"etag": "2"}, "second", None, None),
        (11, "http://x/p", at(11), 304, {"etag": "2"}, None, "revisit", None),
    ]
    frame = spark.createDataFrame(rows, RECORDS + ", kind string, payload_digest string")
    got = {x.record_id: (x.outcome, x.refers_to, x.body) for x in warc.resolve_revisits(frame).collect()}
    assert got == {
        1: ("full", None, "first"), 2: ("resolved", 1, "first"), 3: ("resolved", 1, "first"),
        4: ("validator_mismatch", None, ""), 5: ("resolved", 1, "first"), 6: ("other", None, "asked"),
        7: ("resolved", 1, "first"), 8: ("resolved", 1, "first"), 9: ("validator_mismatch", None, None),
        10: ("full", None, "second"), 11: ("resolved", 10, "second"),
    }
