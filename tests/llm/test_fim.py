import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from citemill.llm import fim, queries


def plainly(number, text, cutting):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if cutting.unit == "line" else list(text)
    digest = hashlib.sha256(f"{cutting.seed}:{'' if number is None else number}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    one, two = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:one]), "".join(units[one:two]), "".join(units[two:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= cutting.rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < cutting.spm_rate:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    r = random.Random(2)
    bank = ["word ", "é", "中文", "😀", "\n", "\n\n", "<", ">", "<P", "S>", "M", "\r", " ", "x\n", "\x00"]
    made = ["".join(r.choice(bank) for _ in range(r.randrange(0, 50))) for _ in range(400)]
    return [*made, None, "", "\n", "a", "é", "<M>", "a<P>b\n", "one\ntwo", "中\n" * 30_000, "x" * 100_000, "<", "<P", "P>"]


@pytest.mark.parametrize("cutting", [fim.Cutting(), fim.Cutting("character", 70, 20, 3), fim.Cutting("line", 0), fim.Cutting(spm_rate=100)])
def test_forms_and_outputs_equal_plain_cutting(spark, cutting):
    rows = [(None if k % 50 == 3 else k, k, t) for k, t in enumerate(texts())]
    frame = spark.createDataFrame(rows, "doc_id long, k long, text string").repartition(3)
    made = fim.transform(frame, cutting).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    found = made.collect()
    assert len(found) == len(rows)
    for x in found:
        want = plainly(rows[x.k][0], rows[x.k][2], cutting)
        assert (x.n, x.form, x.prefix_chars, x.middle_chars, x.output) == want, rows[x.k]
        assert x.back == (rows[x.k][2] or "")
    assert {x.form for x in found} <= {"plain", "psm", "spm"}


def test_cuts_are_converted_both_ways():
    text = "aé中b😀\ncé"
    known = fim.Exceptions(np.frombuffer(text.encode(), np.uint8))
    places = [len(text[:k].encode()) for k in range(len(text) + 1)]
    assert known.to_bytes(np.arange(len(text) + 1)).tolist() == places
    assert known.to_characters(np.array(places)).tolist() == list(range(len(text) + 1))
    assert len(known.at) == 4


def test_query_equals_plain_cutting(spark, small):
    found = {x.doc_id: x for x in queries.op11_fill_in_middle(spark, small).collect()}
    given = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(found) == len(given)
    for d in given:
        x, want = found[d.doc_id], plainly(d.doc_id, d.text, fim.Cutting())
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert (x.n, x.form, x.prefix_chars, x.middle_chars) == want[:4]
        assert (x.output_sha256, x.restored_sha256) == (sha(want[4]), sha(d.text))


def test_names_repeats_bytes_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, "a\nb", 5, "x")] * 2, "doc_id long, text string, n long, body string")
    twice = fim.transform(frame).collect()
    assert twice[0] == twice[1] and twice[0].n == 2 and twice[0].body == "x"
    assert fim.transform(frame.limit(0)).isEmpty()
    odd = spark.sql("select 1L doc_id, cast(unhex('61ff0a62c3') as string) as text")
    made = fim.transform(odd).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    assert made.filter("cast(back as binary) = cast(text as binary)").count() == 1
    with pytest.raises(ValueError):
        fim.Cutting("word")
