import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from citemill.llm import simhash
from citemill.llm.components import components, unite


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def sets(links):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def texts():
    r = random.Random(6)
    bank = [f"w{k}" for k in range(400)] + ["Été", "Naïve", "中文"]
    made = [None, "", " \n", "One", "one", "A b C", "x " * 30_000]
    for _ in range(60):
        words = [r.choice(bank) for _ in range(r.choice((3, 5, 40, 300)))]
        made.append(" ".join(words))
        for _ in range(r.randrange(4)):
            copy = list(words)
            copy[r.randrange(len(copy))] = r.choice(bank)
            made.append("\t".join(copy))
    return made


@pytest.mark.parametrize("crowded", [2048, 3])
def test_components_equal_brute_force(spark, crowded):
    given = texts()
    frame = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(6)
    prints = [fingerprint(t) for t in given]
    links = [(a, b) for a in range(len(given)) for b in range(a + 1) if (prints[a] ^ prints[b]).bit_count() <= 4]
    want = sets(links)
    got = simhash.near_duplicates(frame.withColumn("fp", F.lit("x")), crowded=crowded).collect()
    assert sorted((x.doc_id, x.fingerprint, x.component_id) for x in got) == [
        (k, f"{p:016x}", want[k]) for k, p in enumerate(prints)
    ]


@pytest.mark.parametrize("crowded", [2048, 40, 4])
def test_links_connect_what_near_pairs_connect(spark, crowded):
    """A dense cloud of fingerprints, so that keys are crowded at every stage."""
    r = random.Random(9)
    centre = r.getrandbits(64)
    cloud = {centre ^ sum(1 << b for b in r.sample(range(64), r.choice((1, 2, 3, 5, 9)))) for _ in range(250)}
    cloud |= {r.getrandbits(64) for _ in range(100)}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in cloud)
    links = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"), crowded=crowded)
    got = sets([(x, x) for x in signed] + [(x.a, x.b) for x in links.collect()])
    bits = {x: x % (1 << 64) for x in signed}
    want = sets([(a, b) for a in signed for b in signed if (bits[a] ^ bits[b]).bit_count() <= 4])
    assert got == want


def test_components_of_any_shape(spark):
    r = random.Random(2)
    links = [(k, k + 1) for k in range(100)] + [(500, 500 + k) for k in range(1, 200)]
    links += [(r.randrange(1000, 1300), r.randrange(1000, 1300)) for _ in range(200)]
    links += [(7, 7), (None, 3), (3, None), (5, 4), (5, 4)]
    found = components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()
    want = sets([x for x in links if None not in x])
    assert {x.node: x.label for x in found} == {a: b for a, b in want.items() if a != b}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_unite():
    parent = np.arange(6)
    unite(parent, np.array([4, 2, 5]), np.array([2, 0, 3]))
    assert parent.tolist() == [0, 1, 0, 3, 0, 3]


def test_null_ids_repeats_and_empty_tables(spark):
    rows = [(None, "a b c d e"), (4, "a b c d e"), (4, "a b c d e"), (None, "quite another text of words")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((x.component_id is None, x.component_id) for x in simhash.near_duplicates(frame).collect())
    assert got == [(False, 4), (False, 4), (False, 4), (True, None)]
    assert simhash.near_duplicates(frame.limit(0)).isEmpty()
    with pytest.raises(ValueError):
        simhash.near_duplicates(frame, distance=3)
