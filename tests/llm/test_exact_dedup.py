import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from citemill.llm import exact_dedup


def want(rows):
    def norm(t):
        return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")

    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    found = []
    for i, t in rows:
        ids = groups[norm(t)]
        least = min((x for x in ids if x is not None), default=None)
        found.append((i, least, len(ids), i == least, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(found, key=repr)


def table(spark, rows, parts=9):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


def rows():
    r = random.Random(2)
    made = [(n, r.choice(("a", "b ", "b\n", "c c", "c\t\tc", "é"))) for n in range(300)]
    made += [(1000 + n, "hot  text") for n in range(200)]  # a third of all rows
    return made + [(5000, None), (5001, ""), (5002, " "), (5003, "x" * 200_000), (None, "hot text"), (None, "lone")]


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.pmod(F.length(c), F.lit(3)).cast("string")])
def test_groups_equal_brute_force(spark, digest):
    """A digest that hardly tells texts apart changes nothing."""
    found = exact_dedup.exact_groups(table(spark, rows()), digest=digest).drop("digest")
    got = sorted((tuple(x) for x in found.collect()), key=repr)
    assert got == [x[:4] for x in want(rows())]


def test_digest_is_of_the_normalised_text(spark):
    got = exact_dedup.exact_groups(table(spark, rows())).collect()
    assert sorted((tuple(x) for x in got), key=repr) == want(rows())


def test_repeats_empty_tables_and_other_columns(spark):
    twice = table(spark, [(1, "t"), (1, "t"), (2, "t")]).withColumns({"digest": F.lit(0), "keep_id": F.lit("k")})
    got = exact_dedup.exact_groups(twice).collect()
    assert sorted((x.doc_id, x.keep_id, x.group_size, x.kept) for x in got) == [
        (1, 1, 3, True), (1, 1, 3, True), (2, 1, 3, False)
    ]
    assert exact_dedup.exact_groups(table(spark, rows()).limit(0)).isEmpty()
