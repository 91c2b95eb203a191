import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from citemill.llm import common, queries
from tests.llm.test_exact_dedup import want as exact_want
from tests.llm.test_simhash import fingerprint, sets
from tests.llm.test_suffix_dedup import brute
from tools.check_oracles import rows as comparable

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, small, tmp_path_factory):
    """Some given documents, copies, near copies, passages that recur, and odd rows."""
    given = spark.read.parquet(f"{small}/documents.parquet").filter("length(text) < 1500").limit(60).collect()
    r, rows = random.Random(1), [(x.doc_id, x.text, x.lang, x.source, x.n_chars) for x in given]
    passage = " ".join(r.choice(given[3].text.split()) for _ in range(70))
    for k, x in enumerate(given[:12]):
        words = x.text.split()
        words[len(words) // 2] = "changed"
        rows.append((10_000 + k, x.text.replace(" ", "\n", 1), x.lang, "copy", 0))
        rows.append((20_000 + k, " ".join(words), x.lang, "near", 0))
        rows.append((30_000 + k, f"{k} {x.text[:200]} {passage} {k}", None, "passage", 0))
    rows += [(40_000, None, "en", None, None), (40_001, "", "en", None, 0), (40_002, "123 456", None, None, 7)]
    path = tmp_path_factory.mktemp("tables")
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_stages_equal_brute_force(spark, folder):
    docs = common.documents(spark, folder)
    before = {x.doc_id: x for x in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "exact", "near", "repeats", "pack"]

    def then(name):
        nonlocal docs
        docs = common.stored(stages[name](spark, docs, folder), name)
        if name != "pack":
            assert docs.columns == COLUMNS
        return docs.collect()

    kept = {x.doc_id: x for x in then("language")}
    assert set(before) - set(kept) == {40_000, 40_001, 40_002}
    assert all(x.text == before[k].text and x.lang for k, x in kept.items())

    want = {x[0] for x in exact_want([(k, x.text) for k, x in kept.items()]) if x[3]}
    kept = {x.doc_id: x for x in then("exact")}
    assert set(kept) == want

    prints = {k: fingerprint(x.text) for k, x in kept.items()}
    links = [(a, b) for a in prints for b in prints if (prints[a] ^ prints[b]).bit_count() <= 4]
    want = {k for k, label in sets(links).items() if k == label}
    kept = {x.doc_id: x for x in then("near")}
    assert set(kept) == want

    ids = sorted(kept)
    report = dict(zip(ids, brute([kept[k].text.encode() for k in ids])))
    kept = {x.doc_id: x for x in then("repeats")}
    assert set(kept) == set(ids)
    assert any(report[k][1] for k in ids)
    for k, x in kept.items():
        removed, size = report[k][1], report[k][0]
        assert abs(len(x.text.encode()) - (size - removed)) <= 6 * report[k][2]  # parts of characters
        assert x.n_chars == len(x.text)

    packed = then("pack")
    assert {x.doc_id for x in packed} == set(kept)
    bins = {}
    for x in packed:
        bins.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= queries.SEQUENCE


def test_run_and_empty_table(spark, folder, tmp_path):
    found = corpus_pipeline.run(spark, folder)
    assert found.columns[:2] == ["doc_id", "piece"] and found.count() > 50
    common.documents(spark, folder).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()


def test_repeated_rows_null_ids_and_other_columns(spark):
    rows = [(1, "one two three four five."), (1, "one two three four five."), (None, "quite other words in this text."),
            (None, "one two three four five.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'en' lang", "'s' source", "0L n_chars", "'d' digest", "'r' _row"
    )
    exact = corpus_pipeline.exact(spark, docs, "")
    assert exact.columns == docs.columns and exact.count() == 2
    near = corpus_pipeline.near(spark, exact, "")
    assert near.columns == docs.columns and near.count() == 2


def test_registered(small):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) & set(queries.QUERIES)))
def test_query_equals_sql(spark, small, name):
    import duckdb

    db = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    got = queries.QUERIES[name](spark, small).toPandas()
    want = db.execute(contract.oracle_sql()[name]).df()
    assert comparable(got) == comparable(want) and len(got)


# Hard negatives are found for some rows only; their rows are compared with SQL above.
@pytest.mark.parametrize("name", sorted(n for n in queries.QUERIES if not n.startswith("op12")))
def test_every_row_of_the_table(spark, small, name):
    table, column = ("pages", "page_id") if name[2:].split("_")[0] in ("4", "9") else ("documents", "doc_id")
    given = spark.read.parquet(f"{small}/{table}.parquet")
    found = queries.QUERIES[name](spark, small)
    if name.startswith("op9"):
        assert found.count() == 2 * given.count()
    elif name.startswith("op10"):
        assert found.select(column).distinct().count() == given.count()
    else:
        assert found.count() == given.count() == found.select(column).distinct().count()
