"""One document holds a third of all rows: results stay whole and joins are split."""

import pytest
from pyspark.sql import functions as F

from citemill.operators import tables as tb
from citemill.sources import lake

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
ROWS = 60_000


@pytest.fixture
def large(spark):
    """Settings under which these few rows are treated as a large cluster treats many."""
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def chunks(spark):
    doc = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500)
    return spark.range(0, ROWS, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("chunk_id"),
        doc.cast("string").alias("doc_id"),
        F.col("id").cast("int").alias("chunk_index"),
        F.lit("x").alias("chunking_strategy"),
        (F.col("id") % 2 + 1).alias("snapshot_id"),
    )


@pytest.fixture
def documents(spark):
    return spark.range(500).selectExpr(
        "string(id) doc_id", "concat('f', id % 7) filename", "string(id) content",
        "id file_size", "1L snapshot_id",
    )


def plan_after_run(df, capsys):
    rows = df.collect()
    capsys.readouterr()
    df.explain("simple")
    return rows, capsys.readouterr().out


def test_lineage(spark, large, chunks, documents, capsys):
    log = spark.sql("select 1L snapshot_id, timestamp'2024-01-01' committed_at, 'append' operation")
    rows, plan = plan_after_run(tb.lineage(chunks, documents, log), capsys)
    assert len(rows) == ROWS and len({r.chunk_id for r in rows}) == ROWS
    assert all(r.file_hash and r.operation == "append" for r in rows)
    assert "SortMergeJoin(skew=true)" in plan


def test_current_rows(spark, large, chunks, capsys):
    # Two thirds of the documents come again with snapshot 2; the hot one does so too.
    rows, plan = plan_after_run(lake.current(chunks, base=1), capsys)
    newest = {}
    for r in chunks.collect():
        newest[r.doc_id] = max(newest.get(r.doc_id, 0), r.snapshot_id)
    want = {r.chunk_id for r in chunks.collect() if r.snapshot_id == newest[r.doc_id]}
    assert {r.chunk_id for r in rows} == want and len(rows) == len(want)
    assert "SortMergeJoin(skew=true)" in plan


def test_chunks_without_vector(spark, large, chunks):
    done = chunks.filter(F.col("chunk_index") % 4 > 0)
    missing = tb.missing_embeddings(chunks, done)
    assert missing.count() == ROWS // 4


def test_counts(spark, large, chunks, documents):
    doubled = documents.unionByName(documents.filter("doc_id = '0'"))
    rows = {r.filename: r.num_chunks for r in tb.chunks_per_filename(chunks, doubled).collect()}
    joined = chunks.join(doubled, "doc_id").groupBy("filename").count()
    assert rows == {r.filename: r["count"] for r in joined.collect()}
    per_document = tb.chunks_per_document(documents, chunks).agg(F.sum("num_chunks")).first()[0]
    assert per_document == ROWS


def test_one_snapshot_brought_most_documents(spark, large, capsys):
    """The only join here is that of documents with the log."""
    many = spark.range(0, ROWS, 1, 8).selectExpr(
        "string(id) doc_id", "string(id) content", "if(id % 5 = 0, id % 7 + 2, 1L) snapshot_id"
    )
    log = spark.range(1, 9).selectExpr("id snapshot_id", "timestamp'2024-01-01' committed_at", "'append' operation")
    rows, plan = plan_after_run(tb._with_commit(many, log), capsys)
    assert len(rows) == ROWS and all(r.operation == "append" for r in rows)
    assert plan.split("Initial Plan")[0].count("Join") == 1 and "SortMergeJoin(skew=true)" in plan
