"""What the plans must look like: no needless shuffle, no product, pruned scans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from citemill.operators import chunk, embed, metrics as mt, search, tables as tb, validate as val
from citemill.plans import pipeline
from citemill.plans.queries import QUERIES
from citemill.sources import lake, tables


@pytest.fixture
def plan(capsys):
    def text(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return text


@pytest.fixture(scope="module")
def documents(spark, small):
    scan = spark.read.parquet(f"{small}/documents.parquet")
    return scan.selectExpr("cast(doc_id as string) doc_id", "source filename", "text content", "lang")


@pytest.mark.parametrize(
    "step",
    [
        chunk.chunk_fixed,
        chunk.chunk_sentences,
        chunk.split_sentences,
        val.validate,
        tb.quality_checks,
        embed.hash_weights,
        lambda d: embed.embed_chunks(chunk.chunk_fixed(d)),
    ],
)
def test_row_wise_steps_do_not_shuffle(plan, documents, step):
    assert "Exchange" not in plan(step(documents))


def test_only_needed_columns_are_read(plan, documents):
    text = plan(chunk.chunk_fixed(documents))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    counted = plan(tb.chunks_per_filename(chunk.chunk_fixed(documents), documents))
    assert "lang" not in counted and counted.count("text:string") == 1


def test_search_shuffles_only_what_each_task_found(plan, documents, spark):
    asked = spark.createDataFrame([(1, "the of and")], "q_id bigint, query string")
    text = plan(pipeline.search_texts(asked, chunk.chunk_fixed(documents, carry=("filename",))))
    tree = text.split("\n(1)")[0]
    assert tree.count("Exchange") == 1 and tree.count("WindowGroupLimit") == 2
    assert tree.index("WindowGroupLimit") < tree.index("Exchange") < tree.rindex("WindowGroupLimit")
    assert tree.rindex("WindowGroupLimit") < tree.index("MapInArrow")


def test_newest_version_is_limited_before_the_shuffle(plan, documents):
    text = plan(tb.latest_version(documents.withColumn("created_at", F.current_timestamp())))
    assert "partial_max(" in text and "Window" not in text.split("\n(1)")[0]


def test_preview_takes_the_first_rows_without_a_full_sort(plan, documents):
    text = plan(tb.chunk_preview(chunk.chunk_fixed(documents)))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_snapshot_filter_prunes_partitions(plan, spark, tmp_path):
    table = lake.SnapshotTable(spark, str(tmp_path / "t"), spark.range(0).selectExpr("string(id) doc_id").schema)
    for n in range(3):
        table.commit(spark.range(3).selectExpr("string(id) doc_id"))
    text = plan(table.current())
    assert "PartitionFilters: [isnotnull(snapshot_id" in text
    assert "snapshot_id#" in text and "> 1)" in text


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream")))
def test_no_query_multiplies_tables(plan, spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_metrics_are_one_aggregate(plan, spark, small):
    tree = plan(mt.query_metrics(tables.query_events(spark, small))).split("\n(1)")[0]
    assert "Window" not in tree and "Sort" not in tree and tree.count("Scan") == 1


def test_points_of_sentence_chunks_take_one_python_stage(plan, documents):
    given = documents.withColumn("file_type", F.lit("txt"))
    made = pipeline.points(given, dt.datetime(2024, 1, 1), chunk.chunk_sentences)
    tree = plan(made).split("\n(1)")[0]
    assert tree.count("MapInArrow") == 1 and "EvalPython" not in tree and "Exchange" not in tree


def test_any_number_of_questions_reads_the_items_once(plan, documents, spark):
    asked = spark.range(300).selectExpr("id q_id", "concat('question ', id) query")
    chunks = chunk.chunk_fixed(documents, carry=("filename",))
    requests = pipeline.embed_queries(asked)
    lowered = chunks.withColumn("searched", F.lower("chunk_text"))
    found = search.top_k(
        requests, lowered, vector="searched", encoder=embed.hash_encoder, block_bytes=8 * 384 * 50
    )
    assert plan(found).split("\n(1)")[0].count("Scan parquet") == 1
