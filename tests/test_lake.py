import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from citemill import schemas
from citemill.functions import ids
from citemill.operators import chunk, embed, tables as tb, validate as val
from citemill.plans import pipeline
from citemill.sources import lake
from citemill.sources.lake import SnapshotTable

ROW = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("v", T.LongType())])


def day(n):
    return dt.datetime(2024, 1, n, tzinfo=dt.timezone.utc)


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), ROW)


def values(df):
    return sorted((r.doc_id, r.v) for r in df.collect())


def test_history_of_a_table(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), ROW)
    assert values(table.read()) == []
    assert table.commit(rows(spark, ("a", 1), ("b", 1)), at=day(1)) == 1
    assert table.commit(rows(spark, ("a", 2)), at=day(2)) == 2
    assert table.commit(rows(spark, ("c", 3)), "overwrite", at=day(3)) == 3
    assert table.commit(rows(spark, ("d", 4)), at=day(4)) == 4

    assert values(table.read()) == [("c", 3), ("d", 4)]
    assert values(table.read(day(2))) == [("a", 1), ("a", 2), ("b", 1)]
    assert values(table.current(day(2))) == [("a", 2), ("b", 1)]
    assert values(table.read(day(3) - dt.timedelta(seconds=1))) == [("a", 1), ("a", 2), ("b", 1)]
    with pytest.raises(ValueError):
        table.read(day(1) - dt.timedelta(seconds=1))
    assert lake.latest_snapshot(table.log()).first().snapshot_id == 4
    assert sorted(table.log().select("snapshot_id", "added_rows").collect()) == [
        (1, 2), (2, 1), (3, 1), (4, 1)
    ]
    for at in (None, day(2), day(4)):
        lazy = lake.as_of(table.rows(), table.log(), at)
        assert values(lazy) == values(table.read(at))


def test_upsert_leaves_no_old_rows_and_compaction_keeps_the_current_ones(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), ROW)
    table.commit(rows(spark, ("a", 1), ("a", 2), ("a", 3), ("b", 1)))
    table.commit(rows(spark, ("a", 9)))
    want = [("a", 9), ("b", 1)]
    assert values(table.current()) == want
    table.compact()
    assert values(table.read()) == want and values(table.current()) == want


def test_unlogged_data_are_invisible_and_replaced(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), ROW)
    table.commit(rows(spark, ("a", 1)))
    rows(spark, ("x", 0)).write.parquet(str(tmp_path / "t/data/snapshot_id=2"))
    assert values(table.read()) == [("a", 1)]
    assert table.commit(rows(spark, ("b", 2))) == 2
    assert values(table.read()) == [("a", 1), ("b", 2)]


def test_a_batch_of_a_stream_is_written_once(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), ROW)
    assert table.commit(rows(spark, ("a", 1)), stream_id="s", batch_id=0) == 1
    assert table.commit(rows(spark, ("a", 1)), stream_id="s", batch_id=0) is None
    assert table.commit(rows(spark, ("b", 1)), stream_id="s", batch_id=1) == 2
    assert values(table.read()) == [("a", 1), ("b", 1)]


SAMPLES = [
    ("intro.md", "An engine reads rows. " * 12, "md"),
    ("guide.txt", "Tables keep their history. " * 9, "txt"),
    ("note.txt", "Short note on vectors.", "txt"),
]


def load_catalog(spark, tmp_path, database):
    location = str(tmp_path / database)
    for _ in range(2):
        names = lake.create_tables(spark, database, location)
    assert names == ["document_chunks", "embeddings_metadata", "raw_documents"]
    raw = spark.createDataFrame(SAMPLES, "filename string, content string, file_type string")
    documents = raw.withColumns(
        {
            "doc_id": ids.name_id(F.col("filename")),
            "file_size": F.length("content").cast("bigint"),
            "ingestion_date": F.lit(dt.date(2026, 2, 8)),
        }
    )
    lake.append(documents, f"{database}.raw_documents")
    stored = spark.table(f"{database}.raw_documents")
    pipeline.write_chunks(chunk.chunk_fixed(stored), day(1), f"{database}.document_chunks")
    return stored


def test_catalog_tables_answer_sql(spark, tmp_path):
    stored = load_catalog(spark, tmp_path, "lake_a")
    assert stored.schema["ingestion_date"].dataType == T.DateType()
    assert os.path.isdir(tmp_path / "lake_a/raw_documents/ingestion_date=2026-02-08")
    counts = spark.sql(
        """SELECT filename, COUNT(*) AS num_chunks FROM lake_a.document_chunks c
           JOIN lake_a.raw_documents d ON c.doc_id = d.doc_id GROUP BY filename"""
    )
    want = {name: len(range(0, len(text), 150)) for name, text, _ in SAMPLES}
    assert {r.filename: r.num_chunks for r in counts.collect()} == want
    api = tb.chunks_per_filename(spark.table("lake_a.document_chunks"), stored)
    assert {r.filename: r.num_chunks for r in api.collect()} == want
    preview = spark.sql(
        """SELECT chunk_id, doc_id, chunk_index, chunk_size, LEFT(chunk_text, 50) AS preview
           FROM lake_a.document_chunks ORDER BY doc_id, chunk_index LIMIT 10"""
    )
    shown = tb.chunk_preview(spark.table("lake_a.document_chunks"))
    assert preview.collect() == shown.collect()
    total = spark.sql("SELECT COUNT(*) AS cnt FROM lake_a.raw_documents").first().cnt
    summary = tb.lake_summary(stored, spark.table("lake_a.document_chunks")).first()
    assert (summary.total_documents, summary.total_chunks) == (total, sum(want.values()))


def test_append_and_overwrite_go_by_name(spark, tmp_path):
    load_catalog(spark, tmp_path, "lake_b")
    table = "lake_b.embeddings_metadata"
    made = embed.embed_chunks(spark.table("lake_b.document_chunks"))
    metadata = embed.embedding_metadata(made, embed.HASH_MODEL, created_at=day(1), snapshot_id=1)
    shuffled = metadata.select(*reversed(metadata.columns))
    lake.append(shuffled, table)
    n = metadata.count()
    lake.append(metadata, table)
    assert spark.table(table).count() == 2 * n
    lake.overwrite(shuffled, table)
    stored = spark.table(table)
    assert stored.schema == schemas.EMBEDDINGS_METADATA
    assert stored.count() == n and stored.first().embedding_model == embed.HASH_MODEL
    assert tb.missing_embeddings(spark.table("lake_b.document_chunks"), stored).isEmpty()
    checked = val.check_models(stored.limit(1).unionByName(
        stored.limit(1).withColumn("embedding_model", F.lit("homemade"))))
    assert {r.reject_reason for r in checked.collect()} == {None, "unknown_model"}


def test_reingest_replaces_the_collection_and_is_repeatable(spark, tmp_path, small):
    documents = spark.read.parquet(f"{small}/documents.parquet").selectExpr(
        "cast(doc_id as string) doc_id", "source filename", "text content", "'txt' file_type"
    )
    folder = str(tmp_path / "points")
    first = pipeline.reingest(documents, folder, "c", day(1)).first()
    store = SnapshotTable(spark, folder, pipeline.POINTS)
    before = store.read().drop("snapshot_id", "indexed_at")
    second = pipeline.reingest(documents, folder, "c", day(2)).first()
    after = store.read().drop("snapshot_id", "indexed_at")
    assert first == second and first.documents == 200 and first.chunks == 5884
    old = store.read(day(1)).drop("snapshot_id", "indexed_at")
    assert old.exceptAll(after).isEmpty() and after.exceptAll(old).isEmpty()
    assert after.select("point_id").distinct().count() == after.count() == before.count()


def test_two_writers_lose_nothing(spark, tmp_path):
    one = SnapshotTable(spark, str(tmp_path / "t"), ROW)
    two = SnapshotTable(spark, str(tmp_path / "t"), ROW)
    with ThreadPoolExecutor(4) as pool:
        jobs = [
            pool.submit((one, two)[n % 2].commit, rows(spark, (f"k{n}", n))) for n in range(6)
        ]
        numbers = [j.result() for j in jobs]
    assert sorted(numbers) == sorted(set(numbers))
    assert values(one.read()) == [(f"k{n}", n) for n in range(6)]


def test_what_a_failed_writer_left_is_never_read(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), ROW)
    table.commit(rows(spark, ("a", 1)))
    number = table._claim()
    rows(spark, ("lost", 0)).write.parquet(f"{tmp_path}/t/data/snapshot_id={number}")
    assert table.commit(rows(spark, ("b", 2))) == number + 1
    assert values(table.read()) == values(table.current()) == [("a", 1), ("b", 2)]


def test_as_of_shows_logged_snapshots_only(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), ROW)
    table.commit(rows(spark, ("a", 1)), at=day(1))
    lost = table._claim()
    rows(spark, ("lost", 0)).write.parquet(f"{tmp_path}/t/data/snapshot_id={lost}")
    table.commit(rows(spark, ("b", 2)), at=day(2))
    for at in (None, day(2)):
        assert values(lake.as_of(table.rows(), table.log(), at)) == [("a", 1), ("b", 2)]
        assert values(table.read(at)) == [("a", 1), ("b", 2)]


def test_a_commit_that_lands_late_is_not_in_earlier_reads(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), ROW)
    table.commit(rows(spark, ("a", 1)), at=day(1))
    slow = table._claim()
    table.commit(rows(spark, ("b", 3)), at=day(3))
    before = values(table.read(day(3)))
    table._write(rows(spark, ("slow", 9)), slow, "append", day(9))
    for read in (table.read, lambda at: lake.as_of(table.rows(), table.log(), at)):
        assert values(read(day(3))) == before == [("a", 1), ("b", 3)]
        assert values(read(day(9))) == [("a", 1), ("b", 3), ("slow", 9)]


def test_compaction_beside_appends_keeps_them(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), ROW)
    table.commit(rows(spark, ("a", 1), ("b", 1)), at=day(1))
    table.commit(rows(spark, ("a", 2)), at=day(2))
    slow = table._claim()
    claim = table._claim

    def meanwhile():  # another writer commits between the claim and the read
        number = claim()
        table._claim = claim
        table.commit(rows(spark, ("b", 5), ("c", 5)), at=day(3))
        return number

    table._claim = meanwhile
    table.compact(at=day(4))
    want = [("a", 2), ("b", 1), ("b", 5), ("c", 5)]
    assert values(table.read()) == want
    assert values(table.current()) == [("a", 2), ("b", 5), ("c", 5)]
    table._write(rows(spark, ("a", 7)), slow, "append", day(5))
    want = [("a", 7), ("b", 5), ("c", 5)]
    assert values(table.current()) == want
    assert values(lake.as_of(table.rows(), table.log(), day(2))) == [("a", 1), ("a", 2), ("b", 1)]
    table.compact(at=day(6))
    table.compact(at=day(7))
    assert values(table.read()) == values(table.current()) == want
    assert values(table.current(day(4))) == [("a", 2), ("b", 5), ("c", 5)]


def test_an_overwrite_beside_a_compaction_wins(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), ROW)
    table.commit(rows(spark, ("a", 1)), at=day(1))
    number = table._claim()
    table.compact(at=day(2))
    table._write(rows(spark, ("z", 1)), number, "overwrite", day(3))
    assert values(table.current()) == values(table.read()) == [("z", 1)]


def test_a_time_before_the_first_commit_is_an_error(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), ROW)
    table.commit(rows(spark, ("a", 1)), at=day(2))
    with pytest.raises(Exception, match="no snapshot at or before"):
        lake.as_of(table.rows(), table.log(), day(1)).collect()


def test_a_collection_keeps_to_what_it_declares(spark, tmp_path):
    folder = str(tmp_path / "points")
    store = pipeline.collection(spark, folder, 4)
    assert store.properties == {"dimension": "4", "metric": "cosine"}
    assert SnapshotTable(spark, folder, pipeline.POINTS).properties == store.properties
    for other in ({"dim": 5}, {"metric": "dot"}):
        with pytest.raises(ValueError):
            pipeline.collection(spark, folder, **{"dim": 4, **other})
    documents = spark.createDataFrame(
        [("d", "d.txt", "text", "txt")], "doc_id string, filename string, content string, file_type string"
    )
    for bad in (np.nan, np.inf):
        with pytest.raises(Exception, match="not_finite"):
            pipeline.upsert(documents, store, day(1), load=lambda: lambda t: np.full((len(t), 4), bad))
    assert store.log().isEmpty()
    pipeline.upsert(documents, store, day(1), load=lambda: lambda t: np.ones((len(t), 4)))
    assert pipeline.searchable(store).count() == 1


def test_every_reason_to_refuse_a_vector(spark):
    given = [None, [1.0], [1.0, None], [1.0, float("nan")], [float("-inf"), 1.0], [0.0, 0.0], [1.0, 2.0]]
    checked = val.check_vectors(spark.createDataFrame([(v,) for v in given], "embedding array<double>"), 2)
    assert [r.reject_reason for r in checked.collect()] == [
        "empty_embedding", "wrong_dimension", "null_element", "not_finite", "not_finite", "empty_embedding", None
    ]


def test_requests_are_checked_before_they_are_searched(spark):
    asked = spark.createDataFrame(
        [(1, "a text", None, None), (2, "", 3, 0.5), (3, "a text", 21, 0.5), (4, "a text", 1, 1.5)],
        "q_id bigint, query string, top_k int, min_score double",
    )
    documents = spark.createDataFrame([("d", f"a text number {n}", "f") for n in range(9)], "doc_id string, content string, filename string")
    chunks = chunk.chunk_fixed(documents, carry=("filename",))
    assert {r.q_id for r in pipeline.search_texts(asked, chunks).collect()} == {1}
    assert pipeline.search_texts(asked, chunks).count() == 3
    accepted, rejected = pipeline.check_requests(asked)
    assert {r.q_id: r.reject_reason for r in rejected.collect()} == {
        2: "empty_query", 3: "top_k_out_of_range", 4: "min_score_out_of_range"
    }


def test_vectors_of_a_collection_are_stored_as_bytes_and_read_as_lists(spark, tmp_path):
    store = pipeline.collection(spark, str(tmp_path / "c"), 2)
    row = {f.name: None for f in pipeline.POINTS} | {"doc_id": "d"}
    given = [[1.0, -2.5], None, [float("inf"), 0.0]]
    store.commit(spark.createDataFrame([tuple((row | {"embedding": v}).values()) for v in given], pipeline.POINTS))
    assert dict(store.rows(packed=True).dtypes)["embedding"] == "binary"
    for rows in (store.rows(), store.read(), store.current()):
        assert rows.schema["embedding"] == pipeline.POINTS["embedding"]
        assert sorted(map(str, (r.embedding for r in rows.collect()))) == sorted(map(str, given))
