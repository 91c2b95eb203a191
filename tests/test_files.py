import hashlib

import pytest
from pyspark.sql import functions as F

from citemill import schemas
from citemill.functions import ids
from citemill.operators import tables as tb, validate as val
from citemill.plans import pipeline
from citemill.sources import files
from citemill.sources.lake import SnapshotTable


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "docs"
    (root / "deep" / "er").mkdir(parents=True)
    (root / "a.txt").write_bytes(b"one line\r\nand another\rthird")
    (root / "deep" / "B.TXT").write_bytes("Grüße aus der Tiefe".encode())
    (root / "deep" / "er" / "c.md").write_bytes(b"# Title\n\nSome <b>markdown</b> text.")
    (root / "d.csv").write_bytes(b"not,for,us,at,all")
    (root / "e.pdf").write_bytes(b"%PDF-1.4 something binary")
    (root / "f.txt").write_bytes(b"\xff\xfe broken encoding")
    (root / "g.txt").write_bytes(b"nine char")
    (root / "h.txt").write_bytes(b"ten chars!")
    (root / "i.txt").write_bytes(b" " * 20)
    (root / "empty.txt").write_bytes(b"")
    (root / "noext").write_bytes(b"a file without a suffix")
    return root


def test_scan_and_load(spark, folder):
    rows = {r.filename: r for r in files.loaded(files.scan(spark, str(folder))).collect()}
    assert sorted(rows) == ["B.TXT", "a.txt", "c.md", "e.pdf", "f.txt", "g.txt", "h.txt", "i.txt"]
    reasons = {name: r.reject_reason for name, r in rows.items() if r.reject_reason}
    assert reasons == {
        "e.pdf": "unsupported_parser",
        "f.txt": "bad_encoding",
        "g.txt": "too_short",
        "i.txt": "no_chunks",
    }
    a, b, c = rows["a.txt"], rows["B.TXT"], rows["c.md"]
    assert a.content == "one line\nand another\nthird" and a.file_size == 27
    assert b.content == "Grüße aus der Tiefe" and b.file_size == 21 and b.file_type == "TXT"
    assert c.content == "# Title\n\nSome <b>markdown</b> text."
    path = str(folder / "a.txt")
    assert a.doc_id == hashlib.md5(path.encode()).hexdigest()[:16]
    made = files.loaded(files.scan(spark, str(folder))).drop("reject_reason").schema
    assert made.simpleString() == schemas.LOADED_DOCUMENT.simpleString()
    assert a.metadata == {"path": path, "extension": ".txt"} and a.created_at is not None


def test_upload_keeps_bytes_and_refuses_other_types(spark, folder):
    scanned = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(folder))
    rows = {r.filename: r for r in files.uploaded(scanned).collect()}
    assert rows["a.txt"].content == "one line\r\nand another\rthird"
    assert rows["B.TXT"].file_type == "txt" and rows["B.TXT"].reject_reason is None
    assert rows["B.TXT"].doc_id == hashlib.md5(b"B.TXT").hexdigest()[:16]
    assert rows["d.csv"].reject_reason == rows["noext"].reject_reason == "unsupported_type"
    accepted, rejected = val.split(files.uploaded(scanned))
    assert accepted.count() + rejected.count() == scanned.count() == 10
    assert "empty.txt" not in rows


def test_folder_to_collection(spark, folder, tmp_path):
    stats, rejected = pipeline.reingest_folder(
        spark, str(folder), str(tmp_path / "points"), "files", chunker=pipeline.chunk.chunk_fixed
    )
    row = stats.first()
    assert (row.status, row.documents, row.chunks, row.vectors) == ("success", 4, 4, 4)
    assert {r.filename for r in rejected.collect()} == {"e.pdf", "f.txt", "g.txt", "i.txt"}
    store = SnapshotTable(spark, str(tmp_path / "points"), pipeline.POINTS)
    asked = spark.createDataFrame([(1, "markdown text")], "q_id bigint, query string")
    hits = pipeline.search_points(pipeline.embed_queries(asked), pipeline.searchable(store))
    best = hits.filter("rk = 1").first()
    assert best.filename == "c.md" and best.file_type == "md" and best.score > 0.3


def test_upload_counts(spark, folder):
    accepted, _ = val.split(files.uploaded(files.scan(spark, str(folder))))
    cut = pipeline.chunk.chunk_fixed(accepted)
    rows = {r.filename: r for r in tb.upload_stats(accepted, cut).collect()}
    assert rows["h.txt"].chunks_created == 1 and rows["h.txt"].text_length == 10


def test_ids_are_independent_of_the_host_prefix(spark):
    paths = ["file:/x/a.txt", "file:///x/a.txt", "hdfs://host:9000/x/a.txt", "/x/a.txt"]
    made = spark.createDataFrame([(p,) for p in paths], "path string").selectExpr(
        "path", "cast('some text here' as binary) content", "14L length",
        "timestamp'2024-01-01' modificationTime",
    )
    want = spark.range(1).select(ids.name_id(F.lit("/x/a.txt"))).first()[0]
    assert {r.doc_id for r in files.loaded(made).collect()} == {want}
