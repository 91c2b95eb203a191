from citemill.operators import context as ctx, tables as tb, validate as val

HITS = "q_id bigint, rk int, score double, chunk_id string, filename string, chunk_index int, text string"
ASKED = [(1, "why?"), (2, "where?")]


def hits(spark):
    rows = [(1, 2, 0.7, "c2", None, None, "b"), (1, 1, 0.9, "c1", "f.txt", 4, "a")]
    return spark.createDataFrame(rows, HITS)


def test_context(spark):
    row = ctx.context(hits(spark)).first()
    assert row.context == "[Source 1]\na\n\n[Source 2]\nb" and row.num_sources == 2


def test_sources_have_defaults(spark):
    rows = {r.rk: r for r in ctx.sources(hits(spark)).collect()}
    assert (rows[1].filename, rows[1].chunk_index, rows[1].text) == ("f.txt", 4, "a...")
    assert (rows[2].filename, rows[2].chunk_index, rows[2].text) == ("unknown", 0, "b...")


def test_prompt_and_answer_without_hits(spark):
    asked = spark.createDataFrame(ASKED, "q_id bigint, query string")
    rows = {r.q_id: r for r in ctx.prompts(asked, hits(spark)).collect()}
    assert rows[1].answer is None and rows[1].confidence_level == "HIGH"
    assert rows[1].user_prompt == (
        "Context from documents:\n\n[Source 1]\na\n\n[Source 2]\nb\n\nQuestion: why?\n\n"
        "Answer the question using ONLY the context above. Be specific and cite sources."
    )
    assert rows[2].answer == "No relevant documents found." and rows[2].num_sources == 0
    assert rows[2].user_prompt is None and rows[2].system_prompt is None


def test_percent_signs_in_texts_are_kept(spark):
    odd = spark.createDataFrame([(1, 1, 0.9, "c", "f", 0, "100% %s %d")], HITS)
    assert ctx.context(odd).first().context == "[Source 1]\n100% %s %d"
    asked = spark.createDataFrame([(1, "50% or %s?")], "q_id bigint, query string")
    assert "Question: 50% or %s?" in ctx.prompts(asked, odd).first().user_prompt


def test_envelopes(spark):
    asked = spark.createDataFrame(ASKED, "q_id bigint, query string")
    rows = {r.q_id: r for r in ctx.envelopes(asked, hits(spark), spark.range(7)).collect()}
    assert [h.chunk_id for h in rows[1].results] == ["c1", "c2"] and rows[1].num_results == 2
    assert rows[2].results is None and rows[2].num_results == 0
    assert rows[2].total_documents == 7


def test_request_bounds(spark):
    rows = [
        ("q", 1, 0.0, None), ("q", 20, 1.0, None), ("q", 3, None, None), ("", 3, 0.5, "empty_query"),
        (None, 3, 0.5, "empty_query"), ("q", 0, 0.5, "top_k_out_of_range"),
        ("q", 21, 0.5, "top_k_out_of_range"), ("q", 3, 1.1, "min_score_out_of_range"),
        ("q", 3, -0.1, "min_score_out_of_range"),
    ]
    df = spark.createDataFrame(rows, "query string, top_k int, min_score double, want string")
    for row in val.check_queries(df).collect():
        assert row.reject_reason == row.want, row


def test_request_defaults(spark):
    df = spark.createDataFrame([(None, None), (7, 0.1)], "top_k int, min_score double")
    assert sorted(map(tuple, val.request_defaults(df).collect())) == [(3, 0.5), (7, 0.1)]


def test_vector_contract(spark):
    rows = [([1.0, 2.0], None), ([0.0, 0.0], "empty_embedding"), (None, "empty_embedding"),
            ([1.0], "wrong_dimension"), ([1.0, None], "null_element")]
    df = spark.createDataFrame(rows, "embedding array<float>, want string")
    for row in val.check_vectors(df, 2).collect():
        assert row.reject_reason == row.want, row


def test_validation(spark):
    rows = [("a.txt", "123456789", "too_short"), ("a.txt", "1234567890", None),
            ("a.TXT", "1234567890", None), ("a.csv", "1234567890", "unsupported_type"),
            ("a.pdf", "1234567890", "unsupported_parser"), ("txt", "1234567890", "unsupported_type"),
            ("a.md", " \n\t" * 5, "no_chunks"), ("a.md", None, "too_short")]
    df = spark.createDataFrame(rows, "filename string, content string, want string")
    for row in val.validate(df).collect():
        assert row.reject_reason == row.want, row


def test_lineage_of_unknown_documents_is_null(spark):
    found = spark.createDataFrame([(1, 1, "c1", "d1"), (1, 2, "c2", "gone")],
                                  "q_id bigint, rk int, chunk_id string, doc_id string")
    documents = spark.createDataFrame([("d1", "f.txt", 3, "abc", 5)],
                                      "doc_id string, filename string, file_size bigint, content string, snapshot_id bigint")
    log = spark.sql("select 5L snapshot_id, timestamp'2024-01-05' committed_at, 'append' operation")
    rows = {r.chunk_id: r.data_lineage for r in tb.hits_with_lineage(found, documents, log).collect()}
    assert rows["c2"] is None
    assert rows["c1"].source_file == "f.txt" and rows["c1"].operation == "append"
    chunks = found.selectExpr("chunk_id", "doc_id", "0 chunk_index", "'x' chunking_strategy")
    full = {r.chunk_id: r for r in tb.lineage(chunks, documents, log).collect()}
    assert full["c2"].snapshot_id is None and full["c1"].snapshot_id == 5
