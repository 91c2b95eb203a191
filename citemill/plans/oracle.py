"""The same queries in SQL, written independently of the Spark operators."""

from __future__ import annotations

# Fixed values, given here once more: nothing is taken from the code under test.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"[0-9][0-9 ().-]{7,}[0-9]"
SYSTEM_PROMPT = (
    "You are a helpful assistant that answers questions based ONLY on the provided context. \n"
    "                    If the context doesn't contain enough information, say so. \n"
    "                    Be concise and accurate. Cite source numbers when referencing information."
)
USER_PROMPT = (
    "Context from documents:\n\n%s\n\nQuestion: %s\n\n"
    "Answer the question using ONLY the context above. Be specific and cite sources."
)
CENTROID_MIN_SCORE, TEXT_MIN_SCORE = 0.3, 0.75
WS = (
    "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31)"
    " || chr(32) || chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194)"
    " || chr(8195) || chr(8196) || chr(8197) || chr(8198) || chr(8199) || chr(8200) || chr(8201)"
    " || chr(8202) || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288)"
)
WORDS_RE = f"'[' || {WS} || ']+'"

DOCS = """docs AS (
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, source AS filename, text AS content, lang
    FROM documents)"""


def _windows(name: str, size: int, overlap: int, docs: str = "docs", keep: bool = False) -> str:
    where = "" if keep else "WHERE chunk_text <> ''"
    return f"""{name} AS (
    SELECT substr(md5(doc_id || '-' || chunk_index), 1, 16) AS chunk_id, *,
        CAST(length(chunk_text) AS INTEGER) AS chunk_size,
        'fixed-{size}-overlap-{overlap}' AS chunking_strategy
    FROM (
        SELECT doc_id, filename, chunk_text,
            CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS chunk_index
        FROM (
            SELECT doc_id, filename, pos,
                trim(substr(content, pos + 1, {size}), {WS}) AS chunk_text
            FROM (
                SELECT doc_id, filename, content,
                    unnest(range(0, length(content), {size - overlap})) AS pos
                FROM {docs}))
        {where}))"""


BLANKED = """docs AS (
    SELECT CAST(page_id AS VARCHAR) AS doc_id, url AS filename,
        regexp_replace(regexp_replace(html, '<script.*?</script>|<[^<>]*>',
            repeat(' ', 40), 'g'), '[&%$#*!]', ' ', 'g') AS content
    FROM pages)"""
CHUNKS = f"{DOCS}, {_windows('chunks', 200, 50)}"
CHUNK_COLUMNS = "chunk_id, doc_id, chunk_index, chunk_text, chunk_size, chunking_strategy"

SENTENCES = f"""sentences AS (
    SELECT doc_id, list_filter(
        list_transform(string_split_regex(content, '[.!?]+'), lambda s: trim(s, {WS})),
        lambda s: s <> '') AS ss
    FROM docs)"""


def smart(size: int, overlap: int) -> str:
    """Sentence chunks by a recursive query: one step for each sentence."""
    tail = f"""array_to_string(list_filter(
                string_split_regex(cur, {WORDS_RE}), lambda w: w <> '')[-{overlap}:], ' ')"""
    return f"""WITH RECURSIVE {DOCS}, {SENTENCES},
fold(doc_id, i, cur, emit) AS (
    SELECT doc_id, 0, CAST('' AS VARCHAR), CAST(NULL AS VARCHAR) FROM sentences WHERE len(ss) > 0
    UNION ALL
    SELECT doc_id, i + 1,
        CASE WHEN length(cur) + length(ss[i + 1]) <= {size} THEN cur || ' ' || ss[i + 1]
             WHEN cur = '' THEN ss[i + 1]
             ELSE {tail} || ' ' || ss[i + 1] END,
        CASE WHEN length(cur) + length(ss[i + 1]) > {size} AND cur <> '' THEN cur END
    FROM fold JOIN sentences USING (doc_id) WHERE i < len(ss)),
closed AS (
    SELECT doc_id, i, emit AS cur FROM fold WHERE emit IS NOT NULL
    UNION ALL
    SELECT doc_id, i + 1, cur FROM fold JOIN sentences USING (doc_id) WHERE i = len(ss)),
smart AS (
    SELECT substr(md5(doc_id || '-' || chunk_index), 1, 16) AS chunk_id, *,
        'smart-{size}-overlap-{overlap}' AS chunking_strategy
    FROM (
        SELECT doc_id,
            CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS chunk_index,
            trim(cur, {WS}) AS chunk_text, CAST(length(cur) AS INTEGER) AS chunk_size
        FROM closed))"""


SMART = smart(500, 100)


def _weights(name: str, key: str, text: str, table: str) -> str:
    return f"""{name} AS (
    SELECT {key}, CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % 384 AS dim,
        CAST(sum(CASE WHEN substr(h, 9, 1) < '8' THEN 1 ELSE -1 END) AS BIGINT) AS weight
    FROM (
        SELECT {key}, md5(token) AS h FROM (
            SELECT {key}, unnest(string_split_regex(lower({text}), '[^a-z0-9]+')) AS token
            FROM {table})
        WHERE token <> '')
    GROUP BY ALL)"""


SEARCH = f"""questions AS (SELECT item_id AS q_id, text AS query FROM benchmark),
{_weights('cw', 'chunk_id', 'chunk_text', 'chunks')},
{_weights('qw', 'q_id', 'query', 'questions')},
cn AS (SELECT chunk_id, sqrt(CAST(sum(weight * weight) AS DOUBLE)) AS norm FROM cw GROUP BY 1),
qn AS (SELECT q_id, sqrt(CAST(sum(weight * weight) AS DOUBLE)) AS norm FROM qw GROUP BY 1),
dots AS (
    SELECT q_id, chunk_id, CAST(sum(qw.weight * cw.weight) AS DOUBLE) AS dot
    FROM qw JOIN cw USING (dim) GROUP BY 1, 2),
scored AS (
    SELECT q_id, chunk_id, dot / (qn.norm * cn.norm) AS score
    FROM dots JOIN qn USING (q_id) JOIN cn USING (chunk_id)
    WHERE qn.norm > 0 AND cn.norm > 0),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY q_id ORDER BY score DESC, chunk_id)
        AS INTEGER) AS rk
    FROM scored),
hits AS (
    SELECT q_id, rk, score, chunk_id, doc_id, chunk_index, filename, chunk_text AS text
    FROM ranked JOIN chunks USING (chunk_id))"""
HITS = f"{CHUNKS}, {SEARCH}"

CONTEXT = """SELECT q_id, count(*) AS num_sources,
    string_agg('[Source ' || rk || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY rk)
        AS context"""

CENTROIDS = """means AS (
    SELECT label, list(v ORDER BY pos) AS mean FROM (
        SELECT label, pos, avg(CAST(v AS DOUBLE)) AS v FROM (
            SELECT label, unnest(embedding) AS v, unnest(range(64)) AS pos FROM embeddings)
        GROUP BY 1, 2)
    GROUP BY 1)"""


def _nearest(top_k: int, min_score: float) -> str:
    return f"""WITH {CENTROIDS},
scored AS (
    SELECT CAST(m.label AS BIGINT) AS q_id, vec_id, e.label,
        list_cosine_similarity(CAST(embedding AS DOUBLE[]), mean) AS score
    FROM embeddings e CROSS JOIN means m),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY q_id ORDER BY score DESC, vec_id)
        AS INTEGER) AS rk
    FROM scored WHERE score >= {min_score})
SELECT q_id, rk, vec_id, label, round(score, 6) AS score FROM ranked WHERE rk <= {top_k}"""


VERSIONED = f"""{DOCS},
versioned AS (
    SELECT *, CAST(doc_id AS BIGINT) % 10 + 1 AS snapshot_id FROM docs),
log AS (
    SELECT snapshot_id, TIMESTAMP '2024-01-01' + to_days(CAST(snapshot_id - 1 AS INTEGER))
            AS committed_at,
        CASE WHEN snapshot_id = 4 THEN 'overwrite' ELSE 'append' END AS operation,
        count(*) AS added_rows
    FROM versioned GROUP BY 1)"""

METRICS = """count(*) AS total_queries,
    count(*) FILTER (WHERE event_type <> 'error') AS successful_queries,
    count(*) FILTER (WHERE event_type = 'error') AS failed_queries,
    round(100.0::DOUBLE * count(*) FILTER (WHERE event_type <> 'error') / count(*), 2)
        AS success_rate,
    round(coalesce(sum(value) FILTER (WHERE event_type <> 'error'), 0) / count(*), 2)
        AS avg_latency_ms,
    CAST(round(CAST(list_transform([list_sort(list(value))], lambda s: CASE
        WHEN floor(0.95 * (len(s) - 1)) = ceil(0.95 * (len(s) - 1))
            THEN s[CAST(0.95 * (len(s) - 1) AS BIGINT) + 1]
        ELSE (ceil(0.95 * (len(s) - 1)) - 0.95::DOUBLE * (len(s) - 1))
                * s[CAST(floor(0.95 * (len(s) - 1)) AS BIGINT) + 1]
            + (0.95::DOUBLE * (len(s) - 1) - floor(0.95 * (len(s) - 1)))
                * s[CAST(ceil(0.95 * (len(s) - 1)) AS BIGINT) + 1] END)[1] AS DECIMAL(18, 6)), 2) AS DOUBLE) AS p95_latency_ms"""
DAILY = f"""SELECT strftime(ts, '%Y-%m-%d') AS day, {METRICS} FROM events GROUP BY 1"""

FILES = f"""{DOCS},
files AS (
    SELECT *, CASE lang WHEN 'en' THEN '.txt' WHEN 'fr' THEN '.MD' WHEN 'es' THEN '.pdf'
        ELSE '.csv' END AS suffix FROM docs),
checked AS (
    SELECT doc_id, doc_id || suffix AS filename, CASE
        WHEN lower(suffix) NOT IN ('.txt', '.md', '.pdf') THEN 'unsupported_type'
        WHEN lower(suffix) = '.pdf' THEN 'unsupported_parser'
        WHEN content IS NULL OR length(content) < 10 THEN 'too_short'
        WHEN trim(content, {WS}) = '' THEN 'no_chunks'
        ELSE 'accepted' END AS outcome
    FROM files)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


QUALITY = f"""doc_id, CAST(length(content) AS INTEGER) AS text_length, lang AS language,
            round(CAST(len(list_filter(string_split_regex(content, {WORDS_RE}),
                lambda w: w <> '')) AS DOUBLE) / greatest(len(ss), 1), 2) AS readability_score,
            regexp_matches(content, {_quoted(EMAIL)})
                OR regexp_matches(content, {_quoted(PHONE)}) AS contains_pii"""

USER = _quoted(USER_PROMPT).replace("%s", "' || context || '", 1).replace("%s", "' || query || '")

ORACLE: dict[str, str] = {
    "chunk_fixed": f"WITH {CHUNKS} SELECT {CHUNK_COLUMNS} FROM chunks",
    # Steps of 150 characters, each with the 50 that follow it: linear in a long text.
    "chunk_large_texts": f"""WITH texts AS (
            SELECT source AS doc_id, string_agg(text, '' ORDER BY doc_id) AS content FROM documents
            WHERE source IS NOT NULL AND doc_id IS NOT NULL GROUP BY source),
        steps AS (SELECT doc_id, regexp_extract_all(content, '(?s).{{1,150}}') AS steps FROM texts),
        cut AS (
            SELECT doc_id, i, trim(steps[i] || coalesce(left(steps[i + 1], 50), ''), {WS}) AS chunk_text
            FROM (SELECT *, unnest(range(1, len(steps) + 1)) AS i FROM steps)),
        numbered AS (
            SELECT doc_id, chunk_text, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS chunk_index
            FROM cut WHERE chunk_text <> '')
        SELECT substr(md5(doc_id || '-' || chunk_index), 1, 16) AS chunk_id, doc_id, chunk_index, chunk_text,
            CAST(length(chunk_text) AS INTEGER) AS chunk_size, 'fixed-200-overlap-50' AS chunking_strategy
        FROM numbered""",
    "chunk_fixed_keep_empty": f"""WITH {BLANKED}, {_windows('chunks', 60, 10, keep=True)}
        SELECT {CHUNK_COLUMNS} FROM chunks""",
    "chunk_fixed_drop_empty": f"""WITH {BLANKED}, {_windows('chunks', 60, 10)}
        SELECT {CHUNK_COLUMNS} FROM chunks""",
    "chunk_sentences": f"{SMART} SELECT {CHUNK_COLUMNS} FROM smart",
    "sentence_split": f"""WITH {DOCS}, {SENTENCES}
        SELECT doc_id, CAST(unnest(range(len(ss))) AS INTEGER) AS sentence_index,
            unnest(ss) AS sentence FROM sentences""",
    "chunk_preview": f"""WITH {CHUNKS}
        SELECT chunk_id, doc_id, chunk_index, chunk_size, substr(chunk_text, 1, 50) AS preview
        FROM chunks ORDER BY doc_id, chunk_index LIMIT 10""",
    "chunk_conversations": f"""WITH turns AS (
            SELECT conv_id || '/' || turn AS doc_id, '' AS filename, text AS content
            FROM conversations),
        {_windows('chunks', 200, 50, 'turns')}
        SELECT {CHUNK_COLUMNS} FROM chunks""",
    "strip_markup": """SELECT page_id, regexp_replace(html, '<[^<]+?>', '', 'g') AS text
        FROM pages""",
    "url_file_type": """SELECT page_id,
            regexp_extract(regexp_extract(url, '([^/]*)$', 1), '^.+\\.([^.]+)$', 1) AS loader_type,
            list_last(string_split(lower(url), '.')) AS upload_type
        FROM pages""",
    "doc_ids": """SELECT name, substr(md5(name), 1, 16) AS doc_id FROM (
            SELECT url AS name FROM pages
            UNION ALL SELECT source || '/' || doc_id AS name FROM documents)""",
    "point_ids": f"""WITH {CHUNKS}
        SELECT chunk_id, CAST(('0x' || substr(chunk_id, 1, 15)) AS BIGINT) AS point_id
        FROM chunks""",
    "doc_sizes": f"""WITH {DOCS} SELECT doc_id, CAST(length(content) AS INTEGER) AS characters,
            CAST(strlen(content) AS INTEGER) AS bytes FROM docs""",
    "quality_checks": f"""WITH {DOCS}, {SENTENCES}
        SELECT {QUALITY} FROM docs JOIN sentences USING (doc_id)""",
    "validate_documents": f"WITH {FILES} SELECT doc_id, filename, outcome FROM checked",
    "rejects_by_reason": f"""WITH {FILES} SELECT outcome AS reject_reason, count(*) AS n
        FROM checked WHERE outcome <> 'accepted' GROUP BY 1""",
    "vector_dim_check": """WITH damaged AS (
            SELECT vec_id, CASE vec_id % 10
                WHEN 1 THEN NULL
                WHEN 2 THEN embedding[1:63]
                WHEN 3 THEN list_concat(embedding[1:63], [CAST(NULL AS FLOAT)])
                WHEN 4 THEN list_concat(embedding[1:63], [CAST('nan' AS FLOAT)])
                WHEN 5 THEN list_concat(embedding[1:63], [CAST('-inf' AS FLOAT)])
                WHEN 6 THEN [CAST(0 AS FLOAT) FOR v IN embedding]
                ELSE embedding END AS embedding
            FROM embeddings)
        SELECT vec_id, CAST(expected AS INTEGER) AS expected,
            CAST(coalesce(len(embedding), 0) AS INTEGER) AS dimension,
            CASE WHEN vec_id % 10 = 1 THEN 'empty_embedding'
                 WHEN expected <> 64 OR vec_id % 10 = 2 THEN 'wrong_dimension'
                 WHEN vec_id % 10 = 3 THEN 'null_element'
                 WHEN vec_id % 10 IN (4, 5) THEN 'not_finite'
                 WHEN vec_id % 10 = 6 THEN 'empty_embedding'
                 ELSE 'accepted' END AS outcome
        FROM damaged, (VALUES (64), (384)) AS t(expected)""",
    "query_validation": """SELECT conv_id, turn, top_k, CASE
            WHEN coalesce(length(query), 0) < 1 THEN 'empty_query'
            WHEN NOT coalesce(top_k, 3) BETWEEN 1 AND 20 THEN 'top_k_out_of_range'
            WHEN NOT coalesce(min_score, 0.5) BETWEEN 0.0 AND 1.0 THEN 'min_score_out_of_range'
            ELSE 'accepted' END AS outcome
        FROM (
            SELECT conv_id, turn, coalesce(asked, 3) AS top_k, query, min_score FROM (
                SELECT conv_id, turn, CASE WHEN conv_id % 7 = 0 THEN '' ELSE text END AS query,
                    CASE WHEN conv_id % 3 = 0 THEN NULL ELSE turn * 9 END AS asked,
                    CASE WHEN conv_id % 4 = 0 THEN NULL
                        ELSE (conv_id % 5) / 4.0::DOUBLE + 0.1 END AS min_score
                FROM conversations))""",
    "payload_defaults": f"""WITH {DOCS} SELECT doc_id,
            coalesce(nullif(filename, 'src0'), 'unknown') AS filename,
            coalesce(nullif(lang, 'en'), 'txt') AS file_type,
            CAST(coalesce(nullif(length(content) % 2, 1), 0) AS INTEGER) AS chunk_index,
            CASE WHEN length(content) >= 10 THEN content ELSE '' END AS text
        FROM docs""",
    "chunks_per_document": f"""WITH {CHUNKS}
        SELECT d.filename, count(*) AS num_chunks
        FROM chunks c JOIN docs d ON c.doc_id = d.doc_id GROUP BY d.filename""",
    "chunk_counts_all_docs": f"""{SMART}
        SELECT d.doc_id, count(chunk_id) AS num_chunks
        FROM docs d LEFT JOIN smart s ON s.doc_id = d.doc_id
        GROUP BY 1""",
    "upload_stats": f"""WITH {CHUNKS}
        SELECT d.doc_id, d.filename, CAST(length(content) AS INTEGER) AS text_length,
            count(chunk_id) AS chunks_created
        FROM docs d LEFT JOIN chunks c ON c.doc_id = d.doc_id GROUP BY ALL""",
    "lake_summary": f"""WITH {CHUNKS} SELECT (SELECT count(*) FROM docs) AS total_documents,
            (SELECT count(*) FROM chunks) AS total_chunks""",
    "chunks_missing_embedding": f"""WITH {CHUNKS} SELECT chunk_id, doc_id, chunk_index
        FROM chunks WHERE doc_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)""",
    "embedding_models": f"""WITH {CHUNKS}, {_weights('cw', 'chunk_id', 'chunk_text', 'chunks')}
        SELECT 'hashed-tokens-384' AS embedding_model, 384 AS vector_dimension,
            count(DISTINCT chunk_id) AS num_vectors
        FROM cw WHERE weight <> 0
        UNION ALL SELECT 'given', 64, count(*) FROM embeddings""",
    "collection_stats": """SELECT 'embeddings' AS collection, count(*) AS total_vectors,
            count(DISTINCT label) AS documents,
            CAST(min(len(embedding)) AS INTEGER) AS min_dimension,
            CAST(max(len(embedding)) AS INTEGER) AS max_dimension, 'cosine' AS distance_metric
        FROM embeddings""",
    "latest_snapshot": f"""WITH {VERSIONED}
        SELECT snapshot_id, strftime(committed_at, '%Y-%m-%d') AS committed_at, operation,
            added_rows
        FROM log ORDER BY log.committed_at DESC, snapshot_id DESC LIMIT 1""",
    "documents_as_of": f"""WITH {VERSIONED},
        seen AS (SELECT * FROM log WHERE committed_at <= TIMESTAMP '2024-01-07 12:00:00')
        SELECT doc_id, filename, snapshot_id FROM versioned
        WHERE snapshot_id <= (SELECT max(snapshot_id) FROM seen)
          AND snapshot_id >= (SELECT coalesce(
              max(snapshot_id) FILTER (WHERE operation = 'overwrite'), min(snapshot_id)) FROM seen)""",
    "upsert_latest": f"""WITH {DOCS}, {_windows('first', 200, 50)}, {_windows('second', 500, 100)},
        labelled AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM labels)
        SELECT chunk_id, doc_id, chunk_index, chunk_size, 1 AS snapshot_id FROM first
        WHERE doc_id NOT IN (SELECT doc_id FROM labelled)
        UNION ALL SELECT chunk_id, doc_id, chunk_index, chunk_size, 2 FROM second
        WHERE doc_id IN (SELECT doc_id FROM labelled)""",
    "stored_history": f"""WITH {DOCS}, parts AS (SELECT *, CAST(doc_id AS BIGINT) % 4 AS n FROM docs)
        SELECT CAST(day AS INTEGER) AS day, CAST(4 AS BIGINT) AS latest, count(*) AS documents,
            CAST(sum(length(content)) AS BIGINT) AS characters
        FROM parts, (VALUES (1), (2), (3), (4)) AS t(day)
        WHERE n < day AND (day < 3 OR n >= 2) GROUP BY 1""",
    "files_round_trip": f"""WITH {DOCS} SELECT filename AS name, 'txt' AS file_type,
            count(*) AS documents, CAST(sum(length(content) + 1) AS BIGINT) AS characters,
            CAST(sum(strlen(content) + 1) AS BIGINT) AS bytes
        FROM docs GROUP BY 1""",
    "catalog_chunks": f"""WITH {CHUNKS} SELECT filename, count(*) AS num_chunks,
            CAST(sum(chunk_size) AS BIGINT) AS characters FROM chunks GROUP BY 1""",
    "letter_embedding": f"""WITH {CHUNKS} SELECT * FROM (
            SELECT chunk_id, CAST(i AS INTEGER) AS dim, CAST(length(chunk_text) - length(replace(
                replace(chunk_text, chr(97 + i), ''), chr(65 + i), '')) AS BIGINT) AS weight
            FROM chunks, (SELECT CAST(unnest(range(26)) AS INTEGER) AS i))
        WHERE weight > 0""",
    "query_log_append": f"""WITH {HITS} SELECT *, num_results = 0 AS failed FROM (
            SELECT q.q_id, q.query, e.value AS latency_ms, count(h.chunk_id) AS num_results
            FROM questions q LEFT JOIN events e ON e.event_id = q.q_id
                LEFT JOIN hits h ON h.q_id = q.q_id AND rk <= 20 AND score >= {TEXT_MIN_SCORE}
            GROUP BY ALL)""",
    "ingest_append": """SELECT CAST(1 AS BIGINT) AS snapshot_id, count(*) AS added_rows,
            CAST(sum(length(text)) AS BIGINT) AS characters FROM documents
        UNION ALL SELECT 2, count(*), CAST(sum(length(text)) AS BIGINT) FROM benchmark""",
    "chunk_lineage": f"""WITH {VERSIONED}, {_windows('chunks', 200, 50)}
        SELECT c.chunk_id, c.doc_id, c.chunk_index, c.chunking_strategy,
            v.filename AS source_file, CAST(length(v.content) AS INTEGER) AS file_size,
            md5(v.content) AS file_hash, v.snapshot_id,
            strftime(l.committed_at, '%Y-%m-%d') AS committed_at, l.operation
        FROM chunks c LEFT JOIN versioned v ON v.doc_id = c.doc_id
            LEFT JOIN log l ON l.snapshot_id = v.snapshot_id""",
    "chunk_version_lineage": f"""WITH {DOCS},
        versions AS (
            SELECT doc_id, filename, content, CAST(doc_id AS BIGINT) % 10 + 1 AS snapshot_id FROM docs
            UNION ALL
            SELECT doc_id, filename, content || ' Revised.', CAST(doc_id AS BIGINT) % 10 + 6 FROM docs),
        {_windows('chunks', 500, 100)},
        cut AS (SELECT *, CAST(chunk_index % 4 * 4 + 1 AS BIGINT) AS snapshot_id FROM chunks)
        SELECT c.chunk_id, c.doc_id, c.chunk_index, c.chunking_strategy, c.snapshot_id,
            v.filename AS source_file, CAST(coalesce(length(v.content), -1) AS INTEGER) AS file_size,
            md5(v.content) AS file_hash, coalesce(v.snapshot_id, -1) AS document_snapshot,
            strftime(TIMESTAMP '2024-01-01' + to_days(CAST(v.snapshot_id - 1 AS INTEGER)), '%Y-%m-%d') AS committed_at,
            CASE WHEN v.snapshot_id = 4 THEN 'overwrite' WHEN v.snapshot_id IS NOT NULL THEN 'append' END AS operation
        FROM cut c ASOF LEFT JOIN versions v ON c.doc_id = v.doc_id AND c.snapshot_id >= v.snapshot_id""",
    "reingest_changes": f"""WITH {DOCS},
        before AS (SELECT * FROM docs WHERE CAST(doc_id AS BIGINT) % 10 <> 2),
        after AS (
            SELECT * REPLACE (CASE WHEN CAST(doc_id AS BIGINT) % 10 = 1 THEN content || ' Revised.'
                ELSE content END AS content)
            FROM docs WHERE CAST(doc_id AS BIGINT) % 10 <> 0),
        {_windows('old', 200, 50, 'before')}, {_windows('cut', 200, 50, 'after')},
        compared AS (
            SELECT CASE WHEN o.chunk_id IS NULL THEN 'new' WHEN c.chunk_id IS NULL THEN 'gone'
                WHEN o.chunk_text = c.chunk_text THEN 'same' ELSE 'changed' END AS change
            FROM old o FULL JOIN cut c ON o.chunk_id = c.chunk_id AND o.doc_id = c.doc_id)
        SELECT change, (SELECT count(*) FROM compared x WHERE x.change = k.change) AS chunks
        FROM (VALUES ('new'), ('changed'), ('gone'), ('same')) AS k(change)
        UNION ALL SELECT 'live', count(*) FROM cut
        UNION ALL SELECT 'written', count(*) FROM compared WHERE change IN ('new', 'changed')""",
    "reingest_stats": f"""{SMART}, {_weights('cw', 'chunk_id', 'chunk_text', 'smart')}
        SELECT 'success' AS status, (SELECT count(*) FROM docs) AS documents,
            (SELECT count(*) FROM smart) AS chunks,
            (SELECT count(DISTINCT chunk_id) FROM cw WHERE weight <> 0) AS vectors,
            'documents' AS collection""",
    "hash_embedding": f"""WITH {DOCS}, {_weights('w', 'doc_id', 'content', 'docs')}
        SELECT doc_id, CAST(dim AS INTEGER) AS dim, weight FROM w""",
    **dict.fromkeys(("search_two_sided", "search_cells", "search_coded"), """WITH v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
        pairs AS (
            SELECT a.vec_id AS q_id, b.vec_id, b.label, list_cosine_similarity(a.x, b.x) AS score
            FROM v a JOIN v b ON a.vec_id % 2 = 0 AND b.vec_id % 2 = 1),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY q_id ORDER BY score DESC, vec_id) AS INTEGER) AS rk
            FROM pairs)
        SELECT q_id, rk, vec_id, label, round(score, 6) AS score FROM ranked WHERE rk <= 5"""),
    "topk_cosine": _nearest(5, -2),
    "topk_min_score": _nearest(20, CENTROID_MIN_SCORE),
    "cosine_own_centroid": f"""WITH {CENTROIDS}
        SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), mean), 6)
            AS score
        FROM embeddings JOIN means USING (label)""",
    "search_chunks": f"""WITH {HITS} SELECT q_id, rk, round(score, 6) AS score, chunk_id, doc_id,
            chunk_index, filename, text FROM hits WHERE rk <= 3""",
    "search_postings": f"""WITH {HITS} SELECT q_id, rk, round(score, 6) AS score, chunk_id, doc_id,
            chunk_index, filename, text FROM hits WHERE rk <= 3""",
    "confidence_levels": f"""WITH {HITS} SELECT q_id, rk, chunk_id,
            CASE WHEN score >= 0.8 THEN 'HIGH' WHEN score >= 0.6 THEN 'MEDIUM' ELSE 'LOW' END
                AS confidence_level
        FROM hits WHERE rk <= 20""",
    "citation_sources": f"""WITH {HITS} SELECT q_id, rk, filename, chunk_index,
            round(score, 6) AS score, substr(text, 1, 100) || '...' AS text
        FROM hits WHERE rk <= 3""",
    "display_sources": f"""WITH {HITS} SELECT q_id, rk, filename, chunk_index,
            substr(text, 1, 200) || '...' AS text FROM hits WHERE rk <= 5""",
    "rag_context": f"WITH {HITS} {CONTEXT} FROM hits WHERE rk <= 3 GROUP BY q_id",
    "rag_prompt": f"""WITH {HITS},
        contexts AS ({CONTEXT}, max(score) AS best FROM hits
            WHERE rk <= 3 AND score >= {TEXT_MIN_SCORE} GROUP BY q_id)
        SELECT q_id, query, coalesce(num_sources, 0) AS num_sources,
            CASE WHEN context IS NOT NULL THEN {_quoted(SYSTEM_PROMPT)} END AS system_prompt,
            CASE WHEN context IS NOT NULL THEN {USER} END AS user_prompt,
            CASE WHEN context IS NULL THEN 'No relevant documents found.' END AS answer,
            CASE WHEN best >= 0.8 THEN 'HIGH' WHEN best >= 0.6 THEN 'MEDIUM'
                 WHEN best IS NOT NULL THEN 'LOW' END AS confidence_level,
            'gpt-4o-mini' AS model
        FROM questions LEFT JOIN contexts USING (q_id)""",
    "hits_per_query": f"""WITH {HITS} SELECT q.q_id, count(h.chunk_id) AS num_results,
            (SELECT count(*) FROM chunks) AS total_documents,
            max(chunk_id) FILTER (WHERE rk = 1) AS best_chunk_id
        FROM questions q LEFT JOIN hits h
            ON h.q_id = q.q_id AND rk <= 20 AND score >= {TEXT_MIN_SCORE}
        GROUP BY 1""",
    "hits_lineage": f"""WITH {VERSIONED}, {_windows('chunks', 200, 50)}, {SEARCH}, {SENTENCES},
        quality AS (SELECT {QUALITY} FROM docs JOIN sentences USING (doc_id))
        SELECT q_id, rk, chunk_id, v.snapshot_id,
            strftime(l.committed_at, '%Y-%m-%d') AS committed_at,
            v.filename AS source_file, md5(v.content) AS file_hash,
            'fixed-200-overlap-50 > hashed-tokens-384' AS steps, readability_score, contains_pii
        FROM hits h JOIN quality USING (doc_id) JOIN versioned v ON v.doc_id = h.doc_id
            JOIN log l ON l.snapshot_id = v.snapshot_id
        WHERE rk <= 3""",
    "search_collection": f"""WITH {DOCS}, {_windows('first', 200, 50)},
        {_windows('second', 500, 100)},
        labelled AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM labels),
        chunks AS (
            SELECT * FROM first WHERE doc_id NOT IN (SELECT doc_id FROM labelled)
            UNION ALL
            SELECT * FROM second WHERE doc_id IN (SELECT doc_id FROM labelled)),
        {SEARCH}
        SELECT q_id, rk, round(score, 6) AS score, chunk_id, doc_id, chunk_index, filename,
            'txt' AS file_type
        FROM hits WHERE rk <= 5""",
    "query_log": f"""WITH {HITS} SELECT q.q_id, q.query, e.value AS latency_ms,
            count(h.chunk_id) AS num_results
        FROM questions q LEFT JOIN events e ON e.event_id = q.q_id
            LEFT JOIN hits h ON h.q_id = q.q_id AND rk <= 20 AND score >= {TEXT_MIN_SCORE}
        GROUP BY ALL""",
    "query_metrics": f"SELECT {METRICS} FROM events",
    "query_metrics_daily": DAILY,
    "stream_query_metrics": f"SELECT {METRICS} FROM events",
    "stream_query_metrics_daily": DAILY,
    "query_metrics_sketched": f"""SELECT * EXCLUDE (p95_latency_ms), true AS p95_within_bound
        FROM ({DAILY})""",
    "stream_days_sketched": f"SELECT * EXCLUDE (p95_latency_ms) FROM ({DAILY})",
    "collection_estimates": f"""WITH {CHUNKS}, parts AS (
            SELECT count(*) FILTER (WHERE CAST(doc_id AS BIGINT) % 2 = 0) AS even, count(*) AS n FROM chunks)
        SELECT CAST(step AS INTEGER) AS step, CASE step WHEN 0 THEN even WHEN 1 THEN n ELSE n + even END AS total_vectors,
            true AS documents_within_bound
        FROM parts, (VALUES (0), (1), (2)) AS t(step)""",
    "stream_ingest_documents": f"""WITH {CHUNKS},
            {_weights('cw', 'chunk_id', 'chunk_text', 'chunks')}
        SELECT c.doc_id, count(*) AS chunks, count(w.chunk_id) AS vectors
        FROM chunks c JOIN docs d ON d.doc_id = c.doc_id
            LEFT JOIN (SELECT DISTINCT chunk_id FROM cw WHERE weight <> 0) w
                ON w.chunk_id = c.chunk_id
        WHERE length(d.content) >= 10 GROUP BY 1""",
}
