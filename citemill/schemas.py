"""Table schemas of the lake and of the records passed between operators."""

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def struct_of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Column names and types of the lake tables.
RAW_DOCUMENTS = struct_of(
    doc_id=S, filename=S, content=S, file_type=S, file_size=L, ingestion_date=T.DateType()
)
DOCUMENT_CHUNKS = struct_of(
    chunk_id=S,
    doc_id=S,
    chunk_index=I,
    chunk_text=S,
    chunk_size=I,
    chunking_strategy=S,
    created_at=T.TimestampType(),
)
EMBEDDINGS_METADATA = struct_of(
    chunk_id=S,
    doc_id=S,
    embedding_model=S,
    vector_dimension=I,
    created_at=T.TimestampType(),
    snapshot_id=L,
)

LOADED_DOCUMENT = struct_of(
    doc_id=S,
    filename=S,
    content=S,
    file_type=S,
    file_size=L,
    created_at=T.TimestampType(),
    metadata=T.MapType(S, S),
)
POINT_PAYLOAD = struct_of(
    chunk_id=S,
    doc_id=S,
    chunk_index=I,
    text=S,
    filename=S,
    file_type=S,
    chunk_size=I,
    strategy=S,
    indexed_at=T.TimestampType(),
)
QUERY_LOG = struct_of(
    q_id=L, query=S, latency_ms=D, num_results=L, failed=T.BooleanType(), ts=T.TimestampType()
)
SNAPSHOT_LOG = struct_of(
    snapshot_id=L,
    committed_at=T.TimestampType(),
    operation=S,
    added_rows=L,
    stream_id=S,
    batch_id=L,
    covers=L,
)
PROPERTIES = struct_of(name=S, value=S)

# What the binary file source yields; a stream must be told this in advance.
BINARY_FILE = struct_of(
    path=S, modificationTime=T.TimestampType(), length=L, content=T.BinaryType()
)
