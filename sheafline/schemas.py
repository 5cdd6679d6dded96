"""Record schemas of the topics, tables and reports."""

from pyspark.sql import types as T


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RAW_EVENT = _struct(
    ("document_id", T.StringType()),
    ("company_id", T.StringType()),
    ("s3_path", T.StringType()),
    ("content_type", T.StringType()),
)

CHUNK = _struct(
    ("chunk_id", T.StringType()),
    ("document_id", T.StringType()),
    ("company_id", T.StringType()),
    ("text", T.StringType()),
    ("page", T.IntegerType()),
)

EMBEDDING = _struct(
    ("chunk_id", T.StringType()),
    ("document_id", T.StringType()),
    ("company_id", T.StringType()),
    ("vector", T.ArrayType(T.FloatType())),
)

# What a report needs from an embedding record: the vector is never parsed.
EMBEDDING_KEYS = _struct(
    ("chunk_id", T.StringType()),
    ("document_id", T.StringType()),
    ("company_id", T.StringType()),
)

WINDOW_RESULT = _struct(
    ("window_start", T.TimestampType()),
    ("window_end", T.TimestampType()),
    ("company_id", T.StringType()),
    ("chunk_count", T.LongType()),
)

BROKER_ROW = _struct(
    ("key", T.StringType()),
    ("value", T.StringType()),
    ("topic", T.StringType()),
    ("partition", T.IntegerType()),
    ("offset", T.LongType()),
    ("timestamp", T.TimestampType()),
)

PAGES = T.ArrayType(_struct(("page", T.IntegerType()), ("text", T.StringType())))

# What extraction leaves of an object: its pages, or an error with its stage.
EXTRACTED = _struct(
    ("document_id", T.StringType()),
    ("company_id", T.StringType()),
    ("s3_path", T.StringType()),
    ("content_type", T.StringType()),
    ("pages", PAGES),
    ("error", T.StringType()),
    ("stage", T.StringType()),
    ("outcome", T.StringType()),
)

RAW_OBJECT = _struct(
    ("path", T.StringType()),
    ("content", T.BinaryType()),
    ("content_type", T.StringType()),
)

CHUNK_METADATA = _struct(
    ("page", T.IntegerType()),
    ("title", T.StringType()),
    ("tokens", T.IntegerType()),
    ("content_hash", T.StringType()),
)

OBSERVATION = _struct(
    ("ts", T.TimestampType()),
    ("metric", T.StringType()),
    ("labels", T.MapType(T.StringType(), T.StringType())),
    ("value", T.DoubleType()),
)

TOPIC_SCHEMAS = {
    "documents.raw": RAW_EVENT,
    "chunks.processed": CHUNK,
    "embeddings.ready": EMBEDDING,
}

# States of a document and of a stored vector.
DOCUMENT_STATES = ("pending", "uploaded", "processing", "processed", "error")
VECTOR_STATES = ("pending", "created", "error")
