"""The staged flow raw objects -> text or dead letter -> chunks -> vectors, one query per layer.

Each layer reads the table the layer before it writes, with its own checkpoint:
a lost executor or a restart repeats the open micro-batch only, and ids are
deterministic, so replayed rows are recognisable.
"""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sheafline.operators import embedding, extraction
from sheafline.operators.chunking import ChunkSpec, chunk_records
from sheafline.operators.reports import daily_report
from sheafline.schemas import CHUNK, EMBEDDING, EXTRACTED
from sheafline.sinks.tables import stream_layer, write_report
from sheafline.streaming.counters import event_time_counts


DEAD_LETTER = StructType([f for f in EXTRACTED.fields if f.name not in ("pages", "outcome")])
# Fixed value: longest wait before a started batch is embedded.
EMBED_TRIGGER = "5 seconds"


def embed_stage(chunks, dimension=embedding.DEFAULT_DIMENSION):
    return embedding.embed_chunks(chunks, dimension)


def start_extraction_layer(objects, root, trigger=None):
    """Raw objects (document_id, company_id, s3_path, content, content_type) to text or a dead letter.

    One scan and one parse per object; the table is partitioned by outcome, so the
    layers after it read only their part.
    """
    rows = extraction.extract_events(objects).select(*EXTRACTED.names)
    checkpoint = f"{root}/_checkpoints/extracted"
    return stream_layer(rows, f"{root}/extracted", checkpoint, trigger, partition="outcome")


def _extracted(spark, root, outcome):
    rows = spark.readStream.schema(EXTRACTED).parquet(f"{root}/extracted")
    return rows.filter(F.col("outcome") == outcome)


def start_chunk_layer(spark, root, spec=ChunkSpec(), trigger=None):
    """Follow the texts written by :func:`start_extraction_layer`."""
    rows = chunk_records(_extracted(spark, root, extraction.OUTCOME_TEXT), spec).select(*CHUNK.names)
    return stream_layer(rows, f"{root}/processed", f"{root}/_checkpoints/processed", trigger)


def start_dead_letter_layer(spark, root, trigger=None):
    """Follow the failures written by :func:`start_extraction_layer`, of every stage in one table."""
    rows = _extracted(spark, root, extraction.OUTCOME_DEAD).select(*DEAD_LETTER.names)
    return stream_layer(rows, f"{root}/dead_letters", f"{root}/_checkpoints/dead_letters", trigger)


def start_embedding_layer(spark, root, dimension=embedding.DEFAULT_DIMENSION, trigger=None):
    """Follow the chunk table written by :func:`start_chunk_layer`, a batch every few seconds."""
    chunks = spark.readStream.schema(CHUNK).parquet(f"{root}/processed")
    rows = embed_stage(chunks, dimension).select(*EMBEDDING.names)
    trigger = trigger or {"processingTime": EMBED_TRIGGER}
    return stream_layer(rows, f"{root}/embeddings", f"{root}/_checkpoints/embeddings", trigger)


def start_rate_layer(messages, root, trigger=None):
    """Per-tenant event-time counts of a message stream as a table of closed windows."""
    counts = event_time_counts(messages)
    return stream_layer(counts, f"{root}/analytics/rt", f"{root}/_checkpoints/rt", trigger)


def write_summary(spark, root, as_of=None):
    """Daily summary of the embedding layer, for a batch run after midnight."""
    vectors = spark.read.schema(EMBEDDING).parquet(f"{root}/embeddings")
    write_report(daily_report(vectors, as_of), f"{root}/analytics/batch")
