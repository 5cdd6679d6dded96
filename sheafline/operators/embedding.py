"""Vectors for chunks: a JVM default model and a plug-in batch model."""

import hashlib
import time
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.functions import payload
from sheafline.operators.events import UNKNOWN_COMPANY, with_text
from sheafline.session import bounded_batches

# Default dimension, messages per model call and retry limits.
DEFAULT_DIMENSION = 1536
DEFAULT_BATCH = 50
MAX_RETRIES = 3
BACKOFF_MIN_S = 2.0
BACKOFF_MAX_S = 10.0
HASHED_MODEL = "hashed-words"


# Words whose place a task remembers.
REMEMBERED_WORDS = 200_000


class _Places(dict):
    """Word -> its place in the vector: the first 32 bits of its MD5, modulo the dimension."""

    def __init__(self, dimension):
        super().__init__()
        self.dimension = dimension

    def __missing__(self, word):
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        place = self[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % self.dimension
        return place


def hashed_vectors(df, dimension=DEFAULT_DIMENSION, column="text", output="vector"):
    """Deterministic unit vectors of word counts, words placed by a hash any engine has.

    Words are separated by single spaces; a text without words has a zero vector.
    """

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def vectors(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        places = _Places(dimension)
        for part in parts:
            made = []
            for text in part:
                words = [w for w in (text or "").split(" ") if w]
                counts = np.bincount([places[w] for w in words], minlength=dimension).astype(np.float64)
                length = np.sqrt((counts * counts).sum())
                made.append((counts / length if length else counts).astype(np.float32))
            yield pd.Series(made, index=part.index)

    return bounded_batches(df).withColumn(output, vectors(F.col(column)))


def embedding_records(vectors, default_company=UNKNOWN_COMPANY):
    """Ids and vector only; a tenant column that was never sent gets a default."""
    company = (
        F.col("company_id") if "company_id" in vectors.columns else F.lit(default_company)
    )
    return vectors.select("chunk_id", "document_id", company.alias("company_id"), "vector")


def embed_chunks(chunks, dimension=DEFAULT_DIMENSION):
    """Chunk records to embedding records with the default model."""
    return embedding_records(hashed_vectors(with_text(chunks), dimension))


def chunk_messages(messages, value="value"):
    """Messages with ``chunk`` (chunk_id, document_id, company_id, text), or the ``reason`` why there is none.

    An absent tenant becomes ``unknown``; an explicit null stays null.  One result for good
    and bad messages, parsed once.
    """
    doc = F.col("__json")
    parsed = messages.withColumn("__json", payload.decode(F.col(value)))
    text = payload.text_field(doc, "text")
    reason = F.when(~payload.is_valid(doc), "invalid_json").when(~payload.is_object(doc), "not_an_object")
    chunk = F.struct(
        payload.text_field(doc, "chunk_id").alias("chunk_id"),
        payload.text_field(doc, "document_id").alias("document_id"),
        payload.tenant_or(doc, UNKNOWN_COMPANY).alias("company_id"),
        text.alias("text"),
    )
    told = parsed.withColumn("reason", reason.when(text.isNull(), "no_text"))
    return told.withColumn("chunk", F.when(F.col("reason").isNull(), chunk)).select(*messages.columns, "chunk", "reason")


def embed_messages(messages, dimension=DEFAULT_DIMENSION, value="value"):
    """(records, dead letters) of chunk messages (JSON).

    A message that is no JSON object or has no text keeps all its columns and gets a
    ``reason``, so every message ends in one of the two.  Each side parses for itself; see
    :func:`chunk_messages` for both from one pass.
    """
    rows = chunk_messages(messages, value)
    chunks = rows.filter("reason IS NULL").select("chunk.*")
    return embed_chunks(chunks, dimension), rows.filter("reason IS NOT NULL").select(*messages.columns, "reason")


def with_model_info(vectors, model_name=HASHED_MODEL, dimension=DEFAULT_DIMENSION):
    return vectors.withColumns(
        {"model_name": F.lit(model_name), "model_dimension": F.lit(dimension)}
    )


def check_dimension(vectors, dimension):
    """Add ``dimension`` and ``dimension_ok``; a null vector is not ok."""
    size = F.size(F.coalesce("vector", F.array().cast("array<float>")))
    return vectors.withColumns({"dimension": size, "dimension_ok": size == dimension})


def split_by_dimension(vectors, dimension):
    """(fitting, quarantined) vectors."""
    checked = check_dimension(vectors, dimension)
    return checked.filter("dimension_ok"), checked.filter("NOT dimension_ok")


class RetryableError(Exception):
    """Raised by a model for rate limits and lost connections."""


@dataclass(frozen=True)
class Retry:
    """Bounded exponential backoff; ``retryable`` decides which errors come back."""

    retries: int = MAX_RETRIES
    shortest: float = BACKOFF_MIN_S
    longest: float = BACKOFF_MAX_S
    retryable: Callable[[Exception], bool] = lambda error: isinstance(error, RetryableError)
    sleep: Callable[[float], None] = time.sleep

    def wait(self, attempt):
        return max(self.shortest, min(self.longest, 2.0 ** (attempt - 1)))

    def call(self, function, *args):
        for attempt in range(1, self.retries + 2):
            try:
                return function(*args)
            except Exception as error:
                if attempt > self.retries or not self.retryable(error):
                    raise
                self.sleep(self.wait(attempt))


def _call_model(model, texts, dimension, retry):
    """(vectors, error) of one model call; never raises, so the stream goes on."""
    try:
        vectors = retry.call(model, texts)
        if len(vectors) != len(texts):
            raise ValueError(f"expected {len(texts)} vectors, got {len(vectors)}")
        vectors = [[float(x) for x in v] for v in vectors]
    except Exception as error:
        return [None] * len(texts), [f"{type(error).__name__}: {error}"] * len(texts)
    errors = [
        None if dimension in (None, len(v)) else f"dimension {len(v)}, expected {dimension}"
        for v in vectors
    ]
    return [v if e is None else None for v, e in zip(vectors, errors)], errors


def embed_with(chunks, model_factory, dimension=None, batch_size=DEFAULT_BATCH, retry=Retry(),
               partitions=None):
    """Chunk records through a plugged-in model.

    ``model_factory()`` runs once per task and returns ``texts -> vectors``.  The
    text stays in the same Arrow batch as its ids, so results need no join.  A
    failed call marks its rows with ``error``; nothing is lost.  ``partitions``
    spreads chunks evenly over tasks when model time outweighs a shuffle.
    """
    rows = bounded_batches(with_text(chunks)).select("chunk_id", "document_id", "company_id", "text")
    if partitions:
        rows = rows.repartition(partitions)
    schema = T.StructType(
        rows.drop("text").schema.fields
        + [T.StructField("vector", T.ArrayType(T.FloatType())), T.StructField("error", T.StringType())]
    )

    def run(frames):
        model = model_factory()
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                part = frame.iloc[start : start + batch_size]
                vectors, errors = _call_model(model, part["text"].tolist(), dimension, retry)
                out = part.drop(columns="text")
                yield out.assign(
                    vector=pd.Series(vectors, index=out.index, dtype=object),
                    error=pd.Series(errors, index=out.index, dtype=object),
                )

    return rows.mapInPandas(run, schema)
