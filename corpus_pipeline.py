"""From raw documents to padded batches, stage by stage.

Every stage takes (spark, docs, sf_dir), gets all rows its predecessor kept, and
returns the columns of ``documents``; only the last returns something else.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafline.llm import mixture, near_dups, packing, secrets, toxicity
from sheafline.llm.common import tables, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")



def drop_toxic(spark, docs, sf_dir):
    """Documents whose toxicity score is below the threshold; the model learns from ``labels``."""
    labels = tables(spark, sf_dir, "labels", "doc_id", "toxic")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group linked by 80 per cent of their five-word shingles."""
    return near_dups.drop_near_duplicates(docs)


def redact_secrets(spark, docs, sf_dir):
    """All documents, their secrets replaced by a placeholder."""
    clean = secrets.redact_secrets(docs.withColumn("__text", F.col("text")))
    same = F.col("n_chars").isNull() | F.col("text").eqNullSafe(F.col("__text"))
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(length)).drop("__text")


def mix_sources(spark, docs, sf_dir):
    """What the mix takes of each document: a row per pass over its source."""
    return mixture.mixed_texts(docs, length="n_chars")


def pack_batches(spark, docs, sf_dir):
    """Every text with its bucket, batch and slot."""
    packed = packing.pack(docs.select("doc_id", "source", "text"))
    return packed.select("doc_id", "source", "text", "length", "bucket", "bucket_length", "batch", "slot", "padding")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixture", mix_sources),
    ("packing", pack_batches),
]
# Learned scores and hashed draws have no counterpart in SQL; tests/llm checks the stages
# against plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = tables(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
