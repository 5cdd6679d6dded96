"""Small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafline.session import bounded_batches, shared_folder  # noqa: F401 - the operators take it from here

# A run of anything but the six ASCII spaces.
WORD = r"[^\x20\x09-\x0D]+"
# Remainder of crc32(doc_id) modulo FOLDS that is never learned from.
FOLDS = 4
HELD_OUT = 2


def written(df, purpose):
    """The rows of ``df`` as a Parquet table in the shared folder.

    Cuts the lineage with one computation; a lost executor costs a reread.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id="doc_id"):
    """True for documents models must not learn from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def word_count(text="text"):
    """Number of words as a long; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def without(df, *names):
    """``df`` less the columns an operator is about to add, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[c for c in df.columns if c.lower() not in taken])


def tables(spark, folder, name, *columns):
    """The named columns of one table of a data folder."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet").select(*columns)
