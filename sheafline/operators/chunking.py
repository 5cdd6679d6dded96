"""Overlapping word chunks.

Chunking is a narrow operator: a document row fans out inside its own task, so
nothing is shuffled and the document ordinal needs no window function.
"""

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.functions import ids, text
from sheafline.session import bounded_batches

# Default chunk size and overlap, in words.
DEFAULT_SIZE = 1000
DEFAULT_OVERLAP = 200


@dataclass(frozen=True)
class ChunkSpec:
    """Window of ``size`` words that shares ``overlap`` words with the one before."""

    size: int = DEFAULT_SIZE
    overlap: int = DEFAULT_OVERLAP

    def __post_init__(self):
        if self.size <= 0:
            raise ValueError(f"chunk size must be positive, got {self.size}")
        if self.overlap < 0:
            raise ValueError(f"chunk overlap must not be negative, got {self.overlap}")
        if self.overlap >= self.size:
            raise ValueError(f"chunk overlap {self.overlap} must be below size {self.size}")

    @property
    def step(self):
        return self.size - self.overlap

    def last_index(self, n_words):
        """Index of the last chunk of a non-empty text of ``n_words`` words."""
        extra = F.ceil((n_words - F.lit(self.size)) / F.lit(self.step))
        return F.greatest(F.lit(0), extra).cast("int")

    def count(self, n_words):
        return F.when(n_words > 0, self.last_index(n_words) + 1).otherwise(F.lit(0))

    def slice(self, word_array, k):
        return F.array_join(F.slice(word_array, k * self.step + 1, F.lit(self.size)), " ")


def chunk_text(df, spec=ChunkSpec(), column="text"):
    """One row per chunk of a text column; other columns are carried along.

    Blank texts yield no chunk.  The fan-out is the outer form with the empty
    result removed afterwards: for the plain form the optimizer derives a filter
    on the split words and pushes it down, so every text would be split twice.
    """
    keep = [c for c in df.columns if c != column]
    split = df.select(*keep, text.words(F.col(column)).alias("__words"))
    count = F.size("__words")
    windows = F.when(count > 0, F.sequence(F.lit(0), spec.last_index(count)))
    indexed = split.select(*keep, "__words", F.explode_outer(windows).alias("chunk_index"))
    return indexed.filter(F.col("chunk_index").isNotNull()).select(
        *keep, "chunk_index", spec.slice(F.col("__words"), F.col("chunk_index")).alias(column)
    )


def _split_pages(pages):
    tokens = F.transform(
        pages, lambda p: F.struct(p["page"].alias("page"), text.words(p["text"]).alias("words"))
    )
    return F.filter(tokens, lambda p: F.size(p["words"]) > 0)


def chunk_pages(df, spec=ChunkSpec(), column="pages"):
    """Chunk each page on its own; ``chunk_index`` runs through the whole document.

    The running index comes from laying out (page position, window) pairs in one
    array per document, so a document of any length needs neither a shuffle nor
    a sort.
    """
    keep = [c for c in df.columns if c != column]
    split = df.select(*keep, _split_pages(F.col(column)).alias("__pages"))
    layout = F.flatten(
        F.transform(
            F.col("__pages"),
            lambda p, i: F.transform(
                F.sequence(F.lit(0), spec.last_index(F.size(p["words"]))),
                lambda k: F.struct(i.alias("at"), k.alias("k")),
            ),
        )
    )
    indexed = split.select(*keep, "__pages", F.posexplode_outer(layout).alias("chunk_index", "__w"))
    page = F.get(F.col("__pages"), F.col("__w.at"))
    return indexed.filter(F.col("chunk_index").isNotNull()).select(
        *keep,
        "chunk_index",
        page["page"].alias("page"),
        spec.slice(page["words"], F.col("__w.k")).alias("text"),
    )


def chunk_with(df, chunker, column="text"):
    """Chunks of a plugged-in ``chunker(text) -> list of texts``, one row per chunk.

    The function runs in Arrow batches; blank texts never reach it.
    """

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: list(chunker(t)))

    keep = [c for c in df.columns if c != column]
    cut = bounded_batches(df).filter(text.has_text(F.col(column))).select(*keep, run(column).alias("__chunks"))
    fanned = cut.select(*keep, F.posexplode_outer("__chunks").alias("chunk_index", column))
    return fanned.filter(F.col("chunk_index").isNotNull())


def word_chunker(spec=ChunkSpec()):
    """The chunker of :func:`chunk_text` as a plain function of a text."""
    size, step = spec.size, spec.step

    def chunks(content):
        words = content.split()
        at = 0
        while words:
            yield " ".join(words[at : at + size])
            if at + size >= len(words):
                return
            at += step

    return chunks


def register_chunker(spark, name, chunker):
    """Make ``chunker(text) -> texts`` a table function of SQL: (chunk_index, text) per chunk.

    ``SELECT d.id, c.* FROM documents d, LATERAL name(d.text) c``.  Texts reach it in Arrow
    batches and chunks leave it one by one, so a long text is never a list of all its
    chunks; null and blank texts have none.
    """

    class Chunks:
        def eval(self, content: str):
            if content is not None and content.strip():
                yield from enumerate(chunker(content))

    spark.udtf.register(name, F.udtf(Chunks, returnType="chunk_index int, text string", useArrow=True))


def with_chunk_ids(chunks, page="page", random_ids=False):
    """Add ``chunk_id``; deterministic unless ``random_ids``."""
    at = F.col(page) if page in chunks.columns else F.lit(None).cast("int")
    key = ids.random_id() if random_ids else ids.chunk_key(
        F.col("document_id"), at, F.col("chunk_index")
    )
    return chunks.withColumn("chunk_id", key)


def chunk_records(documents, spec=ChunkSpec(), random_ids=False):
    """Extracted documents (document_id, company_id, pages) to chunk records."""
    chunks = chunk_pages(documents.select("document_id", "company_id", "pages"), spec)
    return with_chunk_ids(chunks, random_ids=random_ids).select(
        "chunk_id",
        "document_id",
        "company_id",
        "text",
        F.coalesce("page", F.lit(ids.NO_PAGE)).alias("page"),
        "chunk_index",
    )


def document_summary(documents, spec=ChunkSpec(), column="pages"):
    """Characters, pages and chunks per document, computed inside the row."""
    pages = F.col(column)
    chars = F.aggregate(pages, F.lit(0).cast("long"), lambda acc, p: acc + F.length(p["text"]))
    chunks = F.aggregate(
        pages, F.lit(0), lambda acc, p: acc + spec.count(F.size(text.words(p["text"])))
    )
    numbered = F.filter(pages, lambda p: p["page"].isNotNull())
    keep = [c for c in documents.columns if c != column]
    return documents.select(
        *keep,
        F.when(F.size(numbered) > 0, F.size(numbered)).alias("total_pages_extracted"),
        chars.alias("raw_text_length_chars"),
        chunks.alias("num_chunks_generated"),
    )
