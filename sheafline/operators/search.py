"""Tenant-scoped similarity search."""

import math

from pyspark.sql import functions as F

from sheafline.functions import vectors


def _fits(length):
    return F.coalesce(F.size("vector") == length, F.lit(False)) & F.coalesce(
        ~F.exists("vector", lambda x: x.isNull()), F.lit(False)
    )


def unsearchable(embeddings, length):
    """Vectors no query of this length can find: null, of another length, with null values or without direction."""
    return embeddings.filter(~_fits(length) | (vectors.norm(F.col("vector")) == 0))


def tenant_topk(embeddings, company_id, query, k, unit_vectors=False):
    """The ``k`` most similar vectors of one tenant; ties by chunk id.

    The tenant filter reaches the scan, and ordering with a limit keeps only
    ``k`` rows per task, so no full sort happens.  ``unit_vectors`` says that the
    stored vectors have length 1, as the default model's do, and saves computing it.
    Only vectors of the query's length that have a direction can be hits; see
    :func:`unsearchable`.
    """
    length = math.sqrt(sum(float(x) ** 2 for x in query))
    if length == 0:
        raise ValueError("the query vector has no direction")
    target = F.array(*[F.lit(float(x) / length) for x in query])
    score = vectors.dot(F.col("vector"), target)
    if not unit_vectors:
        score = score / F.nullif(vectors.norm(F.col("vector")), F.lit(0.0))
    own = embeddings.filter((F.col("company_id") == company_id) & _fits(len(query)))
    scored = own.select("chunk_id", "document_id", "company_id", score.alias("score"))
    scored = scored.filter(F.col("score").isNotNull() & ~F.isnan("score"))
    return scored.orderBy(F.desc("score"), "chunk_id").limit(k)
