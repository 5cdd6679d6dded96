"""Identifiers."""

from pyspark.sql import functions as F

NO_PAGE = -1


def chunk_key(document_id, page, chunk_index):
    """Deterministic chunk id: a replayed document gets the same ids again."""
    return F.sha2(
        F.concat_ws(":", document_id, F.coalesce(page, F.lit(NO_PAGE)), chunk_index), 256
    )


def random_id():
    """Random id, for callers that want a new one on every run."""
    return F.uuid()
