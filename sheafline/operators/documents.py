"""Document and chunk tables: enrichment, replacement, status and deletion."""

from pyspark.sql import functions as F

from sheafline.functions.ids import NO_PAGE
from sheafline.operators.joins import unique_keys
from sheafline.schemas import CHUNK_METADATA, DOCUMENT_STATES, VECTOR_STATES

KEY = ("company_id", "document_id")
# One sortable number from a time in microseconds and a change number.
ORDER = "decimal(38,0)"
SEQ_SPAN = 2**64
SEQ_LOWEST = -(2**63)
# Before any time a timestamp can hold, for changes without one.
NO_TIME = -(10**17)


def enrich_chunks(chunks, content_limit=None, count_tokens=None):
    """Index rows: key, content, hash, token count and title.

    Content is whole.  For an index that holds no more than ``content_limit``
    characters the copy is cut and ``truncated`` tells which rows were.  Tokens are
    whitespace tokens unless ``count_tokens`` (a function of the text column) says
    otherwise; hash and tokens cover the whole text.  The title is that of the
    document's metadata (``title_extracted``), null where there is none.  A
    ``file_name`` or ``vector`` column is carried along.
    """
    content = F.col("text")
    tokens = F.when(content == "", F.lit(0)).otherwise(F.size(F.split(content, " ")))
    extra = [c for c in ("file_name", "vector") if c in chunks.columns]
    title = F.col("title_extracted") if "title_extracted" in chunks.columns else F.lit(None).cast("string")
    indexed = content
    if content_limit is not None:
        indexed = F.substring(content, 1, content_limit)
        extra.append((F.char_length(content) > content_limit).alias("truncated"))
    return chunks.select(
        F.concat_ws("_", "document_id", "chunk_index").alias("pk_id"),
        *KEY,
        "chunk_index",
        indexed.alias("content"),
        "page",
        title.alias("title"),
        (tokens if count_tokens is None else count_tokens(content)).alias("tokens"),
        F.sha2(content, 256).alias("content_hash"),
        *extra,
    )


def chunk_table_rows(chunks, vector_status="created", count_tokens=None):
    """Chunk-table rows: full content, nested metadata and the index key as embedding id.

    A page of -1 means the format has no pages and is stored as null.
    """
    if vector_status not in VECTOR_STATES:
        raise ValueError(f"unknown vector state {vector_status}")
    indexed = enrich_chunks(chunks, count_tokens=count_tokens)
    metadata = F.struct(
        F.nullif(F.col("page"), F.lit(NO_PAGE)).alias("page"), "title", "tokens", "content_hash"
    )
    return indexed.select(
        *KEY,
        "chunk_index",
        "content",
        metadata.cast(CHUNK_METADATA).alias("metadata"),
        F.col("pk_id").alias("embedding_id"),
        F.lit(vector_status).alias("vector_status"),
    )


def replace_documents(existing, incoming, processed=None):
    """Replace every chunk of each processed document; other documents stay.

    ``processed`` lists the documents that were run again; without it they are
    taken from the incoming chunks, which leaves a document that now has no
    chunk as it was.  The list holds each document once and carries no text, so
    Spark can broadcast it while it is small; for more documents than that keep
    the chunk table bucketed by document (see ``write_chunk_table``), and the
    stored text is not shuffled either.
    """
    replaced = unique_keys(incoming if processed is None else processed, KEY)
    return existing.join(replaced, list(KEY), "left_anti").unionByName(incoming)


def tenant_rows(table, company_id, document_id=None):
    """Rows of one tenant, optionally of one document (both reach the scan)."""
    rows = table.filter(F.col("company_id") == company_id)
    return rows if document_id is None else rows.filter(F.col("document_id") == document_id)


def tenant_chunk_counts(table, company_id):
    return tenant_rows(table, company_id).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_chunks"))


def latest_status(changes, states=DOCUMENT_STATES):
    """Latest state per document of a change log (document, company, status, ts, seq).

    Each task keeps one candidate per document, so a document with most of the
    changes costs nothing extra.  State and order are held as numbers, which
    lets Spark aggregate by hash; text or nested values would make it sort the
    log first.  Any 64-bit change number may break a tie of the time; a missing one
    comes first, as does a missing time.  A state that is not listed is held as its
    hash and looked up among the unlisted changes.
    """
    listed = F.array(*[F.lit(x) for x in states])
    place = F.array_position(listed, F.col("status"))
    code = F.when(place == 0, F.xxhash64("status")).otherwise(place)
    time = F.coalesce(F.unix_micros("ts"), F.lit(NO_TIME)).cast(ORDER) * F.lit(str(SEQ_SPAN)).cast(ORDER)
    order = time + F.coalesce(F.col("seq").cast("long"), F.lit(SEQ_LOWEST)).cast(ORDER)
    latest = changes.groupBy(*KEY).agg(
        F.max_by(code, order.cast(ORDER)).alias("__code"),
        F.max("ts").alias("updated_at"),
        F.count(F.lit(1)).alias("n_changes"),
    )
    other = changes.filter(place == 0).select(*KEY, code.alias("__code"), F.col("status").alias("__other")).distinct()
    known = F.when(F.col("__code").between(1, len(states)), F.get(listed, F.col("__code").cast("int") - 1))
    return latest.join(other, [*KEY, "__code"], "left").select(
        *KEY, F.coalesce(known, "__other").alias("status"), "updated_at", "n_changes"
    )


def retry_candidates(status):
    return status.filter(F.col("status") == "error")


def status_page(status, company_id, limit, after=None):
    """One page of a tenant's documents, newest first, ties by id.

    ``after`` is the (updated_at, document_id) of the last row of the page before.  A
    page by key keeps ``limit`` rows per task however deep it lies.
    """
    rows = tenant_rows(status, company_id)
    if after is not None:
        time, document = after
        rows = rows.filter(
            (F.col("updated_at") < time) | (F.col("updated_at") == time) & (F.col("document_id") > document)
        )
    return rows.orderBy(F.desc("updated_at"), "document_id").limit(limit)


def bulk_delete(table, requested):
    """(remaining, result): rows kept, and each requested id as deleted or failed.

    ``requested`` holds (company_id, document_id).  Ids are deduplicated, and the
    table is cut down to them before its distinct documents are taken.
    """
    ids = unique_keys(requested, KEY)
    remaining = table.join(ids, list(KEY), "left_anti")
    hit = table.select(*KEY).join(ids, list(KEY), "left_semi").distinct()
    present = hit.withColumn("__found", F.lit(True))
    result = ids.join(present, list(KEY), "left").select(
        *KEY,
        F.when(F.col("__found"), F.lit("deleted")).otherwise(F.lit("failed")).alias("outcome"),
    )
    return remaining, result
