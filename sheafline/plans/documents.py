"""Document, chunk-table and status queries."""

from pyspark.sql import functions as F

from sheafline.operators import chunking, documents, joins, progress
from sheafline.plans import inputs
from sheafline.plans.registry import query
from sheafline.plans.sqltext import ISO, chunk_rows
from sheafline.plans.text import PAGES_SQL, SMALL, chunks, page_chunks

TENANT = "src3"
STATUS_TENANT = "c3"
PAGE_LIMIT = 10

CHUNKS_SQL = chunk_rows(inputs.DOCUMENT_TEXT.sql, 1000, 200, "document_id, company_id")
STATUS_SQL = f"""(SELECT company_id, document_id, status, max(ts) OVER w AS updated_at, count(*) OVER w AS n_changes
                  FROM {inputs.STATUS_CHANGES.sql}
                  WINDOW w AS (PARTITION BY company_id, document_id)
                  QUALIFY row_number() OVER (PARTITION BY company_id, document_id ORDER BY ts DESC, seq DESC NULLS LAST) = 1)"""
# Last row of the page before the one that is asked for.
PAGE_AFTER = ("2024-01-30 12:00:00", "50")


def _status(spark, folder):
    return documents.latest_status(inputs.STATUS_CHANGES.frame(spark, folder))


def _printed(status):
    return status.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss"))


@query(
    "chunk_enrich",
    f"""SELECT concat(document_id, '_', chunk_index) AS pk_id, company_id, document_id, chunk_index,
               text AS content, -1 AS page, CAST(NULL AS VARCHAR) AS title,
               CAST(len(string_split(text, ' ')) AS INT) AS tokens, sha256(text) AS content_hash
        FROM {CHUNKS_SQL}""",
)
def chunk_enrich(spark, folder):
    return documents.enrich_chunks(chunks(spark, folder))


@query(
    "chunk_table",
    f"""SELECT company_id, document_id, chunk_index, md5(text) AS content_md5, page,
               CAST(NULL AS VARCHAR) AS title, CAST(len(string_split(text, ' ')) AS INT) AS tokens,
               sha256(text) AS content_hash, concat(document_id, '_', chunk_index) AS embedding_id,
               'created' AS vector_status
        FROM (SELECT document_id, company_id, text, page,
                     CAST(row_number() OVER (PARTITION BY document_id ORDER BY page, chunk_index) - 1 AS INT) AS chunk_index
              FROM {chunk_rows(PAGES_SQL, 12, 3, 'document_id, company_id, page')})""",
)
def chunk_table(spark, folder):
    """Stored chunk rows of the paged documents, metadata unfolded."""
    rows = documents.chunk_table_rows(page_chunks(spark, folder))
    return rows.select(
        "company_id",
        "document_id",
        "chunk_index",
        F.md5("content").alias("content_md5"),
        "metadata.*",
        "embedding_id",
        "vector_status",
    )


@query(
    "chunk_upsert",
    f"""SELECT company_id, document_id, chunk_index, text FROM {CHUNKS_SQL}
        WHERE (company_id, document_id) NOT IN (SELECT company_id, document_id FROM {inputs.LABELLED.sql})
        UNION ALL
        SELECT company_id, document_id, chunk_index, text
        FROM {chunk_rows(inputs.DOCUMENT_TEXT.sql, 40, 8, 'document_id, company_id')}
        WHERE (company_id, document_id) IN (SELECT company_id, document_id FROM {inputs.LABELLED.sql})""",
)
def chunk_upsert(spark, folder):
    """Labelled documents are processed again with smaller chunks and replace their old ones."""
    texts = inputs.DOCUMENT_TEXT.frame(spark, folder, spread_out=True)
    labelled = inputs.LABELLED.frame(spark, folder).distinct()
    again = texts.join(labelled, ["company_id", "document_id"], "left_semi")
    columns = ["company_id", "document_id", "chunk_index", "text"]
    old = chunking.chunk_text(texts).select(*columns)
    new = chunking.chunk_text(again, SMALL).select(*columns)
    return documents.replace_documents(old, new, processed=labelled)


@query(
    "tenant_count",
    f"""SELECT company_id, document_id, count(*) AS n_chunks FROM {CHUNKS_SQL}
        WHERE company_id = '{TENANT}' GROUP BY ALL""",
)
def tenant_count(spark, folder):
    return documents.tenant_chunk_counts(chunks(spark, folder), TENANT)


@query(
    "document_status",
    f"""SELECT company_id, document_id, status, strftime(updated_at, {ISO}) AS updated_at, n_changes
        FROM {STATUS_SQL}""",
)
def document_status(spark, folder):
    return _printed(_status(spark, folder))


@query(
    "retry_candidates",
    f"SELECT company_id, document_id FROM {STATUS_SQL} WHERE status = 'error'",
)
def retry_candidates(spark, folder):
    return documents.retry_candidates(_status(spark, folder)).select("company_id", "document_id")


@query(
    "status_page",
    f"""SELECT document_id, status, strftime(updated_at, {ISO}) AS updated_at FROM (
          SELECT * FROM {STATUS_SQL} WHERE company_id = '{STATUS_TENANT}'
            AND (updated_at < TIMESTAMP '{PAGE_AFTER[0]}' OR updated_at = TIMESTAMP '{PAGE_AFTER[0]}' AND document_id > '{PAGE_AFTER[1]}')
          ORDER BY updated_at DESC, document_id LIMIT {PAGE_LIMIT})""",
)
def status_page(spark, folder):
    after = (F.to_timestamp(F.lit(PAGE_AFTER[0])), PAGE_AFTER[1])
    page = documents.status_page(_status(spark, folder), STATUS_TENANT, PAGE_LIMIT, after)
    return _printed(page).select("document_id", "status", "updated_at")


@query(
    "bulk_delete",
    f"""SELECT r.company_id, r.document_id,
               CASE WHEN (r.company_id, r.document_id) IN (SELECT company_id, document_id FROM {inputs.DOCUMENT_TEXT.sql})
                    THEN 'deleted' ELSE 'failed' END AS outcome
        FROM (SELECT DISTINCT concat('src', CAST(n % 20 AS VARCHAR)) AS company_id, CAST(n * 2 AS VARCHAR) AS document_id
              FROM (SELECT doc_id AS n FROM labels)) r""",
)
def bulk_delete(spark, folder):
    """Requested ids follow the labels; some name no document of that tenant."""
    requested = inputs.Derived(
        "labels",
        {
            "company_id": "concat('src', CAST(doc_id % 20 AS STRING))",
            "document_id": "CAST(doc_id * 2 AS STRING)",
        },
    ).frame(spark, folder)
    _, result = documents.bulk_delete(inputs.DOCUMENT_TEXT.frame(spark, folder), requested)
    return result


@query(
    "bulk_delete_remaining",
    f"""SELECT company_id, document_id FROM {inputs.DOCUMENT_TEXT.sql}
        WHERE (company_id, document_id) NOT IN (SELECT company_id, document_id FROM {inputs.LABELLED.sql})""",
)
def bulk_delete_remaining(spark, folder):
    remaining, _ = documents.bulk_delete(
        inputs.DOCUMENT_TEXT.frame(spark, folder), inputs.LABELLED.frame(spark, folder)
    )
    return remaining.select("company_id", "document_id")


@query(
    "status_reconcile",
    f"""SELECT d.company_id, d.document_id, coalesce(n_chunks, 0) AS chunk_count, l.path IS NOT NULL AS object_exists,
               coalesce(n_vectors, 0) AS vector_count, coalesce(n_chunks, 0) = coalesce(n_vectors, 0) AS in_sync
        FROM {inputs.FILED_DOCUMENTS.sql} d
        LEFT JOIN (SELECT company_id, document_id, count(*) AS n_chunks FROM {CHUNKS_SQL} GROUP BY ALL) c
          USING (company_id, document_id)
        LEFT JOIN (SELECT company_id, document_id, count(DISTINCT chunk_id) AS n_vectors
                   FROM {inputs.VECTORS.sql} GROUP BY ALL) v USING (company_id, document_id)
        LEFT JOIN (SELECT DISTINCT path FROM {inputs.LISTING.sql}) l ON l.path = d.s3_path""",
)
def status_reconcile(spark, folder):
    return joins.reconcile_status(
        inputs.FILED_DOCUMENTS.frame(spark, folder),
        inputs.LISTING.frame(spark, folder),
        chunks(spark, folder),
        inputs.VECTORS.frame(spark, folder),
    )


@query(
    "duplicate_guard",
    f"""SELECT u.document_id, u.company_id, u.filename, e.filename IS NULL AS accepted
        FROM {inputs.FILED_DOCUMENTS.sql} u
        LEFT JOIN (SELECT DISTINCT company_id, filename FROM {inputs.EXISTING_FILES.sql} WHERE status <> 'error') e
          ON u.company_id = e.company_id AND u.filename = e.filename""",
)
def duplicate_guard(spark, folder):
    flagged = joins.flag_duplicates(
        inputs.FILED_DOCUMENTS.frame(spark, folder), inputs.EXISTING_FILES.frame(spark, folder)
    )
    return flagged.select("document_id", "company_id", "filename", "accepted")


UPLOAD_BATCH = inputs.Derived(
    "events",
    {
        # a document under several names, some names and tenants missing, some uploads sent twice
        "document_id": "CASE WHEN event_id % 13 <> 0 THEN CAST(event_id % 2500 AS STRING) END",
        "company_id": "CASE WHEN event_id % 17 <> 0 THEN concat('c', CAST(user_id % 7 AS STRING)) END",
        "filename": "CASE WHEN event_id % 19 <> 0 THEN concat(event_type, ' ', CAST(user_id AS STRING), '.txt') END",
        "arrival": "CASE WHEN event_id % 5 <> 0 THEN event_id % 2500 END",
    },
)
STORED_NAMES = inputs.Derived(
    "labels",
    {
        "company_id": "concat('c', CAST(doc_id % 7 AS STRING))",
        "filename": "concat('view ', CAST(doc_id AS STRING), '.txt')",
        "status": "CASE WHEN toxic = 1 THEN 'error' ELSE 'processed' END",
    },
)


@query(
    "duplicate_guard_batch",
    f"""SELECT document_id, company_id, filename, company_id IS NULL OR filename IS NULL OR (nth = 1 AND NOT EXISTS (
          SELECT 1 FROM {STORED_NAMES.sql} e WHERE e.company_id = u.company_id AND e.filename = u.filename AND status <> 'error')) AS accepted
        FROM (SELECT *, row_number() OVER (PARTITION BY company_id, filename ORDER BY arrival NULLS LAST, document_id NULLS FIRST) AS nth
              FROM {UPLOAD_BATCH.sql}) u""",
)
def duplicate_guard_batch(spark, folder):
    """Repeated names inside one batch of uploads: the first to arrive wins."""
    flagged = joins.flag_duplicates(
        UPLOAD_BATCH.frame(spark, folder), STORED_NAMES.frame(spark, folder), "arrival"
    )
    return flagged.select("document_id", "company_id", "filename", "accepted")


# A log with late changes, illegal steps, unknown and missing states, and changes of no document.
STATUS_LOG = inputs.Derived(
    "events",
    {
        "company_id": "CASE WHEN event_id % 101 <> 0 THEN concat('c', CAST(user_id % 7 AS STRING)) END",
        "document_id": "concat(CAST(user_id AS STRING), '/', CAST(event_id % 5 AS STRING))",
        "status": (
            "CASE event_type WHEN 'signup' THEN 'pending' WHEN 'click' THEN 'uploaded' WHEN 'view' THEN 'processing' "
            "WHEN 'purchase' THEN CASE WHEN event_id % 4 <> 0 THEN 'processed' WHEN event_id % 8 = 0 THEN 'indexed' END "
            "ELSE 'error' END"
        ),
        "ts": "CASE WHEN event_id % 9 = 0 THEN ts - INTERVAL '2' DAY WHEN event_id % 97 <> 0 THEN ts END",
        "seq": inputs.STATUS_CHANGES.columns["seq"],
        "chunk_count": "CASE event_type WHEN 'purchase' THEN event_id % 40 END",
        "error_message": "CASE event_type WHEN 'error' THEN concat('failure ', CAST(event_id AS STRING)) END",
    },
)
_LEGAL_SQL = ", ".join(f"'{before or ''}>{after}'" for before, steps in progress.LEGAL_STEPS.items() for after in steps)
_KNOWN_SQL = ", ".join(f"'{s}'" for s in progress.LEGAL_STEPS if s)
_STEPS_SQL = f"""WITH RECURSIVE log AS (SELECT *, row_number() OVER (PARTITION BY company_id, document_id
            ORDER BY ts NULLS FIRST, seq NULLS FIRST, status NULLS FIRST, chunk_count NULLS FIRST, error_message NULLS FIRST) AS nth
        FROM {STATUS_LOG.sql}),
    walk AS (
        SELECT company_id, document_id, CAST(0 AS BIGINT) AS nth, CAST(NULL AS VARCHAR) AS before, false AS legal, CAST(NULL AS VARCHAR) AS state
        FROM (SELECT DISTINCT company_id, document_id FROM log WHERE company_id IS NOT NULL)
        UNION ALL
        SELECT l.company_id, l.document_id, l.nth, w.state, coalesce(concat(w.state, '>', l.status) IN ({_LEGAL_SQL}), false) AND l.status IS NOT NULL,
            CASE WHEN coalesce(concat(w.state, '>', l.status) IN ({_LEGAL_SQL}), false) THEN l.status ELSE w.state END
        FROM walk w JOIN log l ON l.company_id = w.company_id AND l.document_id = w.document_id AND l.nth = w.nth + 1),
    steps AS (
        SELECT l.*, w.before, w.legal FROM log l JOIN walk w USING (company_id, document_id, nth)
        UNION ALL SELECT *, NULL, false FROM log WHERE company_id IS NULL)"""


@query(
    "status_steps",
    f"""{_STEPS_SQL} SELECT company_id, document_id, status, seq, chunk_count, error_message, before, legal,
            CASE WHEN legal THEN NULL WHEN company_id IS NULL THEN 'no_document'
                 WHEN status IN ({_KNOWN_SQL}) THEN 'illegal_step' ELSE 'unknown_state' END AS reason
        FROM steps""",
)
def status_steps(spark, folder):
    """Every state change judged by the state the legal ones before it led to."""
    return progress.status_steps(STATUS_LOG.frame(spark, folder)).drop("ts")


@query(
    "document_progress",
    f"""{_STEPS_SQL}, kept AS (SELECT company_id, document_id,
            list(status ORDER BY nth) FILTER (legal) AS states, list(error_message ORDER BY nth) FILTER (legal) AS messages,
            list(strftime(ts, {ISO}) ORDER BY nth) FILTER (legal) AS times,
            list(chunk_count ORDER BY nth) FILTER (legal AND status = 'processed') AS counts, count(*) FILTER (NOT legal) AS n_illegal
        FROM steps WHERE company_id IS NOT NULL GROUP BY ALL)
        SELECT company_id, document_id, states[-1] AS status, counts[-1] AS chunk_count,
            CASE WHEN states[-1] = 'error' THEN messages[-1] END AS error_message, times[-1] AS updated_at, n_illegal FROM kept""",
)
def document_progress(spark, folder):
    """State, chunk count and error of each document after its legal changes."""
    done = progress.document_progress(progress.status_steps(STATUS_LOG.frame(spark, folder)))
    return done.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss"))
