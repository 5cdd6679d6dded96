"""Upload and event queries."""

from pyspark.sql import functions as F

from sheafline.functions import mime, payload, text
from sheafline.operators import chunking, events
from sheafline.plans import inputs
from sheafline.plans.registry import query
from sheafline.plans.sqltext import WS, chunk_id, chunk_rows
from sheafline.sinks.topics import keyed_json
from sheafline.sources.tables import read_table

ACCEPTED_SQL = ", ".join(f"'{t}'" for t in mime.ACCEPTED_TYPES)
NORMAL_NAME_SQL = f"trim(regexp_replace(filename, '[{WS}]+', ' ', 'g'))"
PATH_SQL = f"concat_ws('/', company_id, document_id, {NORMAL_NAME_SQL})"
READER_SQL = (
    "CASE lower(trim(split_part(content_type, ';', 1))) "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mime.READERS.items())
    + " END"
)
GUESS_SQL = (
    "CASE WHEN {p} LIKE '%.html' THEN 'text/html' WHEN {p} LIKE '%.txt' THEN 'text/plain' "
    "WHEN lower({p}) LIKE '%.md' THEN 'text/markdown' WHEN {p} LIKE '%.pdf' THEN 'application/pdf' "
    "WHEN {p} LIKE '%.tar.gz' THEN 'application/x-tar' END"
)
OBJECT_SQL = "coalesce(json_type(TRY_CAST(value AS JSON)) = 'OBJECT', false)"


@query(
    "content_type_filter",
    f"""SELECT document_id, content_type, coalesce(content_type IN ({ACCEPTED_SQL}), false) AS accepted
        FROM {inputs.UPLOADS.sql}""",
)
def content_type_filter(spark, folder):
    uploads = events.with_accepted(inputs.UPLOADS.frame(spark, folder))
    return uploads.select("document_id", "content_type", "accepted")


@query(
    "normalize_filename",
    f"SELECT document_id, {NORMAL_NAME_SQL} AS filename FROM {inputs.UPLOADS.sql}",
)
def normalize_filename(spark, folder):
    uploads = inputs.UPLOADS.frame(spark, folder)
    return uploads.select("document_id", text.normalize_filename(F.col("filename")).alias("filename"))


@query(
    "object_path",
    f"""SELECT s3_path, regexp_extract(s3_path, '[^/]*$') AS file_name
        FROM (SELECT {PATH_SQL} AS s3_path FROM {inputs.UPLOADS.sql})""",
)
def object_path(spark, folder):
    raw = events.raw_events(inputs.UPLOADS.frame(spark, folder))
    return raw.select("s3_path", text.basename(F.col("s3_path")).alias("file_name"))


@query(
    "raw_events",
    f"""SELECT document_id, company_id, {PATH_SQL} AS s3_path, content_type
        FROM {inputs.UPLOADS.sql}""",
)
def raw_events(spark, folder):
    return events.raw_events(inputs.UPLOADS.frame(spark, folder))


@query(
    "upload_status",
    f"""SELECT company_id, content_type, status, count(*) AS n_uploads FROM (
          SELECT *, CASE WHEN content_type IS NULL OR content_type NOT IN ({ACCEPTED_SQL}) THEN 'error_client'
                         WHEN NOT stored THEN 'error_server' ELSE 'success' END AS status
          FROM {inputs.UPLOADS.sql}) GROUP BY ALL""",
)
def upload_status(spark, folder):
    rated = events.upload_status(inputs.UPLOADS.frame(spark, folder))
    return rated.groupBy("company_id", "content_type", "status").agg(
        F.count(F.lit(1)).alias("n_uploads")
    )


@query(
    "tenant_default",
    f"""SELECT event_id, CASE WHEN json_exists(TRY_CAST(value AS JSON), '$.company_id')
                              THEN TRY_CAST(value AS JSON) ->> '$.company_id' ELSE 'unknown' END AS company_id,
               coalesce(nullif(kind, 'x'), 'default-company') AS sent_company
        FROM (SELECT *, CASE WHEN value LIKE '[%' THEN 'x' ELSE 'tenant' END AS kind FROM {inputs.MESSAGES.sql})
        WHERE {OBJECT_SQL} OR kind = 'x'""",
)
def tenant_default(spark, folder):
    """Both defaults: an absent key in a message, and a tenant that was not sent at all."""
    doc = F.col("doc")
    messages = inputs.MESSAGES.frame(spark, folder).withColumn("doc", payload.decode(F.col("value")))
    is_array = F.coalesce(F.col("value").startswith("["), F.lit(False))
    sent = messages.withColumn("company_id", F.when(~is_array, F.lit("tenant")))
    filled = events.default_company(sent.filter(payload.is_object(doc) | is_array))
    return filled.select(
        "event_id",
        payload.tenant_or(doc, events.UNKNOWN_COMPANY).alias("company_id"),
        F.col("company_id").alias("sent_company"),
    )


@query(
    "json_quarantine",
    f"""SELECT event_id, chunk_id, company_id, reason FROM (
          SELECT event_id,
                 CASE WHEN ok THEN TRY_CAST(value AS JSON) ->> '$.chunk_id' END AS chunk_id,
                 CASE WHEN ok THEN TRY_CAST(value AS JSON) ->> '$.company_id' END AS company_id,
                 CASE WHEN ok THEN NULL WHEN TRY_CAST(value AS JSON) IS NULL THEN 'invalid_json'
                      ELSE 'not_an_object' END AS reason
          FROM (SELECT *, {OBJECT_SQL} AS ok FROM {inputs.MESSAGES.sql}))""",
)
def json_quarantine(spark, folder):
    messages = inputs.MESSAGES.frame(spark, folder)
    good, bad = events.decode_messages(messages, "chunk_id STRING, company_id STRING")
    none = F.lit(None).cast("string")
    return good.select("event_id", "chunk_id", "company_id", none.alias("reason")).unionByName(
        bad.select("event_id", none.alias("chunk_id"), none.alias("company_id"), "reason")
    )


@query(
    "safe_parse_counts",
    f"""SELECT company_id, count(*) AS n_messages FROM (
          SELECT CASE WHEN {OBJECT_SQL} AND json_exists(TRY_CAST(value AS JSON), '$.company_id')
                      THEN TRY_CAST(value AS JSON) ->> '$.company_id' ELSE 'error_parsing' END AS company_id
          FROM {inputs.MESSAGES.sql}) GROUP BY company_id""",
)
def safe_parse_counts(spark, folder):
    return events.tenant_counts(inputs.MESSAGES.frame(spark, folder, spread_out=True))


@query(
    "infer_content_type",
    f"""SELECT document_id, coalesce(nullif(content_type, ''), {GUESS_SQL.format(p='s3_path')}) AS content_type
        FROM (SELECT document_id, content_type, {PATH_SQL} AS s3_path FROM {inputs.UPLOADS.sql})""",
)
def infer_content_type(spark, folder):
    raw = events.raw_events(inputs.UPLOADS.frame(spark, folder))
    return events.with_content_type(raw).select("document_id", "content_type")


@query(
    "validate_events",
    f"""SELECT document_id, content_type,
               CASE WHEN coalesce(company_id, '') = '' OR coalesce(s3_path, '') = ''
                      OR coalesce(document_id, '') = '' OR coalesce(content_type, '') = ''
                    THEN 'validation' END AS stage
        FROM (SELECT * REPLACE (coalesce(nullif(content_type, ''), {GUESS_SQL.format(p='s3_path')}) AS content_type)
              FROM {inputs.EVENTS.sql})""",
)
def validate_events(spark, folder):
    good, bad = events.validate(inputs.EVENTS.frame(spark, folder))
    stage = F.lit(None).cast("string").alias("stage")
    return good.select("document_id", "content_type", stage).unionByName(
        bad.select("document_id", "content_type", "stage")
    )


@query(
    "mime_dispatch",
    f"""SELECT document_id, lower(trim(split_part(content_type, ';', 1))) AS mime, {READER_SQL} AS reader
        FROM {inputs.UPLOADS.sql}""",
)
def mime_dispatch(spark, folder):
    kind = F.col("content_type")
    return inputs.UPLOADS.frame(spark, folder).select(
        "document_id",
        mime.normalize_mime(kind).alias("mime"),
        mime.reader_for(kind).alias("reader"),
    )


@query(
    "nonnull_text",
    """SELECT conv_id, turn, text FROM (
         SELECT conv_id, turn, CASE role WHEN 'system' THEN NULL WHEN 'assistant' THEN '' ELSE text END AS text
         FROM conversations) WHERE text IS NOT NULL""",
)
def nonnull_text(spark, folder):
    turns = read_table(spark, folder, "conversations").selectExpr(
        "conv_id",
        "turn",
        "CASE role WHEN 'system' THEN NULL WHEN 'assistant' THEN '' ELSE text END AS text",
    )
    return events.with_text(turns)


@query(
    "chunk_ids",
    f"""SELECT document_id, chunk_index, {chunk_id()} AS chunk_id
        FROM {chunk_rows(inputs.DOCUMENT_TEXT.sql, 1000, 200, 'document_id')}""",
)
def chunk_ids(spark, folder):
    chunks = chunking.chunk_text(inputs.DOCUMENT_TEXT.frame(spark, folder, spread_out=True))
    return chunking.with_chunk_ids(chunks).select("document_id", "chunk_index", "chunk_id")


@query(
    "topic_union",
    """SELECT topic, key, value FROM (
         SELECT 'documents.raw' AS topic, CAST(doc_id AS VARCHAR) AS key,
                concat('{"document_id":"', doc_id, '","company_id":"', source, '"}') AS value FROM documents
         UNION ALL
         SELECT 'chunks.processed', CAST(conv_id AS VARCHAR),
                concat('{"document_id":"', conv_id, '","page":', turn, '}') FROM conversations
         UNION ALL
         SELECT 'embeddings.ready', CAST(vec_id AS VARCHAR),
                concat('{"document_id":"', vec_id, '","label":', label, '}') FROM embeddings)""",
)
def topic_union(spark, folder):
    def records(table, *fields):
        return keyed_json(read_table(spark, folder, table).selectExpr(*fields))

    return events.topic_union(
        **{
            "documents.raw": records("documents", "CAST(doc_id AS STRING) document_id", "source company_id"),
            "chunks.processed": records("conversations", "CAST(conv_id AS STRING) document_id", "turn page"),
            "embeddings.ready": records("embeddings", "CAST(vec_id AS STRING) document_id", "label"),
        }
    ).select("topic", "key", "value")


@query(
    "keyed_json_out",
    """SELECT CAST(conv_id AS VARCHAR) AS key,
              CAST(json_object('document_id', CAST(conv_id AS VARCHAR), 'page', turn, 'company_id', NULL,
                               'text', text) AS VARCHAR) AS value
       FROM conversations""",
)
def keyed_json_out(spark, folder):
    turns = read_table(spark, folder, "conversations").select(
        F.col("conv_id").cast("string").alias("document_id"),
        F.col("turn").alias("page"),
        F.lit(None).cast("string").alias("company_id"),
        "text",
    )
    return keyed_json(turns)
