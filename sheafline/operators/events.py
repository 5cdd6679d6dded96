"""Raw-document and chunk events: projection, validation and routing.

Every operator here is a narrow projection or filter: no shuffle, no Python.
"""

from functools import reduce

from pyspark.sql import functions as F

from sheafline.functions import mime, payload, text

# Upload outcomes, error stages and tenant defaults.
UPLOAD_OK = "success"
UPLOAD_CLIENT_ERROR = "error_client"
UPLOAD_SERVER_ERROR = "error_server"
STAGE_VALIDATION = "validation"
STAGE_DOWNLOAD = "s3_download"
STAGE_UNKNOWN = "unknown"
DEFAULT_COMPANY = "default-company"
UNKNOWN_COMPANY = "unknown"


def upload_status(uploads, stored="stored"):
    """Add ``status``: client error for a refused type, server error for a failed store."""
    return uploads.withColumn(
        "status",
        F.when(~mime.is_accepted(F.col("content_type")), F.lit(UPLOAD_CLIENT_ERROR))
        .when(~F.coalesce(F.col(stored), F.lit(False)), F.lit(UPLOAD_SERVER_ERROR))
        .otherwise(F.lit(UPLOAD_OK)),
    )


def with_accepted(uploads):
    return uploads.withColumn("accepted", mime.is_accepted(F.col("content_type")))


def split_by_type(uploads):
    """(accepted, rejected) uploads by content type."""
    accepted = mime.is_accepted(F.col("content_type"))
    return uploads.filter(accepted), uploads.filter(~accepted)


def default_company(df, default=DEFAULT_COMPANY):
    """Fill a tenant that was not sent at all."""
    return df.withColumn("company_id", F.coalesce("company_id", F.lit(default)))


def raw_events(uploads):
    """Upload rows (document_id, company_id, filename, content_type) to raw events."""
    name = text.normalize_filename(F.col("filename"))
    return uploads.select(
        "document_id",
        "company_id",
        text.object_path(F.col("company_id"), F.col("document_id"), name).alias("s3_path"),
        "content_type",
    )


def decoded_rows(messages, schema, value="value"):
    """Broker rows with ``payload``, a struct of the fields, or with the ``reason`` why there is none.

    One result for good and bad messages, parsed once: write it, or hand it to a stream's
    fan-out, where both are wanted.
    """
    parsed = messages.withColumn("__json", payload.decode(F.col(value)))
    good = payload.is_object(F.col("__json"))
    reason = F.when(good, None).when(payload.is_valid(F.col("__json")), "not_an_object").otherwise("invalid_json")
    told = parsed.withColumn("reason", reason)
    fields = F.from_json(F.when(F.col("reason").isNull(), F.col(value)), schema)
    return told.withColumn("payload", fields).select(*messages.columns, "payload", "reason")


def decode_messages(messages, schema, value="value"):
    """Split broker rows into (decoded, quarantined).

    Decoded rows carry the payload fields next to the broker columns.  Messages
    that are not a JSON object are quarantined whole, with a reason, instead of
    being dropped or stopping the consumer.  Each side parses for itself; see
    :func:`decoded_rows` for both from one pass.
    """
    rows = decoded_rows(messages, schema, value)
    keep = [c for c in messages.columns if c != value]
    good = rows.filter("reason IS NULL").select(*keep, "payload.*")
    return good, rows.filter("reason IS NOT NULL").select(*messages.columns, "reason")


def with_content_type(events):
    """Use the declared type, else guess it from the object path."""
    return events.withColumn(
        "content_type", mime.infer_content_type(F.col("content_type"), F.col("s3_path"))
    )


def with_stage(events, required=("s3_path", "document_id", "content_type", "company_id")):
    """Add ``stage``: ``validation`` when a required field is null or empty."""
    filled = reduce(
        lambda a, b: a & b, [F.coalesce(F.length(F.col(c)) > 0, F.lit(False)) for c in required]
    )
    return events.withColumn("stage", F.when(~filled, F.lit(STAGE_VALIDATION)))


def validate(events):
    """(valid, rejected) events after content-type inference."""
    staged = with_stage(with_content_type(events))
    return staged.filter("stage IS NULL").drop("stage"), staged.filter("stage IS NOT NULL")


def with_text(chunks):
    """Chunks that can be embedded: text present and not null (empty text passes)."""
    return chunks.filter(F.col("text").isNotNull())


def tenant_counts(messages, value="value"):
    """Message count per safely parsed tenant."""
    parsed = messages.select(payload.decode(F.col(value)).alias("__json"))
    return parsed.groupBy(payload.safe_tenant(F.col("__json")).alias("company_id")).agg(
        F.count(F.lit(1)).alias("n_messages")
    )


def topic_union(**topics):
    """One table over several topics' broker rows, with the topic kept as a column."""
    frames = [df.withColumn("topic", F.lit(name)) for name, df in topics.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)
