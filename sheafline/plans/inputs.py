"""Records the queries work on, derived row by row from the given tables.

Each derivation is a list of SQL expressions both engines understand, so the
query and its SQL counterpart start from the same rows; where the spelling
differs a pair gives both.  Every row of the source table is kept.
"""

from dataclasses import dataclass

from sheafline.sources.tables import dealt, read_table


@dataclass(frozen=True)
class Derived:
    table: str
    columns: dict

    @property
    def sql(self):
        items = ", ".join(f"{_spelling(e, 1)} AS {n}" for n, e in self.columns.items())
        return f"(SELECT {items} FROM {self.table})"

    @property
    def expressions(self):
        return [f"{_spelling(e, 0)} AS {n}" for n, e in self.columns.items()]

    def frame(self, spark, folder, spread_out=False):
        source = read_table(spark, folder, self.table)
        source = dealt(source) if spread_out else source
        return source.selectExpr(*self.expressions)


def _spelling(expression, engine):
    return expression if isinstance(expression, str) else expression[engine]


ID = "CAST(doc_id AS STRING)"
SOURCE_NO = "CAST(substring(source, 4) AS INT)"

# Uploaded files: names with irregular blanks, types that are accepted, written
# differently, unknown, empty or missing, depending on the source.
UPLOADS = Derived(
    "documents",
    {
        "document_id": ID,
        "company_id": "source",
        "filename": (
            "concat('  notes\t ', lang, '　\n', " + ID + ", "
            "CASE lang WHEN 'en' THEN '.txt' WHEN 'fr' THEN '.v2.MD' WHEN 'de' THEN ' .pdf' "
            "ELSE '.tar.gz' END, ' ')"
        ),
        "content_type": (
            f"CASE {SOURCE_NO} WHEN 0 THEN 'application/pdf' "
            "WHEN 1 THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document' "
            "WHEN 2 THEN 'application/msword' WHEN 3 THEN 'text/plain' WHEN 4 THEN 'text/markdown' "
            "WHEN 5 THEN 'text/html' "
            "WHEN 6 THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet' "
            "WHEN 7 THEN 'application/vnd.ms-excel' WHEN 8 THEN 'text/html; charset=utf-8' "
            "WHEN 9 THEN ' Text/HTML ;charset=utf-8' WHEN 10 THEN 'image/png' "
            "WHEN 11 THEN 'TEXT/PLAIN' WHEN 12 THEN '' WHEN 13 THEN NULL ELSE 'text/plain' END"
        ),
        "stored": "n_chars % 7 <> 0",
        "size_bytes": ("octet_length(text)", "octet_length(encode(text))"),
    },
)

# Raw events over the same files; some lack a tenant, a path or a type.
EVENTS = Derived(
    "documents",
    {
        "document_id": ID,
        "company_id": f"CASE {SOURCE_NO} WHEN 14 THEN '' WHEN 15 THEN NULL ELSE source END",
        "s3_path": (
            f"CASE {SOURCE_NO} WHEN 16 THEN '' ELSE concat('pages/', {ID}, '.html') END"
        ),
        "content_type": UPLOADS.columns["content_type"],
    },
)

DOCUMENT_TEXT = Derived(
    "documents", {"document_id": ID, "company_id": "source", "text": "text"}
)

# Events with their files: some invalid, some without a file, some no reader takes or that
# cannot be parsed, and long lines of marks beside plain texts.
_MARKS = "repeat(substring('*-_', CAST(1 + doc_id % 3 AS INT), 1), 20000)"
_BODY = f"CASE {SOURCE_NO} WHEN 17 THEN '<![foo bar]>x' WHEN 18 THEN {_MARKS} ELSE text END"
FILES = Derived(
    "documents",
    {
        "document_id": ID,
        "company_id": EVENTS.columns["company_id"],
        "s3_path": f"CASE {SOURCE_NO} WHEN 16 THEN '' ELSE concat('docs/', {ID}, '.txt') END",
        "content_type": (
            f"CASE {SOURCE_NO} WHEN 10 THEN ' TEXT/Plain ;charset=utf-8' WHEN 12 THEN 'image/png' WHEN 13 THEN '' "
            "WHEN 17 THEN 'text/html' WHEN 18 THEN 'text/markdown' WHEN 19 THEN NULL ELSE 'text/plain' END"
        ),
        "content": tuple(
            f"CASE WHEN doc_id % 7 <> 3 THEN {encode.format(_BODY)} END" for encode in ("encode({}, 'UTF-8')", "encode({})")
        ),
    },
)

# Objects of a store: web pages as files.
OBJECTS = Derived(
    "pages",
    {"path": "concat('pages/', CAST(page_id AS STRING), '.html')", "content": ("encode(html, 'UTF-8')", "encode(html)")},
)

# A listing that holds only the labelled documents.
LISTING = Derived("labels", {"path": "concat('docs/', CAST(doc_id AS STRING), '.txt')"})
FILED_DOCUMENTS = Derived(
    "documents",
    {
        "document_id": ID,
        "company_id": "source",
        "s3_path": f"concat('docs/', {ID}, '.txt')",
        "filename": f"concat('doc ', {ID}, '.txt')",
    },
)
EXISTING_FILES = Derived(
    "labels",
    {
        "company_id": "concat('src', CAST(doc_id % 20 AS STRING))",
        "filename": "concat('doc ', CAST(doc_id AS STRING), '.txt')",
        "status": "CASE WHEN toxic = 1 THEN 'error' ELSE 'processed' END",
    },
)
LABELLED = Derived(
    "labels",
    {
        "company_id": "concat('src', CAST(doc_id % 20 AS STRING))",
        "document_id": ID,
    },
)

VECTORS = Derived(
    "embeddings",
    {
        "chunk_id": "CAST(vec_id AS STRING)",
        "document_id": "CAST(vec_id AS STRING)",
        "company_id": "concat('src', CAST(vec_id % 20 AS STRING))",
        "tenant": "CAST(label AS STRING)",
        "vector": "embedding",
    },
)

# Vectors as a search meets them: some null, some too short.
DAMAGED_VECTORS = Derived(
    "embeddings",
    {
        **{k: v for k, v in VECTORS.columns.items() if k != "vector"},
        "vector": (
            "CASE WHEN vec_id % 7 = 0 THEN NULL WHEN vec_id % 5 = 0 THEN slice(embedding, 1, 63) ELSE embedding END",
            "CASE WHEN vec_id % 7 = 0 THEN NULL WHEN vec_id % 5 = 0 THEN embedding[1:63] ELSE embedding END",
        ),
    },
)

# Messages of every shape a consumer meets: objects with and without the tenant,
# an explicit null, numbers, arrays, bare strings, broken text and no value.
MESSAGES = Derived(
    "events",
    {
        "event_id": "event_id",
        "value": (
            "CASE user_id % 9 "
            "WHEN 0 THEN concat('{\"company_id\":\"', event_type, '\",\"chunk_id\":', event_id, '}') "
            "WHEN 1 THEN concat('{\"company_id\":', user_id, '}') "
            "WHEN 2 THEN concat('{\"company_id\":null,\"chunk_id\":', event_id, '}') "
            "WHEN 3 THEN concat('{\"x\":', event_id, '}') "
            "WHEN 4 THEN concat('not json ', event_id) "
            "WHEN 5 THEN concat('[\"company_id\",', event_id, ']') "
            "WHEN 6 THEN '\"company_id\"' "
            "WHEN 7 THEN CAST(NULL AS STRING) "
            "ELSE concat('{\"company_id\":\"', event_type, '\",\"chunk_id\":', event_id) END"
        ),
    },
)

# Broker rows: one well-formed message per event.
BROKER_ROWS = Derived(
    "events",
    {
        "key": "CAST(user_id AS STRING)",
        "value": (
            "concat('{\"chunk_id\":\"', event_id, '\",\"document_id\":\"', user_id, "
            "'\",\"company_id\":\"', event_type, '\"}')"
        ),
        "topic": "CASE WHEN event_type = 'view' THEN 'chunks.processed' ELSE 'embeddings.ready' END",
        "timestamp": "ts",
    },
)

# State changes of documents.
STATUS_CHANGES = Derived(
    "events",
    {
        "document_id": "CAST(user_id AS STRING)",
        "company_id": "concat('c', CAST(user_id % 7 AS STRING))",
        "status": (
            "CASE event_type WHEN 'signup' THEN 'pending' WHEN 'click' THEN 'uploaded' "
            "WHEN 'view' THEN 'processing' WHEN 'purchase' THEN concat('processed', "
            "CASE WHEN event_id % 4 = 0 THEN ' twice' ELSE '' END) ELSE 'error' END"
        ),
        "ts": "ts",
        # large numbers in another order than the times, some missing
        "seq": "CASE WHEN event_id % 11 <> 0 THEN 1800000000000000000 + (event_id * 7919) % 1000003 END",
    },
)

# Measurements: one request per event, with the event's value as its duration.
REQUESTS = Derived(
    "events",
    {
        "ts": "ts",
        "company_id": "CAST(user_id AS STRING)",
        "content_type": "event_type",
        "status": (
            "CASE WHEN value < 20 THEN 'success' WHEN value < 60 THEN 'error_client' "
            "ELSE 'error_server' END"
        ),
        "stage": "CASE WHEN value < 10 THEN 'validation' WHEN value < 50 THEN 's3_download' ELSE 'unknown' END",
        "event_type": "event_type",
        "value": "value",
    },
)
