"""Streaming queries: each runs its job to the end of the available data."""

from pyspark.sql import functions as F

from sheafline.operators import extraction, reports
from sheafline.plans import inputs
from sheafline.plans.registry import query
from sheafline.plans.reports import AS_OF, LANDED_SQL, _window_sql
from sheafline.plans.sqltext import ISO, chunk_id, chunk_rows
from sheafline.plans.text import HTML_TEXT_SQL
from sheafline.session import prepare, shared_folder
from sheafline.sinks.tables import LANDING_LAYOUT, stream_landing, stream_layer, write_raw_objects
from sheafline.sources.landing import read_landing
from sheafline.schemas import CHUNK, EMBEDDING, EMBEDDING_KEYS
from sheafline.streaming import counters, stages

ALL_AVAILABLE = {"availableNow": True}


def stream_of(derived, spark, folder):
    """A derived input read as a file stream."""
    path = f"{folder.rstrip('/')}/{derived.table}.parquet"
    schema = prepare(spark).read.parquet(path).schema
    # as a glob, because a plain stream path must be a folder and a table may be one file
    rows = spark.readStream.schema(schema).parquet(f"{folder.rstrip('/')}/{{{derived.table}.parquet}}")
    naive = [f.name for f in schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    rows = rows.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else rows
    return rows.selectExpr(*derived.expressions)


@query(
    "stream_window_1m",
    f"""SELECT * FROM ({_window_sql('1 minute')})
        WHERE window_end <= (SELECT strftime(max(ts) - INTERVAL '5 seconds', {ISO}) FROM events)""",
)
def stream_window_1m(spark, folder):
    """Every window the watermark has closed, once; the newest one is still open."""
    work = shared_folder(spark, "stream-window")
    counts = counters.event_time_counts(stream_of(inputs.BROKER_ROWS, spark, folder))
    stream_layer(counts, f"{work}/rt", f"{work}/checkpoint", ALL_AVAILABLE).awaitTermination()
    return reports.iso_bounds(spark.read.schema(counts.schema).parquet(f"{work}/rt"))


@query(
    "stream_chunks",
    f"""SELECT {chunk_id()} AS chunk_id, document_id, company_id, text, -1 AS page
        FROM {chunk_rows(inputs.DOCUMENT_TEXT.sql, 1000, 200, 'document_id, company_id')}""",
)
def stream_chunks(spark, folder):
    """Raw objects to the chunk layer as a stream."""
    work = shared_folder(spark, "stream-chunks")
    objects = stream_of(inputs.DOCUMENT_TEXT, spark, folder).select(
        "document_id",
        "company_id",
        F.concat(F.lit("docs/"), "document_id").alias("s3_path"),
        F.encode("text", "UTF-8").alias("content"),
        F.lit("text/plain").alias("content_type"),
    )
    stages.start_extraction_layer(objects, work, ALL_AVAILABLE).awaitTermination()
    stages.start_chunk_layer(spark, work, trigger=ALL_AVAILABLE).awaitTermination()
    return spark.read.schema(CHUNK).parquet(f"{work}/processed")


# Stage and text of every file, from what is known of it.
FILES_SQL = f"""(SELECT f.*, d.text, CAST(substring(d.source, 4) AS INT) AS no,
        CASE WHEN coalesce(f.company_id, '') = '' OR f.s3_path = '' THEN 'validation'
             WHEN f.content IS NULL THEN 's3_download'
             WHEN CAST(substring(d.source, 4) AS INT) IN (12, 17) THEN 'unknown' END AS stage
    FROM {inputs.FILES.sql} f JOIN documents d ON f.document_id = CAST(d.doc_id AS VARCHAR))"""
# A long line of marks is a rule.
FILE_TEXT_SQL = "CASE no WHEN 18 THEN '* * *' ELSE text END"


@query(
    "extract_errors",
    f"""SELECT document_id, stage, stage IS NOT NULL AS has_error,
               CASE WHEN stage IS NULL THEN md5({FILE_TEXT_SQL}) END AS text_md5 FROM {FILES_SQL}""",
)
def extract_errors(spark, folder):
    """Good files beside every kind of failure: each is a row, none stops the job."""
    done = extraction.extract_events(inputs.FILES.frame(spark, folder))
    return done.select(
        "document_id",
        "stage",
        F.col("error").isNotNull().alias("has_error"),
        F.md5(F.get("pages", F.lit(0))["text"]).alias("text_md5"),
    )


@query(
    "stream_dead_letters",
    f"SELECT document_id, company_id, s3_path, stage, true AS has_error FROM {FILES_SQL} WHERE stage IS NOT NULL",
)
def stream_dead_letters(spark, folder):
    """Failures of validation, download and extraction in one table, as a stream."""
    work = shared_folder(spark, "stream-dead-letters")
    stages.start_extraction_layer(stream_of(inputs.FILES, spark, folder), work, ALL_AVAILABLE).awaitTermination()
    stages.start_dead_letter_layer(spark, work, ALL_AVAILABLE).awaitTermination()
    dead = spark.read.schema(stages.DEAD_LETTER).parquet(f"{work}/dead_letters")
    return dead.select("document_id", "company_id", "s3_path", "stage", F.col("error").isNotNull().alias("has_error"))


# Web pages that arrive after the files.
LATER_FILES = inputs.Derived(
    "pages",
    {
        "document_id": "concat('page-', CAST(page_id AS STRING))",
        "company_id": "concat('src', CAST(page_id % 20 AS STRING))",
        "s3_path": "concat('pages/', CAST(page_id AS STRING), '.html')",
        "content_type": "CAST(NULL AS STRING)",
        "content": ("encode(html, 'UTF-8')", "encode(html)"),
    },
)
FILES_PER_TRIGGER = 8


@query(
    "stream_chain",
    f"""WITH texts AS (
          SELECT document_id, company_id, {FILE_TEXT_SQL} AS text FROM {FILES_SQL} WHERE stage IS NULL
          UNION ALL SELECT concat('page-', page_id), concat('src', page_id % 20), text
          FROM pages JOIN ({HTML_TEXT_SQL}) USING (page_id))
        SELECT company_id, document_id, '2024-01-31' AS processing_date, count(*) AS total_chunks_processed
        FROM {chunk_rows('texts', 1000, 200, 'document_id, company_id')} GROUP BY ALL""",
)
def stream_chain(spark, folder):
    """Raw objects, text, chunks, vectors and the report on them; restarted for later objects.

    Every layer goes on from its checkpoint, over several micro-batches per run.
    """
    work = shared_folder(spark, "stream-chain")
    for arrived in (inputs.FILES, LATER_FILES):
        write_raw_objects(arrived.frame(spark, folder), f"{work}/raw")
        kinds = spark.read.parquet(f"{work}/raw").schema
        raw = spark.readStream.schema(kinds).option("maxFilesPerTrigger", FILES_PER_TRIGGER).parquet(f"{work}/raw")
        stages.start_extraction_layer(raw, work, ALL_AVAILABLE).awaitTermination()
        stages.start_chunk_layer(spark, work, trigger=ALL_AVAILABLE).awaitTermination()
        stages.start_embedding_layer(spark, work, 16, ALL_AVAILABLE).awaitTermination()
    vectors = spark.read.schema(EMBEDDING).parquet(f"{work}/embeddings")
    return reports.daily_report(vectors, AS_OF).withColumn("processing_date", F.col("processing_date").cast("string"))


# Tasks a folder with most of the records is split over.
LANDING_SPLIT = 4


@query(
    "stream_landing",
    f"""SELECT topic, year, month, day, hour, value ->> '$.chunk_id' AS chunk_id,
               value ->> '$.document_id' AS document_id, value ->> '$.company_id' AS company_id
        FROM {LANDED_SQL}""",
)
def stream_landing_rows(spark, folder):
    """Messages landed as JSON by topic and hour, read back with a schema."""
    work = shared_folder(spark, "stream-landing")
    rows = stream_of(inputs.BROKER_ROWS, spark, folder)
    stream_landing(
        rows,
        f"{work}/landing",
        f"{work}/checkpoint",
        trigger=ALL_AVAILABLE,
        tasks=spark.sparkContext.defaultParallelism,
        split=LANDING_SPLIT,
    ).awaitTermination()
    landed = read_landing(spark, f"{work}/landing", EMBEDDING_KEYS)
    return landed.select(*LANDING_LAYOUT, *EMBEDDING_KEYS.names)
