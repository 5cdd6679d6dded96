"""Streams with state of their own, each stopped and started again in between."""

import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.functions import payload
from sheafline.operators import events, metrics, reports
from sheafline.operators.chunking import chunk_records, document_summary
from sheafline.plans import inputs
from sheafline.plans.documents import STORED_NAMES, UPLOAD_BATCH
from sheafline.plans.events import OBJECT_SQL
from sheafline.plans.metrics import rate_sql, uploads, window_starts
from sheafline.plans.registry import query
from sheafline.plans.sqltext import ISO, chunk_id, chunk_rows
from sheafline.plans.streams import ALL_AVAILABLE
from sheafline.schemas import CHUNK
from sheafline.session import shared_folder
from sheafline.sinks.fanout import read_fan_out, start_fan_out
from sheafline.sinks.tables import stream_layer
from sheafline.sinks.versions import VersionedTable, start_replacing
from sheafline.streaming import guard, replays, timing, windows

# Where the first run of a stream ends; all events lie within a month.
CUT = "TIMESTAMP '2024-01-16 00:00:00'"


def arrive(rows, path):
    """More rows in a folder that a stream reads."""
    rows.write.mode("append").parquet(path)


def follow(spark, path, schema):
    return spark.readStream.schema(schema).parquet(path)


def message_fields(messages, *names):
    """Fields of well-formed payloads beside the time of the message."""
    doc = F.col("doc")
    fields = [payload.text_field(doc, n).alias(n) for n in names]
    return messages.withColumn("doc", payload.decode(F.col("value"))).select("timestamp", *fields)


ENDS = T.StructType().add("chunk_count", "long").add("first_chunk", "string").add("last_chunk", "string")


def first_and_last(keys, bounds, elements):
    """Number of elements, and the ids of the earliest and the latest one."""
    n, first, last = 0, None, None
    for element in elements:
        n += 1
        first = element if first is None else min(first, element)
        last = element if last is None else max(last, element)
    yield n, first[1], last[1]


@query(
    "stream_window_elements",
    f"""SELECT strftime(w, {ISO}) AS window_start, strftime(w + INTERVAL '1 minute', {ISO}) AS window_end, company_id,
               count(*) AS chunk_count, list(chunk_id ORDER BY timestamp, chunk_id)[1] AS first_chunk,
               list(chunk_id ORDER BY timestamp, chunk_id)[-1] AS last_chunk
        FROM (SELECT time_bucket(INTERVAL '1 minute', timestamp) AS w, timestamp,
                     value ->> '$.company_id' AS company_id, value ->> '$.chunk_id' AS chunk_id FROM {inputs.BROKER_ROWS.sql})
        WHERE w + INTERVAL '1 minute' <= (SELECT max(ts) - INTERVAL '5 seconds' FROM events)
        GROUP BY w, company_id""",
)
def stream_window_elements(spark, folder):
    """A function over each closed window's elements; windows stay open across a restart."""
    work = shared_folder(spark, "stream-elements")
    rows = inputs.BROKER_ROWS.frame(spark, folder)
    for part in (f"timestamp < {CUT}", f"timestamp >= {CUT}"):
        arrive(rows.where(part), f"{work}/topic")
        messages = message_fields(follow(spark, f"{work}/topic", rows.schema), "company_id", "chunk_id")
        done = windows.process_windows(
            messages.withColumn("at", F.col("timestamp")), first_and_last, ENDS, ("at", "chunk_id")
        )
        stream_layer(done, f"{work}/ends", f"{work}/checkpoint", ALL_AVAILABLE).awaitTermination()
    return reports.iso_bounds(spark.read.schema(done.schema).parquet(f"{work}/ends"))


@query(
    "stream_rate_5m",
    f"""SELECT * FROM ({rate_sql("status = 'success'")})
        WHERE strptime(window_start, {ISO}) + INTERVAL '5 minutes' <= (SELECT max(ts) - INTERVAL '5 seconds' FROM {inputs.REQUESTS.sql}
            WHERE status = 'success')""",
)
def stream_rate_5m(spark, folder):
    """Rates of a stream over sliding ranges, from the steps of one aggregation by another."""
    work = shared_folder(spark, "stream-rate")
    rows = uploads(spark, folder).filter(metrics.label("status") == "success")
    for part in (f"ts < {CUT}", f"ts >= {CUT}"):
        arrive(rows.where(part), f"{work}/observations")
        stream = follow(spark, f"{work}/observations", rows.schema)
        rated = metrics.stream_rate(stream, {"content_type": metrics.label("content_type")})
        stream_layer(rated, f"{work}/rates", f"{work}/checkpoint", ALL_AVAILABLE).awaitTermination()
    done = spark.read.schema(rated.schema).parquet(f"{work}/rates")
    return window_starts(done).withColumn("rate", F.round("rate", 8))


IDLE_WIDTH = "1 second"
IDLE_TRIGGER = {"processingTime": "200 milliseconds"}
# Seconds after the last input was read by which a query whose windows stay open counts as broken.
IDLE_PATIENCE = 300


def wait_until_idle(running):
    """Until the input is read, however long that takes, and no window is open any more."""
    read, ends = None, None
    while running.isActive and (ends is None or time.monotonic() < ends):
        last = running.lastProgress
        if last and last["batchId"] > 0 and last["stateOperators"] and last["stateOperators"][0]["numRowsTotal"] == 0:
            return
        if last and (ends is None or last["numInputRows"] and last["batchId"] != read):
            read, ends = last["batchId"], time.monotonic() + IDLE_PATIENCE
        time.sleep(0.2)
    raise TimeoutError("windows stayed open though nothing arrived") from running.exception()


@query(
    "stream_idle_windows",
    """SELECT event_type AS company_id, count(*) AS chunk_count, true AS each_window_once
       FROM events GROUP BY event_type""",
)
def stream_idle_windows(spark, folder):
    """Wall-clock windows all close, though no message follows the last one."""
    work = shared_folder(spark, "stream-idle")
    rows = inputs.BROKER_ROWS.frame(spark, folder)
    arrive(rows, f"{work}/topic")
    counts = windows.idle_processing_counts(follow(spark, f"{work}/topic", rows.schema), IDLE_WIDTH)
    running = stream_layer(counts, f"{work}/counts", f"{work}/checkpoint", IDLE_TRIGGER)
    try:
        wait_until_idle(running)
    finally:
        running.stop()
    done = spark.read.schema(counts.schema).parquet(f"{work}/counts")
    return done.groupBy("company_id").agg(
        F.sum("chunk_count").alias("chunk_count"),
        (F.count("window_start") == F.countDistinct("window_start")).alias("each_window_once"),
    )


@query(
    "stream_without_replays",
    f"""SELECT DISTINCT value ->> '$.chunk_id' AS chunk_id, value ->> '$.document_id' AS document_id,
               value ->> '$.company_id' AS company_id FROM {inputs.BROKER_ROWS.sql}""",
)
def stream_without_replays(spark, folder):
    """Every message comes again, at once and after a restart, and is passed on once."""
    work = shared_folder(spark, "stream-replays")
    rows = inputs.BROKER_ROWS.frame(spark, folder)
    before, after = rows.where(f"timestamp < {CUT}"), rows.where(f"timestamp >= {CUT}")
    later = {"timestamp": F.col("timestamp") + F.expr("INTERVAL 2 SECONDS")}
    for arrived in ((before, before.withColumns(later)), (before, after, after.withColumns(later))):
        for part in arrived:
            arrive(part, f"{work}/topic")
        unique = replays.drop_replayed_messages(follow(spark, f"{work}/topic", rows.schema))
        stream_layer(unique, f"{work}/unique", f"{work}/checkpoint", ALL_AVAILABLE).awaitTermination()
    done = spark.read.schema(unique.schema).parquet(f"{work}/unique")
    return message_fields(done, "chunk_id", "document_id", "company_id").drop("timestamp")


_FANNED_SQL = f"""(SELECT *, {OBJECT_SQL} AS ok, CASE WHEN {OBJECT_SQL} THEN TRY_CAST(value AS JSON) ->> '$.company_id' END AS company_id,
        CASE WHEN {OBJECT_SQL} THEN NULL WHEN TRY_CAST(value AS JSON) IS NULL THEN 'invalid_json' ELSE 'not_an_object' END AS reason
    FROM {inputs.MESSAGES.sql})"""
FANNED = T.StructType().add("event_id", "long").add("company_id", "string")
REFUSED = T.StructType().add("event_id", "long").add("reason", "string")
TENANTS = T.StructType().add("company_id", "string").add("n", "long")


@query(
    "stream_fan_out",
    f"""SELECT 'decoded' AS output, event_id, company_id AS detail, CAST(1 AS BIGINT) AS n FROM {_FANNED_SQL} WHERE ok
        UNION ALL SELECT 'quarantined', event_id, reason, 1 FROM {_FANNED_SQL} WHERE NOT ok
        UNION ALL SELECT 'tenants', NULL, company_id, count(*) FROM {_FANNED_SQL} WHERE ok GROUP BY company_id""",
)
def stream_fan_out(spark, folder):
    """One query, three tables: messages, dead letters and counts per tenant, batch by batch."""
    work = shared_folder(spark, "stream-fan-out")
    rows = inputs.MESSAGES.frame(spark, folder)

    def decoded(batch):
        return batch.where("reason IS NULL").select("event_id", "payload.company_id")

    outputs = {
        "decoded": decoded,
        "quarantined": lambda batch: batch.where("reason IS NOT NULL").select(*REFUSED.names),
        "tenants": lambda batch: decoded(batch).groupBy("company_id").agg(F.count("*").alias("n")),
    }
    for part in ("event_id % 3 = 0", "event_id % 3 <> 0"):
        arrive(rows.where(part), f"{work}/topic")
        messages = events.decoded_rows(follow(spark, f"{work}/topic", rows.schema), "company_id STRING")
        start_fan_out(messages, outputs, f"{work}/tables", f"{work}/checkpoint", ALL_AVAILABLE).awaitTermination()
    read = lambda name, schema: read_fan_out(spark, f"{work}/tables", name, schema)
    one, none = F.lit(1).cast("long").alias("n"), F.lit(None).cast("long").alias("event_id")
    tenants = read("tenants", TENANTS).groupBy("company_id").agg(F.sum("n").alias("n"))
    return (
        read("decoded", FANNED).select(F.lit("decoded").alias("output"), "event_id", F.col("company_id").alias("detail"), one)
        .union(read("quarantined", REFUSED).select(F.lit("quarantined"), "event_id", "reason", one))
        .union(tenants.select(F.lit("tenants"), none, "company_id", "n"))
    )


# What comes again of the documents: new texts, emptied ones, and old versions beside them.
AGAIN = "doc_id % 3 = 0"
NEW_TEXT = "CASE WHEN doc_id % 30 = 0 THEN ' ' ELSE concat('again ', text) END"


@query(
    "stream_replace",
    f"""SELECT {chunk_id()} AS chunk_id, document_id, company_id, text, -1 AS page
        FROM {chunk_rows(f'''(SELECT CAST(doc_id AS VARCHAR) AS document_id, source AS company_id,
            CASE WHEN {AGAIN} THEN {NEW_TEXT} ELSE text END AS text FROM documents)''', 1000, 200, 'document_id, company_id')}""",
)
def stream_replace(spark, folder):
    """Documents processed again replace their chunks, also by none; all others keep theirs."""
    work = shared_folder(spark, "stream-replace")
    columns = [f"{inputs.ID} AS document_id", "source AS company_id"]
    documents = inputs.read_table(spark, folder, "documents")
    first = documents.selectExpr(*columns, "text", "1 AS updated_at")
    again = documents.where(AGAIN)
    stale = again.where("doc_id % 15 = 0").selectExpr(*columns, "concat('stale ', text) AS text", "1 AS updated_at")
    second = again.selectExpr(*columns, f"{NEW_TEXT} AS text", "2 AS updated_at").unionByName(stale)
    table = VersionedTable(spark, f"{work}/chunks", CHUNK)

    def chunks(batch):
        page = F.struct(F.lit(None).cast("int").alias("page"), F.col("text").alias("text"))
        return chunk_records(batch.select("document_id", "company_id", F.array(page).alias("pages")))

    for rows in (first, second):
        arrive(rows, f"{work}/documents")
        stream = follow(spark, f"{work}/documents", first.schema)
        start_replacing(stream, table, chunks, f"{work}/checkpoint", trigger=ALL_AVAILABLE).awaitTermination()
    return table.read()


# The uploads after this arrival number come after the changes; those without one come last.
ARRIVAL_CUT = 1200
_UPLOADS_SQL = f"""(SELECT *, CASE WHEN arrival < {ARRIVAL_CUT} THEN 1 ELSE 2 END AS run,
        row_number() OVER (PARTITION BY company_id, filename, coalesce(arrival < {ARRIVAL_CUT}, false)
                           ORDER BY arrival NULLS LAST, document_id NULLS FIRST) AS nth FROM {UPLOAD_BATCH.sql})"""
FAILED_UPLOADS = f"arrival < {ARRIVAL_CUT} AND CAST(document_id AS BIGINT) % 3 = 0"


@query(
    "stream_guard",
    f"""WITH taken AS (SELECT DISTINCT company_id, filename FROM {STORED_NAMES.sql} WHERE status <> 'error'),
        held AS (SELECT company_id, filename, document_id FROM {_UPLOADS_SQL} WHERE run = 1 AND nth = 1),
        failed AS (SELECT DISTINCT company_id, filename, document_id FROM {UPLOAD_BATCH.sql} WHERE {FAILED_UPLOADS}),
        still AS (SELECT company_id, filename FROM held h WHERE NOT EXISTS (SELECT 1 FROM failed f
            WHERE f.company_id = h.company_id AND f.filename = h.filename AND f.document_id = h.document_id))
        SELECT document_id, company_id, filename, arrival, company_id IS NULL OR filename IS NULL OR (nth = 1
            AND NOT EXISTS (SELECT 1 FROM taken t WHERE t.company_id = u.company_id AND t.filename = u.filename)
            AND (run = 1 OR NOT EXISTS (SELECT 1 FROM still s WHERE s.company_id = u.company_id AND s.filename = u.filename))) AS accepted
        FROM {_UPLOADS_SQL} u""",
)
def stream_guard(spark, folder):
    """Verdicts over two runs; names of failed documents are free again in the second."""
    work = shared_folder(spark, "stream-guard")
    uploads = UPLOAD_BATCH.frame(spark, folder)
    stored = STORED_NAMES.frame(spark, folder).withColumn("document_id", F.concat(F.lit("stored "), "filename", "status"))
    early = F.coalesce(F.col("arrival") < ARRIVAL_CUT, F.lit(False))
    failed = uploads.where(FAILED_UPLOADS).select("document_id", *guard.NAME, F.lit("error").alias("status"), F.col("arrival").alias("at"))
    arrive(failed.limit(0), f"{work}/changes")
    for rows, changes in ((uploads.where(early), None), (uploads.where(~early), failed)):
        arrive(rows, f"{work}/uploads")
        if changes is not None:
            arrive(changes, f"{work}/changes")
        verdicts = guard.guard_uploads(
            follow(spark, f"{work}/uploads", uploads.schema), follow(spark, f"{work}/changes", failed.schema), stored
        )
        stream_layer(verdicts, f"{work}/verdicts", f"{work}/checkpoint", ALL_AVAILABLE).awaitTermination()
    return spark.read.schema(verdicts.schema).parquet(f"{work}/verdicts")


SUMMARY = T.StructType().add("document_id", "string").add("num_chunks_generated", "integer").add("processing_time_ms", "double")
_CHUNKS_SQL = chunk_rows(inputs.DOCUMENT_TEXT.sql, 1000, 200, "document_id")


@query(
    "stream_elapsed",
    f"""WITH counts AS (SELECT document_id, count(*) AS n FROM {_CHUNKS_SQL} GROUP BY document_id)
        SELECT 'document' AS kind, document_id, CAST(coalesce(n, 0) AS BIGINT) AS n, true AS timed
        FROM {inputs.DOCUMENT_TEXT.sql} LEFT JOIN counts USING (document_id)
        UNION ALL SELECT 'histogram', NULL, count(*), true FROM documents
        UNION ALL SELECT 'batches', NULL, count(*), true FROM documents""",
)
def stream_elapsed(spark, folder):
    """Processing times of documents and of batches, and the histogram they feed."""
    work = shared_folder(spark, "stream-elapsed")
    documents = inputs.DOCUMENT_TEXT.frame(spark, folder)
    arrive(documents, f"{work}/documents")

    def texts(batch):
        page = F.struct(F.lit(None).cast("int").alias("page"), F.col("text").alias("text"))
        return batch.select("document_id", "company_id", F.array(page).alias("pages"))

    outputs = {
        "chunks": lambda batch: chunk_records(texts(batch)).select(*CHUNK.names),
        "summaries": lambda batch, ms: timing.with_elapsed(document_summary(texts(batch)), ms).select(*SUMMARY.names),
    }
    times = timing.BatchTimes()
    spark.streams.addListener(times)
    try:
        stream = follow(spark, f"{work}/documents", documents.schema)
        start_fan_out(stream, outputs, f"{work}/tables", f"{work}/checkpoint", ALL_AVAILABLE).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(times)
    summaries = read_fan_out(spark, f"{work}/tables", "summaries", SUMMARY)
    ms = F.col("processing_time_ms")
    each = summaries.select(
        F.lit("document").alias("kind"), "document_id", F.col("num_chunks_generated").cast("long").alias("n"),
        ((ms > 0) & (F.round(ms, 2) == ms)).alias("timed"),
    )
    bounds = metrics.HISTOGRAMS[timing.DOCUMENT_SECONDS].bounds
    labels = {n: F.lit(n) for n in metrics.HISTOGRAMS[timing.DOCUMENT_SECONDS].labels}
    counted = metrics.bucket_counts(timing.document_seconds(summaries, **labels), ["metric"], bounds)
    histogram = counted.select(F.lit("histogram"), F.lit(None).cast("string"), F.element_at("buckets", -1), F.col("sum") > 0)
    reported = times.observations(spark)
    batches = reported.agg(F.lit("batches"), F.lit(None).cast("string"), F.sum("rows"), F.min("value") > 0)
    return each.union(histogram).union(batches)
