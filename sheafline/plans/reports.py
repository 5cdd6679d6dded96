"""Report and window queries."""

from pyspark.sql import functions as F

from sheafline.operators import joins, reports
from sheafline.plans import inputs
from sheafline.plans.registry import query
from sheafline.plans.sqltext import ISO, chunk_rows
from sheafline.plans.text import chunks
from sheafline.schemas import EMBEDDING_KEYS
from sheafline.session import shared_folder
from sheafline.sinks.tables import LANDING_LAYOUT, write_landing
from sheafline.sources.landing import read_landing_day, with_partitions

AS_OF = "2024-02-01"
DAY = "2024-01-15"
GAP_WIDTH = "5 minutes"

LANDED_SQL = f"""(SELECT *, strftime(timestamp, '%Y') AS year, strftime(timestamp, '%m') AS month,
                         strftime(timestamp, '%d') AS day, strftime(timestamp, '%H') AS hour FROM {inputs.BROKER_ROWS.sql})"""


@query(
    "daily_report",
    f"""SELECT company_id, document_id, '2024-01-31' AS processing_date, count(*) AS total_chunks_processed
        FROM {chunk_rows(inputs.DOCUMENT_TEXT.sql, 1000, 200, 'document_id, company_id')} GROUP BY ALL""",
)
def daily_report(spark, folder):
    report = reports.daily_report(chunks(spark, folder), AS_OF)
    return report.withColumn("processing_date", F.col("processing_date").cast("string"))


@query(
    "daily_report_pruned",
    f"""SELECT value ->> '$.company_id' AS company_id, value ->> '$.document_id' AS document_id,
               count(*) AS total_chunks
        FROM {LANDED_SQL} WHERE year = '2024' AND month = '01' AND day = '15' GROUP BY 1, 2""",
)
def daily_report_pruned(spark, folder):
    """All messages landed, then the folders of one day read."""
    root = shared_folder(spark, "landing")
    write_landing(inputs.BROKER_ROWS.frame(spark, folder), root)
    return reports.daily_report_pruned(read_landing_day(spark, root, EMBEDDING_KEYS, DAY), DAY)


@query(
    "landing_partitions",
    f"SELECT topic, year, month, day, hour, count(*) AS n_records FROM {LANDED_SQL} GROUP BY ALL",
)
def landing_partitions(spark, folder):
    rows = with_partitions(inputs.BROKER_ROWS.frame(spark, folder))
    return rows.groupBy(*LANDING_LAYOUT).agg(F.count(F.lit(1)).alias("n_records"))


def _window_sql(width):
    return f"""SELECT strftime(w, {ISO}) AS window_start, strftime(w + INTERVAL '{width}', {ISO}) AS window_end,
                      company_id, count(*) AS chunk_count
               FROM (SELECT time_bucket(INTERVAL '{width}', timestamp) AS w, value ->> '$.company_id' AS company_id
                     FROM {inputs.BROKER_ROWS.sql}) GROUP BY w, company_id"""


def _windows(spark, folder, width):
    messages = inputs.BROKER_ROWS.frame(spark, folder).select(
        F.get_json_object("value", "$.company_id").alias("company_id"), "timestamp"
    )
    return reports.iso_bounds(reports.tenant_window_counts(messages, width))


@query("window_30s", _window_sql("30 seconds"))
def window_30s(spark, folder):
    """Event-time twin of the processing-time stream counter."""
    return _windows(spark, folder, "30 seconds")


@query("window_1m", _window_sql("1 minute"))
def window_1m(spark, folder):
    return _windows(spark, folder, "1 minute")


@query(
    "topic_flow_gap",
    f"""SELECT strftime(coalesce(c.w, p.w), {ISO}) AS window_start, coalesce(consumed, 0) AS consumed,
               coalesce(produced, 0) AS produced, coalesce(consumed, 0) - coalesce(produced, 0) AS gap
        FROM (SELECT time_bucket(INTERVAL '{GAP_WIDTH}', timestamp) AS w, count(*) AS consumed
              FROM {inputs.BROKER_ROWS.sql} WHERE topic = 'chunks.processed' GROUP BY w) c
        FULL JOIN (SELECT time_bucket(INTERVAL '{GAP_WIDTH}', timestamp) AS w, count(*) AS produced
              FROM {inputs.BROKER_ROWS.sql} WHERE topic = 'embeddings.ready' GROUP BY w) p ON c.w = p.w""",
)
def topic_flow_gap(spark, folder):
    rows = inputs.BROKER_ROWS.frame(spark, folder).withColumnRenamed("timestamp", "ts")
    gaps = joins.windowed_flow_gap(
        rows.filter("topic = 'chunks.processed'"), rows.filter("topic = 'embeddings.ready'"), GAP_WIDTH
    )
    return gaps.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss"))
