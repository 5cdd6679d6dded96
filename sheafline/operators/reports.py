"""Batch reports over landed records."""

from pyspark.sql import functions as F

from sheafline.sources.landing import day_filter, require_columns

KEYS = ("company_id", "document_id")


def daily_report(landed, as_of=None):
    """Chunks per company and document over all landed data, labelled the day before ``as_of``.

    Counting is partial per task before the shuffle, so a tenant or document
    with most of the rows costs one small row per task.
    """
    require_columns(landed, KEYS)
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return (
        landed.groupBy(*KEYS)
        .agg(F.count(F.lit(1)).alias("total_chunks_processed"))
        .select(*KEYS, F.date_sub(today, 1).alias("processing_date"), "total_chunks_processed")
    )


def daily_report_pruned(landed, day):
    """Chunks per company and document of one landing day (partition-pruned)."""
    require_columns(landed, KEYS)
    return landed.filter(day_filter(day)).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("total_chunks"))


def tenant_window_counts(messages, width, ts="timestamp", tenant="company_id"):
    """Tumbling event-time count per tenant; the same code runs batch or streaming."""
    return (
        messages.groupBy(F.window(ts, width).alias("w"), tenant)
        .agg(F.count(F.lit(1)).alias("chunk_count"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            tenant,
            "chunk_count",
        )
    )


def iso_bounds(windows):
    """Window bounds as ISO strings (UTC session)."""
    form = "yyyy-MM-dd'T'HH:mm:ss"
    return windows.withColumns(
        {c: F.date_format(c, form) for c in ("window_start", "window_end")}
    )
