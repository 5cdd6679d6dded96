"""Report, landing and raw-object tables."""

from pyspark.sql import functions as F

from sheafline.sources.landing import PARTITIONS, with_partitions

# Landing rotation, by records and by time.
LANDING_RECORDS = 1000
LANDING_TRIGGER = "10 minutes"
# Fixed value: how often a stream writes its output and its checkpoint.
CHECKPOINT_TRIGGER = "30 seconds"
LANDING_LAYOUT = ("topic", *PARTITIONS)


def write_report(report, path, partition="processing_date"):
    """Partitioned Parquet; only the partitions present in ``report`` are replaced."""
    (
        report.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def write_single_date(report, root, day):
    """Parquet under ``root/date=YYYY-MM-DD``; returns the folder."""
    path = f"{root.rstrip('/')}/date={day}"
    report.write.mode("overwrite").parquet(path)
    return path


def landing_rows(messages, value="value"):
    """Broker rows as landed rows: one line of JSON plus topic and hour partitions.

    A line break can only be layout in valid JSON, so it becomes a space.
    """
    line = F.translate(F.col(value), "\r\n", "  ")
    return with_partitions(messages).select(line.alias("value"), *LANDING_LAYOUT)


def write_landing(messages, root, records_per_file=LANDING_RECORDS):
    """Append broker payloads as JSON lines under topic and hour folders.

    The rebalance hint gathers each folder's rows into few tasks and splits a
    folder that holds most of them, so neither small files nor one slow task
    result.
    """
    rows = landing_rows(messages).hint("rebalance", *LANDING_LAYOUT)
    _landing(rows.write.mode("append"), records_per_file).text(root)


def gather_folders(rows, tasks, split=1):
    """Send each folder's rows to ``split`` of ``tasks`` tasks.

    Worth its shuffle for a backlog of many hours, where otherwise every task
    writes a file to every folder.  ``split`` above 1 keeps a topic with most of
    the records from ending in one task.
    """
    part = F.pmod(F.xxhash64("value"), F.lit(split))
    return rows.repartition(tasks, *LANDING_LAYOUT, part)


def stream_landing(messages, root, checkpoint, records_per_file=LANDING_RECORDS,
                   trigger=None, tasks=None, split=1):
    """Streaming landing: new files every trigger, at most ``records_per_file`` rows each."""
    rows = landing_rows(messages)
    if tasks:
        rows = gather_folders(rows, tasks, split)
    writer = _landing(rows.writeStream.outputMode("append").format("text"), records_per_file)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": LANDING_TRIGGER})).start(root)


def _landing(writer, records_per_file):
    return writer.partitionBy(*LANDING_LAYOUT).option("maxRecordsPerFile", records_per_file)


def write_raw_objects(objects, root, rebalance=True):
    """Raw files (company_id, path, content, content_type) as a table by tenant.

    Rebalancing moves the content once and avoids a small file per task and
    tenant; turn it off when the rows already arrive by tenant.
    """
    rows = objects.hint("rebalance", "company_id") if rebalance else objects
    rows.write.mode("append").partitionBy("company_id").parquet(root)


def write_chunk_table(chunks, table, buckets, mode="overwrite"):
    """Chunk records as a catalog table bucketed by document.

    Counting, replacing or reconciling by document then works bucket by bucket,
    without moving the stored text.
    """
    key = ("company_id", "document_id")
    writer = chunks.repartition(buckets, *key).write.mode(mode)
    writer.bucketBy(buckets, *key).sortBy(*key).saveAsTable(table)


def stream_layer(rows, path, checkpoint, trigger=None, partition=None):
    """One pipeline layer as a Parquet table with its own checkpoint, exactly once."""
    writer = rows.writeStream.outputMode("append").format("parquet")
    if partition:
        writer = writer.partitionBy(partition)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": CHECKPOINT_TRIGGER})).start(path)
