"""Keyed JSON records for a topic."""

from pyspark.sql import functions as F

from sheafline.functions import payload


def keyed_json(df, key="document_id", fields=None):
    """(key, value): the key column as text, the fields as one JSON object."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        payload.to_payload(*(fields or df.columns)).alias("value"),
    )


def window_result_json(counts, count="chunk_count", name="chunk_count_30s"):
    """Tenant window counts as JSON with the emission time in epoch seconds."""
    emitted = F.unix_micros(F.current_timestamp()) / F.lit(1e6)
    return counts.select(
        F.col("company_id").cast("string").alias("key"),
        payload.to_payload(
            F.col("company_id"), F.col(count).alias(name), emitted.alias("timestamp_utc")
        ).alias("value"),
    )


def write_topic(rows, topic, servers, linger_ms=10):
    """Batch write to a broker (needs Spark's Kafka connector package)."""
    _broker(rows.write.format("kafka"), topic, servers, linger_ms).save()


def stream_to_topic(rows, topic, servers, checkpoint, mode="append", trigger="30 seconds", linger_ms=10):
    """Streaming write to a broker, at least once."""
    writer = rows.writeStream.format("kafka").outputMode(mode).trigger(processingTime=trigger)
    writer = _broker(writer, topic, servers, linger_ms)
    return writer.option("checkpointLocation", checkpoint).start()


def _broker(writer, topic, servers, linger_ms):
    return (
        writer.option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("kafka.acks", "all")
        .option("kafka.linger.ms", str(linger_ms))
    )


def stream_to_console(rows, mode="update", trigger="30 seconds", **options):
    """Print a stream while developing; ``df.show()`` is the batch counterpart."""
    writer = rows.writeStream.format("console").outputMode(mode).trigger(processingTime=trigger)
    return writer.options(truncate="false", **options).start()
