"""Topic sources: a broker, or files with the same columns."""

from pyspark.sql import functions as F

from sheafline.schemas import BROKER_ROW

BROKER_COLUMNS = tuple(BROKER_ROW.names)


def read_topic_stream(spark, topics, servers, starting="latest", **options):
    """Stream of one or more topics with key and value as text.

    ``starting`` is where a new query begins ("latest" or "earliest"); afterwards
    offsets live in the query's checkpoint, so nothing is committed by hand.
    Needs Spark's Kafka connector package on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join([topics] if isinstance(topics, str) else topics))
        .option("startingOffsets", starting)
    )
    return as_text(reader.options(**options).load())


def read_topic_files(spark, path, fmt="parquet", schema=BROKER_ROW, files_per_trigger=None):
    """Stream of files holding broker rows: replay of an archived topic."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(fmt).load(path)


def as_text(rows):
    """Broker rows with key and value decoded to text."""
    return rows.withColumns({c: F.col(c).cast("string") for c in ("key", "value")})


def only_topic(rows, topic):
    return rows.filter(F.col("topic") == topic)
