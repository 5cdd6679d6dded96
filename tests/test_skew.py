"""One key with most of the rows: results stay whole, and the join work is split."""

import pytest
from pyspark.sql import functions as F

from sheafline.operators import documents, joins, reports
from sheafline.sinks.tables import gather_folders
from tests.conftest import plan_of

HOT_ROWS, OTHER_ROWS = 60_000, 3_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40k",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Chunk rows of which one document holds the greater part."""
    path = str(tmp_path_factory.mktemp("hot") / "chunks")
    n = F.col("id")
    document = F.when(n < HOT_ROWS, F.lit("hot")).otherwise(n.cast("string"))
    spark.range(HOT_ROWS + OTHER_ROWS).select(
        F.lit("c").alias("company_id"), document.alias("document_id"), n.cast("int").alias("chunk_index"),
        F.sha2(n.cast("string"), 256).alias("text"),
    ).repartition(8).write.parquet(path)
    return spark.read.parquet(path)


def task_sizes(df):
    """Rows per task of the stage that reads the join, with the text carried through it."""
    per_task = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max("text"))
    sizes = [r.n for r in per_task.collect()]
    assert "skew=true" in plan_of(per_task)
    return sizes


def test_counts(hot):
    report = reports.daily_report(hot, "2024-01-02")
    assert report.count() == OTHER_ROWS + 1
    assert report.filter("document_id = 'hot'").first().total_chunks_processed == HOT_ROWS


def test_replacing_splits_the_hot_document(spark, hot, small_partitions):
    processed = spark.createDataFrame([("c", str(HOT_ROWS + 1))], "company_id STRING, document_id STRING")
    left = documents.replace_documents(hot, hot.limit(0), processed)
    assert left.filter("document_id = 'hot'").count() == HOT_ROWS
    sizes = task_sizes(left)
    assert sum(sizes) == HOT_ROWS + OTHER_ROWS - 1 and max(sizes) < HOT_ROWS / 3


def test_events_of_one_object_are_split(spark, hot, small_partitions, tmp_path):
    events = hot.select(F.col("chunk_index").alias("document_id"), F.col("document_id").alias("s3_path"), "text")
    paths = hot.select(F.col("document_id").alias("path")).distinct()
    paths.withColumn("content", F.encode("path", "UTF-8")).write.parquet(str(tmp_path / "objects"))
    objects = spark.read.parquet(str(tmp_path / "objects"))
    found, missing = joins.fetch_objects(events, objects)
    sizes = task_sizes(found)
    assert sum(sizes) == HOT_ROWS + OTHER_ROWS and max(sizes) < HOT_ROWS / 3
    assert missing.isEmpty()
    absent = task_sizes(joins.missing_objects(events, objects.filter("path != 'hot'")))
    assert sum(absent) == HOT_ROWS and max(absent) < HOT_ROWS / 3


def test_uploads_of_one_name_are_split(spark, hot, small_partitions):
    uploads = hot.select("company_id", F.col("chunk_index").alias("document_id"), F.col("document_id").alias("filename"), "text")
    existing = spark.createDataFrame([("c", "hot", "processed")], "company_id STRING, filename STRING, status STRING")
    flagged = joins.flag_duplicates(uploads, existing)
    assert flagged.filter("NOT accepted").count() == HOT_ROWS
    assert max(task_sizes(flagged)) < HOT_ROWS / 3


def test_a_hot_folder_is_split(hot):
    rows = hot.select(F.col("text").alias("value"), *[F.lit("x").alias(c) for c in ("topic", "year", "month", "day", "hour")])
    sizes = gather_folders(rows, 8, split=8).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) > 3 and sum(r["count"] for r in sizes) == HOT_ROWS + OTHER_ROWS
    assert "RoundRobin" not in plan_of(gather_folders(rows, 8))
