import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from sheafline.operators import extraction
from sheafline.operators.chunking import ChunkSpec
from sheafline.schemas import BROKER_ROW, EMBEDDING, EMBEDDING_KEYS, RAW_OBJECT
from sheafline.sinks.tables import stream_landing, stream_layer
from sheafline.sources.landing import read_landing
from sheafline.sources.topics import read_topic_files
from sheafline.streaming import counters, stages
from tests.conftest import plan_of

AVAILABLE = {"availableNow": True}
DAY = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def append_rows(spark, path, times, company="c"):
    """One more file of broker rows in a topic folder."""
    rows = [
        (None, json.dumps({"company_id": company, "document_id": "d", "chunk_id": str(i)}), "embeddings.ready", 0, i,
         DAY + dt.timedelta(seconds=s))
        for i, s in enumerate(times)
    ]
    spark.createDataFrame(rows, BROKER_ROW).coalesce(1).write.mode("append").parquet(path)


def run_counts(spark, topic, out, checkpoint):
    counts = counters.event_time_counts(read_topic_files(spark, topic, files_per_trigger=1))
    stream_layer(counts, out, checkpoint, AVAILABLE).awaitTermination()
    done = spark.read.schema(counts.schema).parquet(out)
    return {
        (int((r.window_start.replace(tzinfo=None) - DAY.replace(tzinfo=None)).total_seconds()), r.company_id): r.chunk_count
        for r in done.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "company_id", "chunk_count").collect()
    }


def test_late_rows_are_dropped_and_a_restart_goes_on(spark, tmp_path):
    topic, out, checkpoint = (str(tmp_path / n) for n in ("topic", "out", "check"))
    append_rows(spark, topic, [10, 66])
    # the watermark is 66 - 5 s, so the first window has closed
    assert run_counts(spark, topic, out, checkpoint) == {(0, "c"): 1}
    append_rows(spark, topic, [20, 180])
    assert run_counts(spark, topic, out, checkpoint) == {(0, "c"): 1, (60, "c"): 1}
    # rows inside the allowed disorder still count
    append_rows(spark, topic, [181, 185])
    append_rows(spark, topic, [184, 400])
    assert run_counts(spark, topic, out, checkpoint) == {(0, "c"): 1, (60, "c"): 1, (180, "c"): 4}


def test_processing_time_windows_count_every_message(spark, tmp_path):
    topic = str(tmp_path / "topic")
    append_rows(spark, topic, range(40), "a")
    append_rows(spark, topic, range(25), "b")
    counts = counters.processing_time_counts(read_topic_files(spark, topic, files_per_trigger=1))
    query = (
        counts.writeStream.outputMode("update").format("memory").queryName("proc_counts")
        .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    latest = spark.table("proc_counts").groupBy("window_start", "company_id").agg(F.max("chunk_count").alias("n"))
    totals = {r.company_id: r.n for r in latest.groupBy("company_id").agg(F.sum("n").alias("n")).collect()}
    assert totals == {"a": 40, "b": 25}
    widths = spark.table("proc_counts").select(
        (F.unix_timestamp("window_end") - F.unix_timestamp("window_start")).alias("w")
    ).distinct().collect()
    assert [r.w for r in widths] == [30]


def test_landing_layout_rotation_and_pruned_read(spark, tmp_path):
    topic, root = str(tmp_path / "topic"), str(tmp_path / "landing")
    append_rows(spark, topic, [3600 * 5 + i for i in range(7)] + [90000])
    rows = read_topic_files(spark, topic)
    stream_landing(rows, root, str(tmp_path / "check"), records_per_file=3, trigger=AVAILABLE).awaitTermination()
    hour = tmp_path / "landing/topic=embeddings.ready/year=2024/month=01/day=01/hour=05"
    files = [p for p in hour.iterdir() if p.suffix == ".txt"]
    assert len(files) == 3
    assert all(set(json.loads(line)) == {"company_id", "document_id", "chunk_id"} for p in files for line in p.read_text().splitlines())
    landed = read_landing(spark, root, EMBEDDING_KEYS, topic="embeddings.ready")
    assert landed.count() == 8 and landed.filter("day = '02'").count() == 1
    inferred = read_landing(spark, root)
    assert {"company_id", "document_id", "chunk_id", "topic", "hour"} <= set(inferred.columns)


def objects_frame(spark, names):
    return spark.createDataFrame(
        [(n, bytearray(f"{n} one two three four".encode()), "text/plain") for n in names], RAW_OBJECT
    )


def test_chained_layers_with_restart(spark, tmp_path):
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "lake")

    def run():
        objects = spark.readStream.schema(RAW_OBJECT).parquet(inbox).select(
            F.col("path").alias("document_id"), F.lit("c").alias("company_id"), F.col("path").alias("s3_path"),
            "content", "content_type",
        )
        stages.start_extraction_layer(objects, root, AVAILABLE).awaitTermination()
        stages.start_chunk_layer(spark, root, ChunkSpec(3, 1), AVAILABLE).awaitTermination()
        stages.start_embedding_layer(spark, root, 16, AVAILABLE).awaitTermination()
        return spark.read.schema(EMBEDDING).parquet(f"{root}/embeddings")

    objects_frame(spark, ["a", "b"]).write.mode("append").parquet(inbox)
    assert run().count() == 4
    objects_frame(spark, ["c"]).write.mode("append").parquet(inbox)
    done = run()
    assert done.count() == 6 and done.select("chunk_id").distinct().count() == 6
    assert {len(r.vector) for r in done.collect()} == {16}
    stages.write_summary(spark, root, "2024-01-02")
    summary = spark.read.parquet(f"{root}/analytics/batch").collect()
    assert {(r.document_id, r.total_chunks_processed) for r in summary} == {("a", 2), ("b", 2), ("c", 2)}


def test_rate_layer_and_dead_letters(spark, tmp_path):
    topic, root = str(tmp_path / "topic"), str(tmp_path / "lake")
    append_rows(spark, topic, [1, 2, 70, 300])
    stages.start_rate_layer(read_topic_files(spark, topic), root, AVAILABLE).awaitTermination()
    assert sorted(r.chunk_count for r in spark.read.parquet(f"{root}/analytics/rt").collect()) == [1, 2]
    inbox = str(tmp_path / "inbox")
    objects = [("p", b"x", "image/png"), ("gone", None, "text/plain"), ("", b"x", "text/plain"), ("t", b"x", "text/plain")]
    spark.createDataFrame(objects, RAW_OBJECT).write.parquet(inbox)
    raw = spark.readStream.schema(RAW_OBJECT).parquet(inbox).selectExpr("path AS document_id", "'c' AS company_id", "path AS s3_path", "content", "content_type")
    stages.start_extraction_layer(raw, root, AVAILABLE).awaitTermination()
    stages.start_dead_letter_layer(spark, root, AVAILABLE).awaitTermination()
    dead = {r.document_id: r for r in spark.read.schema(stages.DEAD_LETTER).parquet(f"{root}/dead_letters").collect()}
    assert {k: r.stage for k, r in dead.items()} == {"p": "unknown", "gone": "s3_download", "": "validation"}
    assert "image/png" in dead["p"].error


def test_one_scan_and_one_parse_serve_texts_and_dead_letters(spark):
    objects = objects_frame(spark, ["a"]).selectExpr("path AS document_id", "'c' AS company_id", "path AS s3_path", "content", "content_type")
    plan = plan_of(extraction.extract_events(objects).select("document_id", "pages", "error", "stage"))
    parses = [line for line in plan.splitlines() if "ArrowEvalPython" in line]
    calls = [c for line in parses for c in re.findall(r"_html_to_text\(", line)]
    assert plan.count("Scan ") == 1 and len(calls) == 1


def test_kafka_reader_needs_its_connector(spark):
    from sheafline.sources.topics import read_topic_stream

    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic_stream(spark, ["documents.raw", "chunks.processed"], "localhost:9092", "earliest")
