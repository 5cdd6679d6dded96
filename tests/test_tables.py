import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from sheafline.operators import documents, joins, reports
from sheafline.operators.metrics import HISTOGRAMS
from sheafline.schemas import EMBEDDING_KEYS
from sheafline.session import finished, shared_folder, stored, temporary_folders
from sheafline.sinks.tables import stream_layer, write_landing, write_raw_objects, write_report, write_single_date
from sheafline.sources.landing import day_filter, read_landing, read_landing_day, require_columns
from sheafline.streaming import timing


def report(spark, day, rows):
    df = spark.createDataFrame(rows, "company_id STRING, document_id STRING")
    return reports.daily_report(df, day)


def test_report_overwrite_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "report")
    write_report(report(spark, "2024-01-02", [("c", "d"), ("c", "d")]), path)
    write_report(report(spark, "2024-01-03", [("c", "d")]), path)
    write_report(report(spark, "2024-01-03", [("c", "d"), ("c", "e")]), path)
    rows = spark.read.parquet(path).groupBy("processing_date").agg(F.sum("total_chunks_processed").alias("n")).collect()
    assert {str(r.processing_date): r.n for r in rows} == {"2024-01-01": 2, "2024-01-02": 2}


def test_report_default_label_is_yesterday(spark):
    df = spark.createDataFrame([("c", "d")], "company_id STRING, document_id STRING")
    row = reports.daily_report(df).select("processing_date", F.date_sub(F.current_date(), 1).alias("y")).first()
    assert row.processing_date == row.y


def test_single_date(spark, tmp_path):
    path = write_single_date(report(spark, "2024-01-02", [("c", "d")]), str(tmp_path), "2024-01-01")
    assert path.endswith("/date=2024-01-01") and spark.read.parquet(path).count() == 1


def test_missing_columns_raise(spark):
    df = spark.createDataFrame([("c",)], "company_id STRING")
    with pytest.raises(ValueError, match="document_id"):
        require_columns(df, ("company_id", "document_id"))
    with pytest.raises(ValueError):
        reports.daily_report(df)


def test_batch_landing_and_pruned_report(spark, tmp_path):
    root = str(tmp_path / "landing")
    rows = [
        (f'{{"company_id":"c","document_id":"d{i % 2}",\n"chunk_id":"{i}"}}', "embeddings.ready",
         dt.datetime(2024, 1, 1 + i // 5, i, tzinfo=dt.timezone.utc))
        for i in range(10)
    ]
    write_landing(spark.createDataFrame(rows, "value STRING, topic STRING, timestamp TIMESTAMP"), root)
    landed = read_landing(spark, root, EMBEDDING_KEYS, topic="embeddings.ready")
    assert landed.filter("chunk_id IS NOT NULL").count() == 10
    day = reports.daily_report_pruned(landed, "2024-01-02")
    assert {r.document_id: r.total_chunks for r in day.collect()} == {"d0": 2, "d1": 3}
    plan = day._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line).split("PartitionFilters: [", 1)[1]
    assert "topic" in filters.split("]")[0] and "day" in filters.split("PushedFilters")[0]
    folders = read_landing_day(spark, root, EMBEDDING_KEYS, "2024-01-02")
    assert all("/day=02/" in f for f in folders.inputFiles()) and folders.count() == 5
    pruned = reports.daily_report_pruned(folders, "2024-01-02")
    assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, day.collect()))
    assert "PartitionFilters: [isnotnull(year" in pruned._jdf.queryExecution().executedPlan().toString()
    assert read_landing_day(spark, root, EMBEDDING_KEYS, "2030-01-01").count() == 0
    inferred = read_landing(spark, root).filter(day_filter(dt.date(2024, 1, 2)))
    assert inferred.count() == 5


def test_raw_object_table(spark, tmp_path):
    root = str(tmp_path / "raw")
    df = spark.createDataFrame([("c", "c/d/f.txt", bytearray(b"x"), "text/plain")], "company_id STRING, path STRING, content BINARY, content_type STRING")
    write_raw_objects(df, root)
    row = spark.read.parquet(root).filter("company_id = 'c'").first()
    assert bytes(row.content) == b"x"


def chunk_table(spark, rows):
    return spark.createDataFrame(rows, "company_id STRING, document_id STRING, chunk_index INT, text STRING")


def test_replacement_is_by_tenant_and_document(spark):
    old = chunk_table(spark, [("a", "1", 0, "old"), ("a", "1", 1, "old"), ("b", "1", 0, "other tenant"), ("a", "2", 0, "kept")])
    new = chunk_table(spark, [("a", "1", 0, "new")])
    rows = documents.replace_documents(old, new).collect()
    assert sorted((r.company_id, r.document_id, r.text) for r in rows) == [
        ("a", "1", "new"), ("a", "2", "kept"), ("b", "1", "other tenant"),
    ]


def test_bulk_delete(spark):
    table = chunk_table(spark, [("a", "1", 0, "x"), ("a", "1", 1, "x"), ("a", "2", 0, "x")])
    asked = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "2"), ("a", "9")], "company_id STRING, document_id STRING")
    remaining, result = documents.bulk_delete(table, asked)
    assert [r.document_id for r in remaining.collect()] == ["2"]
    assert {(r.company_id, r.document_id): r.outcome for r in result.collect()} == {
        ("a", "1"): "deleted", ("b", "2"): "failed", ("a", "9"): "failed",
    }


def test_enrichment(spark):
    df = spark.createDataFrame([("a", "1", 2, "uno dos tres", 4)], "company_id STRING, document_id STRING, chunk_index INT, text STRING, page INT")
    row = documents.enrich_chunks(df, content_limit=5).first()
    assert (row.pk_id, row.content, row.tokens, row.title, row.truncated) == ("1_2", "uno d", 3, None, True)
    assert len(row.content_hash) == 64
    whole = documents.enrich_chunks(df.withColumn("title_extracted", F.lit("t"))).first()
    assert (whole.content, whole.title, "truncated" in whole) == ("uno dos tres", "t", False)


def test_chunk_table_rows(spark):
    df = spark.createDataFrame([("a", "1", 0, "uno dos", -1)], "company_id STRING, document_id STRING, chunk_index INT, text STRING, page INT")
    row = documents.chunk_table_rows(df, count_tokens=F.length).first()
    assert row.metadata.page is None and row.metadata.tokens == 7 and row.content == "uno dos"
    assert (row.embedding_id, row.vector_status) == ("1_0", "created")
    with pytest.raises(ValueError):
        documents.chunk_table_rows(df, "lost")


def test_status_and_page(spark):
    ts = [dt.datetime(2024, 1, 1, h, tzinfo=dt.timezone.utc) for h in range(4)]
    log = spark.createDataFrame(
        [("a", "1", "pending", ts[0], 0), ("a", "1", "error", ts[2], 1), ("a", "2", "uploaded", ts[2], 2),
         ("a", "2", "processed", ts[2], 3), ("b", "3", "error", ts[3], 4)],
        "company_id STRING, document_id STRING, status STRING, ts TIMESTAMP, seq LONG",
    )
    status = documents.latest_status(log)
    assert {r.document_id: r.status for r in status.collect()} == {"1": "error", "2": "processed", "3": "error"}
    assert {r.document_id for r in documents.retry_candidates(status).collect()} == {"1", "3"}
    first = documents.status_page(status, "a", 1).first()
    assert first.document_id == "1"
    assert [r.document_id for r in documents.status_page(status, "a", 1, (first.updated_at, "1")).collect()] == ["2"]
    assert [r.document_id for r in documents.status_page(status, "a", 5).collect()] == ["1", "2"]


def test_duplicate_guard(spark):
    uploads = spark.createDataFrame(
        [("1", "a", "x"), ("2", "a", "y"), ("3", "b", "x"), ("4", "a", "z")], "document_id STRING, company_id STRING, filename STRING"
    )
    existing = spark.createDataFrame(
        [("a", "x", "processed"), ("a", "x", "error"), ("a", "y", "error")], "company_id STRING, filename STRING, status STRING"
    )
    accepted, rejected = joins.guard_duplicates(uploads, existing)
    assert sorted((r.company_id, r.filename) for r in accepted.collect()) == [("a", "y"), ("a", "z"), ("b", "x")]
    assert [(r.company_id, r.filename) for r in rejected.collect()] == [("a", "x")]


def test_objects_found_and_missing(spark):
    events = spark.createDataFrame([("1", "p"), ("2", "q"), ("3", None), ("4", "p")], "document_id STRING, s3_path STRING")
    objects = spark.createDataFrame([("p", bytearray(b"x"))], "path STRING, content BINARY")
    found, missing = joins.fetch_objects(events, objects)
    assert sorted(r.document_id for r in found.collect()) == ["1", "4"]
    assert sorted((r.document_id, r.stage) for r in missing.collect()) == [("2", "s3_download"), ("3", "s3_download")]
    assert joins.existing_objects(events, objects).count() == 2


def test_shared_folder_follows_the_session(spark):
    parent = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(parent) and first != second


def test_files_read_by_path(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c/a.txt").write_bytes(b"alpha")
    events = spark.createDataFrame([(str(i), p) for i, p in enumerate(["c/a.txt", "c/none.txt", None, "c/a.txt"])], "document_id STRING, s3_path STRING")
    rows = joins.read_by_path(events, str(tmp_path)).collect()
    assert sorted((r.document_id, bytes(r.content)) for r in rows if r.error is None) == [("0", b"alpha"), ("3", b"alpha")]
    assert {r.document_id: r.stage for r in rows if r.error is not None} == {"1": "s3_download", "2": "s3_download"}
    assert all(r.stage is None for r in rows if r.error is None)


def test_unknown_state_is_visible(spark):
    ts = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    log = spark.createDataFrame([("a", "1", "odd", ts, 1), ("a", "1", "error", ts, 0)], "company_id STRING, document_id STRING, status STRING, ts TIMESTAMP, seq LONG")
    assert documents.latest_status(log).first().status == "odd"


def test_status_order_is_time_then_number(spark):
    t = [dt.datetime(2024, 1, 1, 0, 0, 0, i, tzinfo=dt.timezone.utc) for i in range(3)]
    big = 1_900_000_000_000_000_000
    rows = [
        ("a", "1", "error", t[1], big), ("a", "1", "processed", t[2], 1),
        ("a", "2", "pending", t[0], None), ("a", "3", "error", t[0], None), ("a", "3", "processed", t[0], -5),
        ("a", "4", "error", None, big), ("a", "4", "uploaded", t[0], None), ("a", "5", None, t[0], 1),
    ]
    log = spark.createDataFrame(rows, "company_id STRING, document_id STRING, status STRING, ts TIMESTAMP, seq LONG")
    got = {r.document_id: r.status for r in documents.latest_status(log).collect()}
    assert got == {"1": "processed", "2": "pending", "3": "processed", "4": "uploaded", "5": None}


def test_uploads_without_arrival(spark):
    rows = [("1", "a", "x", None), ("2", "a", "x", None), ("3", "a", "y", None), ("4", "a", "y", 7), ("5", "a", None, 1), ("6", None, "x", 1)]
    uploads = spark.createDataFrame(rows, "document_id STRING, company_id STRING, filename STRING, arrival LONG")
    existing = spark.createDataFrame([], "company_id STRING, filename STRING, status STRING")
    accepted, _ = joins.guard_duplicates(uploads, existing, "arrival")
    assert {r.document_id for r in accepted.collect()} == {"1", "4", "5", "6"}


def test_processed_document_without_new_chunks_is_emptied(spark):
    old = chunk_table(spark, [("a", "1", 0, "old"), ("a", "2", 0, "kept")])
    processed = spark.createDataFrame([("a", "1")], "company_id STRING, document_id STRING")
    left = documents.replace_documents(old, old.limit(0), processed).collect()
    assert [r.document_id for r in left] == ["2"]


def test_one_document_under_several_names(spark):
    """Verdicts belong to uploads, not to documents; one sent twice is refused the second time."""
    rows = [("A", "c", "n1", 1), ("B", "c", "n2", 2), ("A", "c", "n2", 3), ("D", "c", "n4", 4), ("D", "c", "n4", 4), (None, "c", "n5", 5), ("E", "c", "n5", 6)]
    uploads = spark.createDataFrame(rows, "document_id STRING, company_id STRING, filename STRING, arrival LONG")
    existing = spark.createDataFrame([], "company_id STRING, filename STRING, status STRING")
    accepted, rejected = joins.guard_duplicates(uploads, existing, "arrival")
    found = lambda df: sorted((r.document_id or "", r.filename) for r in df.collect())
    assert found(accepted) == [("", "n5"), ("A", "n1"), ("B", "n2"), ("D", "n4")]
    assert found(rejected) == [("A", "n2"), ("D", "n4"), ("E", "n5")] and accepted.columns == uploads.columns


def test_stage_tables_are_deleted_with_their_block(spark):
    with temporary_folders(spark):
        inner = stored(spark.range(3), "inner")
        path = inner.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)

    seen = []

    def make():
        stage = stored(spark.range(5), "stage")
        seen.append(stage.inputFiles()[0].removeprefix("file://"))
        return stage.where("id > 1")

    with pytest.raises(ZeroDivisionError), temporary_folders(spark):
        seen.append(stored(spark.range(1), "lost").inputFiles()[0].removeprefix("file://"))
        1 / 0
    done = finished(spark, "result", make)
    assert sorted(r["id"] for r in done.collect()) == [2, 3, 4] and not any(map(os.path.exists, seen))
    # Nested blocks delete what was named inside them, and a result belongs to the block around it.
    with temporary_folders(spark):
        nested = finished(spark, "result", make).inputFiles()[0].removeprefix("file://")
        assert os.path.exists(nested)
    assert not os.path.exists(nested)


def test_documents_and_batches_are_timed(spark, tmp_path):
    summary = spark.createDataFrame([("1", 3)], "document_id STRING, n INT")
    timed = timing.with_elapsed(summary, 12.3456)
    assert timed.first()["processing_time_ms"] == 12.35
    labels = {n: F.lit("x") for n in HISTOGRAMS[timing.DOCUMENT_SECONDS].labels}
    seen = timing.document_seconds(timed, **labels).first()
    assert seen["metric"] == timing.DOCUMENT_SECONDS and seen["value"] == pytest.approx(0.01235)
    times = timing.BatchTimes()
    spark.streams.addListener(times)
    try:
        summary.write.parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(summary.schema).parquet(str(tmp_path / "in"))
        stream_layer(stream, str(tmp_path / "out"), str(tmp_path / "check"), {"availableNow": True}).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(times)
    rows = times.observations(spark).collect()
    assert sum(r["rows"] for r in rows) == 1 and all(r["value"] > 0 and r["metric"] == timing.BATCH_SECONDS for r in rows)
    assert times.observations(spark).collect() == []
