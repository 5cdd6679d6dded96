"""Shape of the physical plans: what moves, what is read, what leaves the JVM."""

import re

import pytest
from pyspark.sql import functions as F

from sheafline.operators import chunking, documents, extraction, search
from sheafline.plans import catalog
from sheafline.sinks.tables import write_chunk_table
from tests.conftest import plan_of

# Parsing HTML and office files needs whole-file parsers; a state machine and a chunker from outside are code.
PYTHON_QUERIES = {"status_steps", "document_progress", "chunks_by_function", "html_text", "html_title", "extract_dispatch", "extract_errors", "stage_errors", "docx_text", "xlsx_pages", "embed_chunks", "embed_messages", "embedding_contract"}
# Their plan is that of reading the stream's output; the stream itself has run before.
STREAM_QUERIES = {name for name in catalog.queries() if name.startswith("stream_")}
COUNTING = {
    "daily_report", "daily_report_pruned", "window_30s", "window_1m", "counters", "histogram_buckets", "histogram_series",
    "histogram_p95", "rate_5m", "error_rate", "throughput_1m", "topic_flow_gap", "safe_parse_counts",
    "landing_partitions", "upload_status", "tenant_count", "document_status",
}


@pytest.fixture(scope="module")
def plans(spark, folder):
    names = set(catalog.queries()) - STREAM_QUERIES
    return {name: plan_of(catalog.queries()[name](spark, folder)) for name in names}


def test_no_pair_of_all_rows_is_formed(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_python_runs_only_where_files_are_parsed(plans):
    for name, plan in plans.items():
        assert bool(re.search("EvalPython|InPandas|InArrow", plan)) == (name in PYTHON_QUERIES), name


def test_counts_are_partial_before_the_shuffle(plans):
    for name in COUNTING:
        assert "functions=[partial_" in plans[name], name
        assert "SortAggregate" not in plans[name], name


def test_no_unbounded_collection_or_window(plans):
    for name, plan in plans.items():
        assert "collect_list" not in plan and "collect_set" not in plan, name
        assert not re.search(r"\bWindow(Exec)? \[", plan) and "SinglePartition" not in plan, name


def test_chunking_is_narrow_and_splits_once(spark, folder):
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    plan = plan_of(chunking.chunk_text(texts))
    assert "Exchange" not in plan and plan.count("split(") == 1
    pages = texts.select("doc_id", F.array(F.struct(F.lit(1).alias("page"), "text")).alias("pages"))
    plan = plan_of(chunking.chunk_pages(pages))
    assert "Exchange" not in plan and plan.count("split(") == 1


def test_extraction_and_chunking_parse_each_file_once(spark, folder):
    kind = F.when(F.col("page_id") % 2 == 0, "text/html").otherwise("text/markdown")
    objects = spark.read.parquet(f"{folder}/pages.parquet").select(
        F.col("page_id").cast("string").alias("document_id"),
        F.lit("c").alias("company_id"),
        F.encode("html", "UTF-8").alias("content"),
        kind.alias("content_type"),
    )
    plan = plan_of(chunking.chunk_records(extraction.extract_text(objects)))
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
    once = {"split(": 1, "_html_to_text(": 1, "run(": 2, "&amp;": 2}  # two office readers; a rule's test and pattern
    assert {mark: plan.count(mark) for mark in once} == once
    documents_, _ = extraction.split_results(extraction.extract_text(objects))
    plan = plan_of(documents_)
    assert {mark: plan.count(mark) for mark in once} == {**once, "split(": 0}


def test_scans_read_only_needed_columns(plans):
    for name, columns in {
        "document_status": {"event_id", "ts", "user_id", "event_type"},
        "histogram_buckets": {"event_type", "value"},
        "duplicate_guard": {"doc_id", "source", "toxic"},
        "bulk_delete_remaining": {"doc_id", "source"},
    }.items():
        read = re.findall(r"ReadSchema: struct<([^>]*)>", plans[name])
        assert {c.split(":")[0] for part in read for c in part.split(",")} == columns, name


def test_registered_search_pushes_its_tenant(plans):
    assert "EqualTo(label,3)" in plans["tenant_topk"]


def test_similarity_keeps_k_rows_per_task_and_pushes_the_tenant(spark, tmp_path):
    path = str(tmp_path / "vectors")
    spark.createDataFrame(
        [("c", "d", "t", [1.0, 0.0])], "chunk_id STRING, document_id STRING, company_id STRING, vector ARRAY<FLOAT>"
    ).write.parquet(path)
    plan = plan_of(search.tenant_topk(spark.read.parquet(path), "t", [1.0, 0.0], 3))
    assert "TakeOrderedAndProject" in plan and "EqualTo(company_id,t)" in plan


def test_bucketed_chunks_are_replaced_without_moving_text(spark, tmp_path):
    def table(rows):
        return spark.createDataFrame(rows, "company_id STRING, document_id STRING, chunk_index INT, text STRING")

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    name = "chunks_bucketed_test"
    try:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS sheaf_test LOCATION '{tmp_path}/db'")
        write_chunk_table(table([("a", str(i), 0, "old") for i in range(20)]), f"sheaf_test.{name}", 4)
        stored = spark.table(f"sheaf_test.{name}")
        new = table([("a", "3", 0, "new")])
        replaced = documents.replace_documents(stored, new)
        plan = plan_of(replaced)
        left = plan[plan.index("LeftAnti") : plan.index("FileScan")]
        assert "Exchange" not in left
        assert replaced.count() == 20 and replaced.filter("text = 'new'").count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP DATABASE IF EXISTS sheaf_test CASCADE")
