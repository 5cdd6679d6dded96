"""Time the headline queries and print one JSON line.

Settings: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_RUNS
(timed runs per query, the median counts; one untimed run goes first).
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sheafline import build_session  # noqa: E402
from sheafline.plans import catalog  # noqa: E402

HEADLINE = (
    "chunks",
    "page_chunks",
    "document_summary",
    "daily_report",
    "embed_chunks",
    "html_text",
    "markdown_text",
    "safe_parse_counts",
    "window_1m",
    "counters",
    "histogram_buckets",
    "histogram_p95",
    "rate_5m",
    "status_reconcile",
    "chunk_upsert",
    "tenant_topk",
)


def run(query, spark, folder):
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.sheafline.inputPartitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in HEADLINE:
        query = catalog.queries()[name]
        run(query, spark, folder)
        timings[name] = round(statistics.median(run(query, spark, folder) for _ in range(runs)), 3)
    spark.stop()
    total = round(sum(timings.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": timings, "sf": scale}))


if __name__ == "__main__":
    main()
