import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sheafline.operators import metrics
from sheafline.schemas import OBSERVATION

BOUNDS = (0.1, 0.5, 1.0)


def quantile_model(buckets, bounds, q):
    """Rank, first bucket at or above it, straight line inside it."""
    total = buckets[-1]
    if not total:
        return None
    rank = q * total
    at = next(i for i, n in enumerate(buckets) if n >= rank)
    if at == len(bounds):
        return float(bounds[-1])
    low, below = (bounds[at - 1], buckets[at - 1]) if at else (0.0, 0)
    if buckets[at] == below:
        return float(bounds[at])
    return low + (bounds[at] - low) * (rank - below) / (buckets[at] - below)


@pytest.mark.parametrize("q, expected", [(0.95, 1.0), (0.5, 0.42), (0.99, 1.0)])
def test_quantile_fixture(spark, q, expected):
    df = spark.createDataFrame([([10, 60, 95, 100],)], "b ARRAY<LONG>")
    assert df.select(metrics.bucket_quantile(F.col("b"), BOUNDS, q)).first()[0] == pytest.approx(expected)


def test_quantile_against_model(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(60):
        steps = [rng.choice([0, 0, 1, 5, 40]) for _ in range(4)]
        rows.append(([sum(steps[: i + 1]) for i in range(4)],))
    df = spark.createDataFrame(rows, "b ARRAY<LONG>")
    for q in (0.0, 0.25, 0.5, 0.95, 1.0):
        got = [r[0] for r in df.select(metrics.bucket_quantile(F.col("b"), BOUNDS, q)).collect()]
        for (b,), value in zip(rows, got):
            expected = quantile_model(b, BOUNDS, q)
            assert (value is None) == (expected is None)
            assert value is None or value == pytest.approx(expected)


def test_bucket_rows(spark):
    df = spark.createDataFrame([("a", v) for v in (0.05, 0.1, 0.4, 0.9, 7.0)], "k STRING, value DOUBLE")
    counted = metrics.bucket_counts(df, ["k"], BOUNDS)
    rows = {r.le: r for r in metrics.bucket_rows(counted, BOUNDS).collect()}
    assert {le: r.bucket_count for le, r in rows.items()} == {"0.1": 2, "0.5": 3, "1": 4, "+Inf": 5}
    assert rows["+Inf"]["count"] == 5 and rows["0.1"]["sum"] == pytest.approx(8.45)


def test_declared_metrics():
    assert len(metrics.COUNTERS) == 10 and len(metrics.HISTOGRAMS) == 6
    size = metrics.HISTOGRAMS["ingest_upload_file_size_bytes"]
    assert metrics.bound_labels(size.bounds)[0] == "10240" and size.bounds[-1] == 10 * 1024 * 1024
    assert metrics.HISTOGRAMS["embedding_openai_api_duration_seconds"].bounds == metrics.LIBRARY_BOUNDS


def observations(spark, rows):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    return spark.createDataFrame(
        [(start + dt.timedelta(seconds=s), m, labels, float(v)) for s, m, labels, v in rows], OBSERVATION
    )


def test_counter_totals_by_label_set(spark):
    df = observations(
        spark,
        [(0, "m", {"a": "1", "b": "2"}, 1), (9, "m", {"b": "2", "a": "1"}, 2), (9, "m", {"a": "1"}, 4), (9, "n", {}, 8)],
    )
    got = {(r.metric, tuple(sorted(r.labels.items()))): r.total for r in metrics.counter_totals(df).collect()}
    assert got == {("m", (("a", "1"), ("b", "2"))): 3.0, ("m", (("a", "1"),)): 4.0, ("n", ()): 8.0}


def test_range_rate_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.uniform(0, 400), "m", {"k": rng.choice("xy")}, rng.randint(1, 3)) for _ in range(80)]
    rated = metrics.range_rate(observations(spark, rows), {"k": metrics.label("k")}, width_s=60, step_s=15)
    got = {(int(r.s), r.k): r.rate for r in rated.select(F.unix_timestamp("window_start").alias("s"), "k", "rate").collect()}
    start = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    expected = {}
    for w in range(-60, 405, 15):
        for k in "xy":
            total = sum(v for s, _, labels, v in rows if labels["k"] == k and w <= s < w + 60)
            if total:
                expected[(start + w, k)] = pytest.approx(total / 60)
    assert got == expected
    with pytest.raises(ValueError):
        metrics.range_rate(observations(spark, rows), {}, width_s=50, step_s=15)


def test_label_filter_is_anchored(spark):
    labels = [{"status": s} for s in ("error_client", "error_server", "an error_x", "success", "success\n")] + [{}]
    df = observations(spark, [(0, "m", x, 1) for x in labels])
    matched = df.filter(metrics.label_matches("status", "error_.*")).collect()
    assert sorted(r.labels["status"] for r in matched) == ["error_client", "error_server"]
    assert df.filter(metrics.label_matches("status", "")).count() == 1
    assert df.filter(metrics.label_matches("status", "success")).count() == 1


def test_observe_checks_labels(spark):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(start, "c", "t", 5)], "ts TIMESTAMP, company STRING, kind STRING, size LONG")
    size = metrics.Observed(
        "ingest_upload_file_size_bytes", {"company_id": F.col("company"), "content_type": F.col("kind")}, F.col("size")
    )
    download = metrics.Observed("docproc_s3_download_duration_seconds", {}, F.lit(0.5))
    row = metrics.observe(df, size).first()
    assert row.labels == {"company_id": "c", "content_type": "t"} and row.value == 5.0
    both = metrics.observe(df, size, download)
    assert both.schema.names == ["ts", "metric", "labels", "value"]
    assert {r.metric: (len(r.labels), r.value) for r in both.collect()} == {size.name: (2, 5.0), download.name: (0, 0.5)}
    with pytest.raises(ValueError):
        metrics.observe(df, metrics.Observed(size.name, {"company_id": F.col("company")}))


def test_streamed_rate_equals_batch_rate_for_closed_ranges(spark, tmp_path):
    rng = random.Random(5)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(rng.uniform(0, 200), "m", {"k": rng.choice("xy")}, 1) for _ in range(60)]
    observations(spark, rows + [(600, "m", {"k": "x"}, 1)]).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(OBSERVATION).parquet(source)
    rated = metrics.stream_rate(stream, {"k": metrics.label("k")}, 60, 15)
    query = rated.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
    query = query.trigger(availableNow=True).start(out)
    query.awaitTermination()
    # Every observation is held once, in its step: at most one row per step and label, not one per range.
    held = [p["stateOperators"] for p in query.recentProgress if p["stateOperators"]]
    steps = len({(int(r[0] // 15), r[2]["k"]) for r in rows}) + 1
    assert len(held[0]) == 2 and max(o[-1]["numRowsTotal"] for o in held) <= steps
    batch = metrics.range_rate(spark.read.parquet(source), {"k": metrics.label("k")}, 60, 15)
    closed = batch.filter(F.unix_timestamp("window_start") <= F.lit(1704067200 + 595 - 60))
    streamed = spark.read.schema(rated.schema).parquet(out)
    assert streamed.count() == closed.count() > 20
    assert streamed.exceptAll(closed.select(*streamed.columns)).isEmpty()


def test_sketches_merge_over_ranges(spark):
    rng = random.Random(9)
    rows = [(rng.uniform(0, 600), "m", {"k": rng.choice("xy")}, rng.gauss(0, 1)) for _ in range(4001)]
    rows = observations(spark, rows)
    first = rows.agg(F.min("value")).first()[0]
    rows = rows.withColumn("value", F.nullif("value", F.lit(first)))
    sketches = metrics.step_sketches(rows, {"k": metrics.label("k")})
    assert {r["k"] for r in sketches.collect()} == {"x", "y"} and sketches.agg(F.sum("n_observations")).first()[0] == 4000
    for width in (60, 300):
        got = metrics.range_sketch_quantile(sketches, 0.75, {"k": F.col("k")}, width)
        values = [(r["ts"], r["labels"]["k"], r["value"]) for r in rows.collect() if r["value"] is not None]
        for r in got.collect():
            inside = [v for t, k, v in values if k == r["k"] and 0 <= (t - r["window_start"]).total_seconds() < width]
            assert len(inside) == r["n_observations"]
            rank = sum(v <= r["quantile"] for v in inside) / len(inside)
            assert abs(rank - 0.75) <= 0.02 + 1 / len(inside)
    with pytest.raises(ValueError):
        metrics.range_sketch_quantile(sketches, 0.5, {"k": F.col("k")}, 50)
