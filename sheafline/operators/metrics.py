"""Operational metrics as aggregations over an observation table.

Observations are rows (ts, metric, labels, value).  Every aggregation is
partial per task before its only large shuffle; range expansion happens on
pre-aggregated steps, not on raw rows.
"""

from dataclasses import dataclass, field

from pyspark.sql import functions as F

# Bounds a histogram gets when it declares none.
LIBRARY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)


@dataclass(frozen=True)
class Counter:
    name: str
    labels: tuple = ()


@dataclass(frozen=True)
class Histogram:
    name: str
    labels: tuple = ()
    bounds: tuple = field(default=LIBRARY_BOUNDS)


# Metric names, label sets and bucket bounds.
COUNTERS = {
    c.name: c
    for c in (
        Counter("ingest_uploads_total", ("company_id", "content_type", "status")),
        Counter("ingest_kafka_messages_produced_total", ("topic", "status")),
        Counter("docproc_messages_consumed_total", ("topic", "status")),
        Counter("docproc_chunks_produced_total", ("company_id", "content_type")),
        Counter("docproc_processing_errors_total", ("stage",)),
        Counter("docproc_kafka_messages_produced_total", ("topic", "status")),
        Counter("embedding_messages_consumed_total", ("topic", "partition")),
        Counter("embedding_texts_processed_total", ("company_id",)),
        Counter("embedding_openai_api_errors_total", ("model_name", "error_type")),
        Counter("embedding_kafka_messages_produced_total", ("topic", "status")),
    )
}
HISTOGRAMS = {
    h.name: h
    for h in (
        Histogram(
            "ingest_upload_file_size_bytes",
            ("company_id", "content_type"),
            (10240, 51200, 102400, 524288, 1048576, 5242880, 10485760),
        ),
        Histogram("ingest_request_processing_duration_seconds", ("method", "path")),
        Histogram(
            "docproc_processing_duration_seconds",
            ("company_id", "content_type"),
            (0.1, 0.5, 1, 2, 5, 10, 30, 60),
        ),
        Histogram("docproc_s3_download_duration_seconds", (), (0.1, 0.5, 1, 2, 5, 10)),
        Histogram(
            "embedding_batch_processing_duration_seconds", (), (0.1, 0.5, 1, 2, 5, 10, 20, 30)
        ),
        Histogram("embedding_openai_api_duration_seconds", ("model_name",)),
    )
}
SCRAPE_STEP = "15 seconds"


@dataclass(frozen=True)
class Observed:
    """One measurement per row: a declared metric, its label columns, and the value.

    The value defaults to 1, as for a counter that goes up once per row.
    """

    name: str
    labels: dict
    value: object = None

    def struct(self):
        declared = (COUNTERS.get(self.name) or HISTOGRAMS[self.name]).labels
        if set(declared) != set(self.labels):
            raise ValueError(f"{self.name} has the labels {declared}, got {tuple(self.labels)}")
        pairs = [x for n in declared for x in (F.lit(n), self.labels[n].cast("string"))]
        return F.struct(
            F.lit(self.name).alias("metric"),
            F.create_map(*pairs).cast("map<string,string>").alias("labels"),
            (F.lit(1.0) if self.value is None else self.value.cast("double")).alias("value"),
        )


def observe(rows, *measurements, ts="ts", keep=()):
    """Observation rows (ts, metric, labels, value); several metrics share one scan.

    Columns named by ``keep`` stay beside them.
    """
    if len(measurements) == 1:
        made = rows.select(F.col(ts).alias("ts"), measurements[0].struct().alias("__o"), *keep)
    else:
        made = rows.select(
            F.col(ts).alias("ts"), F.explode(F.array(*[m.struct() for m in measurements])).alias("__o"), *keep
        )
    return made.select("ts", "__o.*", *keep)


def label(name):
    return F.col("labels")[name]


def label_matches(name, pattern):
    """Label match of the whole value; an absent label is the empty string."""
    return F.coalesce(label(name), F.lit("")).rlike(rf"(?s)\A(?:{pattern})\z")


def of_metric(observations, name):
    return observations.filter(F.col("metric") == name)


def counter_totals(observations):
    """Total per metric and label set, all metrics in one pass."""
    series = F.sort_array(F.map_entries("labels"))
    return (
        observations.groupBy("metric", series.alias("__series"))
        .agg(F.sum("value").alias("total"))
        .select("metric", F.map_from_entries("__series").alias("labels"), "total")
    )


def _bucket_columns(bounds, value):
    """One conditional count per bound; cumulative because every bound is tested."""
    return [F.count_if(value <= F.lit(float(b))).alias(f"__le_{i}") for i, b in enumerate(bounds)]


def _cumulative(bounds):
    return F.array(*[F.col(f"__le_{i}") for i in range(len(bounds))], F.col("count"))


def bound_labels(bounds):
    return [f"{b:g}" if b < 1e6 else str(b) for b in bounds] + ["+Inf"]


def bucket_counts(observations, by, bounds, value="value"):
    """Row per group: cumulative bucket counts (array ending in +Inf), sum and count.

    Bounds become conditional counts in one aggregation instead of a row per
    observation and bound.
    """
    v = F.col(value)
    counted = observations.groupBy(*by).agg(
        *_bucket_columns(bounds, v), F.sum(v).alias("sum"), F.count(v).alias("count")
    )
    names = [c for c in counted.columns if not c.startswith("__le_") and c not in ("sum", "count")]
    return counted.select(*names, _cumulative(bounds).alias("buckets"), "sum", "count")


def bucket_rows(counted, bounds):
    """One row per bucket with its ``le`` label."""
    keep = [c for c in counted.columns if c != "buckets"]
    labels = F.array(*[F.lit(x) for x in bound_labels(bounds)])
    pairs = F.arrays_zip(labels.alias("le"), F.col("buckets").alias("n"))
    return counted.select(*keep, F.explode(pairs).alias("__b")).select(
        *keep, F.col("__b.le").alias("le"), F.col("__b.n").alias("bucket_count")
    )


def histogram_series(observations):
    """Cumulative buckets per metric and label set, all declared histograms in one pass.

    Every distinct bound is counted once per group; a metric then shows its own bounds.
    Metrics that are not declared as histograms have no rows.
    """
    distinct = sorted({float(b) for h in HISTOGRAMS.values() for b in h.bounds})
    value = F.col("value")
    series = F.sort_array(F.map_entries("labels"))
    counted = observations.groupBy("metric", series.alias("__series")).agg(
        *_bucket_columns(distinct, value), F.sum(value).alias("sum"), F.count(value).alias("count")
    )

    def bucket(le, n):
        return F.struct(F.lit(le).alias("le"), n.alias("n"))

    chosen = F.lit(None)
    for name, h in HISTOGRAMS.items():
        counts = [F.col(f"__le_{distinct.index(float(b))}") for b in h.bounds] + [F.col("count")]
        own = F.array(*[bucket(le, n) for le, n in zip(bound_labels(h.bounds), counts)])
        chosen = F.when(F.col("metric") == name, own).otherwise(chosen)
    rows = counted.select("metric", F.map_from_entries("__series").alias("labels"), F.explode(chosen).alias("__b"), "sum", "count")
    return rows.select("metric", "labels", F.col("__b.le").alias("le"), F.col("__b.n").alias("bucket_count"), "sum", "count")


def bucket_quantile(buckets, bounds, q):
    """Quantile by linear interpolation inside the bucket that holds the rank.

    ``buckets`` is the cumulative array of :func:`bucket_counts`.  The lowest
    bucket starts at 0; a rank in the +Inf bucket gives the last finite bound;
    an empty histogram gives null.
    """
    uppers = [float(b) for b in bounds]
    rank = F.lit(float(q)) * F.element_at(buckets, -1)
    result = F.lit(uppers[-1])
    for i in reversed(range(len(uppers))):
        low = 0.0 if i == 0 else uppers[i - 1]
        below = F.lit(0) if i == 0 else F.get(buckets, F.lit(i - 1))
        here = F.get(buckets, F.lit(i))
        share = F.coalesce((rank - below) / F.nullif(here - below, F.lit(0)), F.lit(1.0))
        inside = F.lit(low) + (uppers[i] - low) * share
        result = F.when(here >= rank, inside).otherwise(result)
    return F.when(F.element_at(buckets, -1) > 0, result)


def step_expand(stepped, width_s, step_s, column="__step"):
    """Copy each pre-aggregated step into every range window that covers it."""
    offsets = F.array(*[F.expr(f"INTERVAL {i * step_s} SECONDS") for i in range(width_s // step_s)])
    starts = F.transform(offsets, lambda o: F.col(column) - o)
    keep = [c for c in stepped.columns if c != column]
    return stepped.select(*keep, F.explode(starts).alias("window_start"))


def _stepped(observations, step_s, by, aggregates):
    step = F.window("ts", f"{step_s} seconds")["start"]
    return observations.groupBy(step.alias("__step"), *by).agg(*aggregates)


def range_rate(observations, by, width_s=300, step_s=15):
    """Per-second rate over a sliding range, summed by the given label columns.

    ``by`` maps output names to columns.  Rows are first added up per step, so
    the range fan-out multiplies steps, not observations.
    """
    if width_s % step_s:
        raise ValueError("the range must be a multiple of the step")
    keys = [c.alias(n) for n, c in by.items()]
    stepped = _stepped(observations, step_s, keys, [F.sum("value").alias("__v")])
    return (
        step_expand(stepped, width_s, step_s)
        .groupBy("window_start", *by)
        .agg((F.sum("__v") / F.lit(width_s)).alias("rate"))
    )


def stream_rate(observations, by, width_s=300, step_s=15, delay="5 seconds"):
    """:func:`range_rate` of a stream, for append mode: each range is emitted once closed.

    Two aggregations in a row: observations are added up per step, and the steps that
    have closed are added up per range.  An observation is held once, in its step; only
    steps are copied into the ranges that cover them.
    """
    if width_s % step_s:
        raise ValueError("the range must be a multiple of the step")
    keys = [c.alias(n) for n, c in by.items()]
    step = F.window("ts", f"{step_s} seconds").alias("__step")
    stepped = observations.withWatermark("ts", delay).groupBy(step, *keys).agg(F.sum("value").alias("__v"))
    # A step counts with its last instant, so a range takes exactly the steps that lie in it.
    ranges = F.window(F.window_time("__step"), f"{width_s} seconds", f"{step_s} seconds").alias("w")
    rated = stepped.groupBy(ranges, *by).agg((F.sum("__v") / F.lit(width_s)).alias("rate"))
    return rated.select(F.col("w.start").alias("window_start"), *by, "rate")


def per_minute(observations, by):
    """Observations per minute: the one-minute rate of a histogram's count, times 60."""
    keys = [c.alias(n) for n, c in by.items()]
    return (
        observations.groupBy(F.window("ts", "1 minute")["start"].alias("window_start"), *keys)
        .agg(F.count(F.lit(1)).alias("per_minute"))
    )


def range_quantile(observations, bounds, q, by, width_s=300, step_s=15):
    """Bucket quantile over a sliding range by label, from per-step bucket counts."""
    if width_s % step_s:
        raise ValueError("the range must be a multiple of the step")
    keys = [c.alias(n) for n, c in by.items()]
    value = F.col("value")
    counts = [*_bucket_columns(bounds, value), F.count(value).alias("count")]
    stepped = _stepped(observations, step_s, keys, counts)
    names = [c for c in stepped.columns if c.startswith("__le_")] + ["count"]
    summed = (
        step_expand(stepped, width_s, step_s)
        .groupBy("window_start", *by)
        .agg(*[F.sum(n).alias(n) for n in names])
    )
    return summed.select(
        "window_start",
        *by,
        F.col("count").alias("n_observations"),
        bucket_quantile(_cumulative(bounds), bounds, q).alias("quantile"),
    )


# Items a sketch keeps of a level; its ranks are off by about 1.3 % with these.
SKETCH_SIZE = 200


def step_sketches(observations, by, step_s=15, size=SKETCH_SIZE):
    """(window_start, labels, sketch, n_observations) per step: a quantile sketch of the values.

    Sketches are a few kilobytes whatever they saw, and any of them can be merged: stored,
    they answer for every range that is a multiple of the step, without bounds chosen
    beforehand.
    """
    keys = [c.alias(n) for n, c in by.items()]
    sketch = F.kll_sketch_agg_double("value", F.lit(size)).alias("sketch")
    stepped = _stepped(observations.filter(F.col("value").isNotNull()), step_s, keys, [sketch, F.count("value").alias("n_observations")])
    return stepped.withColumnRenamed("__step", "window_start")


def range_sketch_quantile(sketches, q, by, width_s=300, step_s=15):
    """Quantile over a sliding range from the sketches of :func:`step_sketches`.

    Up to SKETCH_SIZE observations it is a value that occurs, at exactly that rank; beyond,
    its rank is close to ``q``.  :func:`range_quantile` needs bounds instead, and is off
    by up to the width of a bucket.
    """
    if width_s % step_s:
        raise ValueError("the range must be a multiple of the step")
    spread = step_expand(sketches, width_s, step_s, "window_start")
    merged = spread.groupBy("window_start", *by).agg(
        F.kll_merge_agg_double("sketch").alias("__sketch"), F.sum("n_observations").alias("n_observations")
    )
    return merged.select(
        "window_start", *by, "n_observations", F.kll_sketch_get_quantile_double("__sketch", F.lit(float(q))).alias("quantile")
    )
