"""Metric queries."""

from pyspark.sql import functions as F

from sheafline.operators import metrics
from sheafline.plans import inputs
from sheafline.plans.registry import query
from sheafline.plans.sqltext import ISO

UPLOADS = "ingest_uploads_total"
DURATION = metrics.HISTOGRAMS["docproc_processing_duration_seconds"]
UPLOAD_SIZE = metrics.HISTOGRAMS["ingest_upload_file_size_bytes"]
QUANTILE_RANGE_S = 6 * 3600
QUANTILE_STEP_S = 3600


def window_starts(df):
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss"))


def _counted(name):
    return metrics.Observed(name, {n: F.col(n) for n in metrics.COUNTERS[name].labels})


def uploads(spark, folder):
    """One upload observation per request."""
    return metrics.observe(inputs.REQUESTS.frame(spark, folder), _counted(UPLOADS))


def durations(spark, folder):
    """One processing duration per request, labelled by type."""
    return inputs.REQUESTS.frame(spark, folder).select(
        "ts", "content_type", (F.col("value") / 4).alias("value")
    )


# Labels the requests do not carry themselves.
EXTRA_LABELS = {
    "topic": "concat('topic-', event_type)",
    "partition": "CAST(CAST(company_id AS BIGINT) % 4 AS STRING)",
    "model_name": "'hashed-words'",
    "error_type": "concat(event_type, '-', stage)",
    "method": "CASE WHEN event_type = 'view' THEN 'GET' ELSE 'POST' END",
    "path": "concat('/', event_type)",
}


def labelled_requests(spark, folder):
    """Requests with a column for every label of every metric."""
    requests = inputs.REQUESTS.frame(spark, folder)
    return requests.select("*", *[F.expr(e).alias(n) for n, e in EXTRA_LABELS.items()])


LABELLED_SQL = f"(SELECT *, {', '.join(f'{e} AS {n}' for n, e in EXTRA_LABELS.items())} FROM {inputs.REQUESTS.sql})"


def _labels_sql(names):
    return "concat('', " + ", ',', ".join([f"'{n}=', {n}" for n in sorted(names)] or ["''"]) + ")"


def _labels_text(rows):
    pairs = F.transform(F.map_entries("labels"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return rows.withColumn("labels", F.array_join(F.array_sort(pairs), ","))


@query(
    "counters",
    "SELECT metric, labels, CAST(count(*) AS DOUBLE) AS total FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c.name}' AS metric, {_labels_sql(c.labels)} AS labels FROM {LABELLED_SQL}"
        for c in metrics.COUNTERS.values()
    )
    + ") GROUP BY ALL",
)
def counters(spark, folder):
    """Each request counts in all ten counters, under each one's own label set, in one scan."""
    observations = metrics.observe(labelled_requests(spark, folder), *[_counted(n) for n in metrics.COUNTERS])
    return _labels_text(metrics.counter_totals(observations))


def _bucket_sql(source, by, value, bounds, digits=2):
    labels = metrics.bound_labels(bounds)
    rows = ", ".join(
        [f"('{text}', {float(b)})" for text, b in zip(labels, bounds)] + ["('+Inf', CAST('Infinity' AS DOUBLE))"]
    )
    return f"""SELECT {by}, le, count(*) FILTER (v <= bound) AS bucket_count, round(sum(v), {digits}) AS sum, count(v) AS count
               FROM (SELECT {by}, {value} AS v FROM {source}), (VALUES {rows}) b(le, bound) GROUP BY {by}, le"""


@query(
    "histogram_buckets",
    _bucket_sql(inputs.REQUESTS.sql, "content_type", "value / 4", DURATION.bounds),
)
def histogram_buckets(spark, folder):
    counted = metrics.bucket_counts(durations(spark, folder), ["content_type"], DURATION.bounds)
    rows = metrics.bucket_rows(counted, DURATION.bounds)
    return rows.withColumn("sum", F.round("sum", 2))


@query(
    "histogram_upload_size",
    _bucket_sql(inputs.UPLOADS.sql, "company_id, content_type", "CAST(size_bytes AS DOUBLE)", UPLOAD_SIZE.bounds),
)
def histogram_upload_size(spark, folder):
    sizes = inputs.UPLOADS.frame(spark, folder).select(
        "company_id", "content_type", F.col("size_bytes").cast("double").alias("value")
    )
    counted = metrics.bucket_counts(sizes, ["company_id", "content_type"], UPLOAD_SIZE.bounds)
    return metrics.bucket_rows(counted, UPLOAD_SIZE.bounds).withColumn("sum", F.round("sum", 2))


# What a request measures: bytes of an upload, seconds of everything else.
SERIES_VALUES = {n: "value * 10000" if n.endswith("_bytes") else "value / 4" for n in metrics.HISTOGRAMS}


@query(
    "histogram_series",
    " UNION ALL ".join(
        _bucket_sql(
            f"(SELECT '{h.name}' AS metric, {_labels_sql(h.labels)} AS labels, {SERIES_VALUES[h.name]} AS measured FROM {LABELLED_SQL})",
            "metric, labels", "measured", h.bounds, digits=4,
        )
        for h in metrics.HISTOGRAMS.values()
    ),
)
def histogram_series(spark, folder):
    """All six histograms under their own label sets, in one scan."""
    measured = [
        metrics.Observed(h.name, {n: F.col(n) for n in h.labels}, F.expr(SERIES_VALUES[h.name]))
        for h in metrics.HISTOGRAMS.values()
    ]
    series = metrics.histogram_series(metrics.observe(labelled_requests(spark, folder), *measured))
    return _labels_text(series).withColumn("sum", F.round("sum", 4))


def rate_sql(where):
    return f"""SELECT strftime(time_bucket(INTERVAL '15 seconds', ts) - to_seconds(15 * i), {ISO}) AS window_start,
                      content_type, round(count(*) / 300.0::DOUBLE, 8) AS rate
               FROM {inputs.REQUESTS.sql}, (SELECT unnest(range(20)) AS i) WHERE {where} GROUP BY ALL"""


def _rate(observations):
    rated = metrics.range_rate(observations, {"content_type": metrics.label("content_type")})
    return window_starts(rated).withColumn("rate", F.round("rate", 8))


@query("rate_5m", rate_sql("status = 'success'"))
def rate_5m(spark, folder):
    return _rate(uploads(spark, folder).filter(metrics.label("status") == "success"))


@query("error_rate", rate_sql("regexp_full_match(status, 'error_.*')"))
def error_rate(spark, folder):
    return _rate(uploads(spark, folder).filter(metrics.label_matches("status", "error_.*")))


@query(
    "throughput_1m",
    f"""SELECT strftime(time_bucket(INTERVAL '1 minute', ts), {ISO}) AS window_start, content_type,
               count(*) AS per_minute FROM {inputs.REQUESTS.sql} GROUP BY ALL""",
)
def throughput_1m(spark, folder):
    return window_starts(metrics.per_minute(durations(spark, folder), {"content_type": F.col("content_type")}))


def _quantile_sql(q, bounds):
    """Bucket table, first bucket that reaches the rank, interpolation inside it."""
    rows = ", ".join(f"({float(b)})" for b in bounds)
    return f"""
      WITH o AS (
        SELECT time_bucket(INTERVAL '1 hour', ts) - to_hours(i) AS w, content_type, value / 4 AS v
        FROM {inputs.REQUESTS.sql}, (SELECT unnest(range(6)) AS i)),
      b AS (SELECT * FROM (VALUES {rows}, (CAST('Infinity' AS DOUBLE))) t(le)),
      c AS (SELECT w, content_type, le, count(*) FILTER (v <= le) AS n, count(*) AS total
            FROM o, b GROUP BY w, content_type, le),
      d AS (SELECT *, {q} * total AS rank, coalesce(lag(n) OVER s, 0) AS below, coalesce(lag(le) OVER s, 0) AS low
            FROM c WINDOW s AS (PARTITION BY w, content_type ORDER BY le)),
      f AS (SELECT * FROM d WHERE n >= rank QUALIFY row_number() OVER (PARTITION BY w, content_type ORDER BY le) = 1)
      SELECT strftime(w, {ISO}) AS window_start, content_type, total AS n_observations,
             round(CASE WHEN isinf(le) THEN {float(bounds[-1])} ELSE low + (le - low) * (rank - below) / (n - below) END, 6) AS quantile
      FROM f"""


@query("histogram_p95", _quantile_sql("0.95::DOUBLE", DURATION.bounds))
def histogram_p95(spark, folder):
    found = metrics.range_quantile(
        durations(spark, folder),
        DURATION.bounds,
        0.95,
        {"content_type": F.col("content_type")},
        QUANTILE_RANGE_S,
        QUANTILE_STEP_S,
    )
    return window_starts(found).withColumn("quantile", F.round("quantile", 6))


_SKETCH_Q = 0.9
# How far the rank of a sketch's answer may lie from the rank asked for.
SKETCH_ERROR = 0.02
_RANGES_SQL = f"""(SELECT time_bucket(INTERVAL '1 hour', ts) - to_hours(i) AS w, content_type, value / 4 AS v
    FROM {inputs.REQUESTS.sql}, (SELECT unnest(range(6)) AS i))"""


@query(
    "quantile_kinds",
    f"""WITH o AS {_RANGES_SQL},
        exact AS (SELECT w, content_type, count(*) AS n, quantile_cont(v, {_SKETCH_Q}) AS exact FROM o GROUP BY w, content_type),
        bucket AS ({_quantile_sql(f"{_SKETCH_Q}::DOUBLE", DURATION.bounds)}),
        ranks AS (SELECT o.w, o.content_type, count(*) FILTER (v <= quantile) AS below
            FROM o JOIN bucket b ON strftime(o.w, {ISO}) = b.window_start AND o.content_type = b.content_type GROUP BY ALL)
        SELECT b.window_start, b.content_type, n AS n_observations, round(exact, 6) AS exact, quantile AS bucket,
            round(abs(below / n::DOUBLE - {_SKETCH_Q}), 6) AS bucket_rank_error, true AS sketch_rank_near
        FROM exact e JOIN ranks r USING (w, content_type)
        JOIN bucket b ON strftime(e.w, {ISO}) = b.window_start AND e.content_type = b.content_type""",
)
def quantile_kinds(spark, folder):
    """The same quantile three ways, with the error in rank: exact, from buckets, from merged sketches."""
    rows, by = durations(spark, folder), {"content_type": F.col("content_type")}
    widths = (QUANTILE_RANGE_S, QUANTILE_STEP_S)
    bucket = metrics.range_quantile(rows, DURATION.bounds, _SKETCH_Q, by, *widths).drop("n_observations")
    sketch = metrics.range_sketch_quantile(metrics.step_sketches(rows, by, QUANTILE_STEP_S), _SKETCH_Q, by, *widths)
    keys = ["window_start", "content_type"]
    # Only this comparison copies raw rows into ranges; none of the operators does.
    step = F.window("ts", f"{QUANTILE_STEP_S} seconds")["start"]
    spread = metrics.step_expand(rows.withColumn("__step", step), *widths).select(*keys, "value")
    answers = bucket.withColumnRenamed("quantile", "bucket").join(sketch.withColumnRenamed("quantile", "sketch"), keys)
    ranked = spread.join(answers, keys).groupBy(*keys, "n_observations", "bucket", "sketch").agg(
        F.percentile("value", _SKETCH_Q).alias("exact"),
        (F.count_if(F.col("value") <= F.col("bucket")) / F.count("*")).alias("bucket_rank"),
        (F.count_if(F.col("value") <= F.col("sketch")) / F.count("*")).alias("sketch_rank"),
    )
    near = F.abs(F.col("sketch_rank") - _SKETCH_Q) <= F.lit(SKETCH_ERROR) + 1 / F.col("n_observations")
    return window_starts(ranked).select(
        *keys,
        "n_observations",
        F.round("exact", 6).alias("exact"),
        F.round("bucket", 6).alias("bucket"),
        F.round(F.abs(F.col("bucket_rank") - _SKETCH_Q), 6).alias("bucket_rank_error"),
        near.alias("sketch_rank_near"),
    )
