"""Landed JSON records, partitioned by topic and hour."""

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITIONS = ("year", "month", "day", "hour")


def with_partitions(rows, ts="timestamp"):
    """Add the UTC hour partition columns of a record time."""
    forms = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return rows.withColumns({name: F.date_format(ts, form) for name, form in forms.items()})


def read_landing(spark, root, schema=None, topic=None):
    """Landed records below ``root``; a topic narrows the scan to its folders.

    With a schema nothing is read before the query runs, and fields left out of
    it (such as a vector) are never parsed.  Without one Spark infers it, which
    costs a pass over the data.
    """
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(_with_parts(schema))
    landed = reader.json(root)
    return landed if topic is None else landed.filter(F.col("topic") == topic)


def _with_parts(schema):
    parts = ("topic", *PARTITIONS)
    kinds = [T.StructField(name, T.StringType()) for name in parts]
    return T.StructType([f for f in schema.fields if f.name not in parts] + kinds)


def read_landing_day(spark, root, schema, day, topic="*"):
    """Landed records of one UTC day: only the folders of that day are listed.

    Reading the whole tree and filtering prunes the scan, but the driver lists every file
    first.  A day nothing landed on has no rows.
    """
    day = dt.date.fromisoformat(day) if isinstance(day, str) else day
    known = _with_parts(schema)
    try:
        return (
            spark.read.option("basePath", root).schema(known)
            .json(f"{root.rstrip('/')}/topic={topic}/year={day:%Y}/month={day:%m}/day={day:%d}")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], known)


def day_filter(day):
    """Partition predicate of one UTC day, comparable with zero-padded or inferred values."""
    day = dt.date.fromisoformat(day) if isinstance(day, str) else day
    return (
        (F.col("year").cast("int") == day.year)
        & (F.col("month").cast("int") == day.month)
        & (F.col("day").cast("int") == day.day)
    )


def require_columns(df, names):
    """Raise before any job runs when a report's columns are missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"required columns not found: {', '.join(missing)}")
    return df
