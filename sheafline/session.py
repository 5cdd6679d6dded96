"""Session defaults and the shared working folder."""

from __future__ import annotations

import math
import os
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Static and runtime defaults for a session this package creates itself.  AQE
# picks the reducer count from the real shuffle sizes and splits skewed join
# partitions, but only merges what the initial partition number has cut: set that from
# the size of the input (``build_session(input_bytes=...)``) for large jobs.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Settings results depend on; applied to any session handed to the package.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # the last of two equal JSON keys wins
    "spark.sql.variant.allowDuplicateKeys": "true",
}


# Shuffled bytes a reducer should start from at most.
REDUCER_BYTES = 128 * 1024**2


def build_session(app_name="sheafline", master=None, input_bytes=None, **conf):
    """Create (or reuse) a session with the package defaults; ``conf`` overrides.

    ``input_bytes``, the size of what a job reads, sets the initial number of shuffle
    partitions; 100 TB start with 800,000, which adaptive execution merges.
    """
    if input_bytes is not None:
        partitions = max(200, math.ceil(input_bytes / REDUCER_BYTES))
        conf.setdefault("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark):
    """Apply the runtime settings that results depend on and return the session.

    Every table read of this package does so, on the session it is given: the time zone
    becomes UTC and of two equal JSON keys the last one counts.
    """
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# Bytes of rows a Python worker is handed at a time.
BATCH_BYTES = "8m"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(df):
    """``df``, whose session from now on bounds what goes to Python at a time in bytes, not only in rows.

    By default 10,000 rows go together, which are gigabytes where texts are long.  A bound the
    session's owner has set stays.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, BATCH_BYTES)
    return df


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
# Spark's default, which holds one column family only; processors have one per state variable.
PLAIN_STORE = "HDFSBackedStateStoreProvider"
# What is to be put on the path of Python workers: the folder or archive that holds this package.
PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@contextmanager
def stateful_processors(spark):
    """For the calls that give a stream a stateful processor, on any session.

    Streams started on the session from now on keep their state in RocksDB, unless its owner
    chose a store other than Spark's default one, which refuses processors; a restarted stream
    keeps the store it began with.  The first batch runs the processor on the driver, in a worker
    that does not get the files given by ``--py-files`` or ``addPyFile``, so the processor's
    environment names where the package is.
    """
    if spark.conf.get(STATE_STORE).endswith(PLAIN_STORE):
        spark.conf.set(STATE_STORE, SESSION_DEFAULTS[STATE_STORE])
    environment = spark.sparkContext.environment
    before = environment.get("PYTHONPATH")
    inherited = spark._jvm.java.lang.System.getenv("PYTHONPATH")
    known = os.pathsep.join(p for p in (before, inherited) if p).split(os.pathsep)
    if PACKAGE_ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (before, PACKAGE_ROOT) if p)
    try:
        yield
    finally:
        environment.pop("PYTHONPATH", None)
        if before is not None:
            environment["PYTHONPATH"] = before


# Folders named inside the innermost temporary_folders block, if there is one.
_NAMED = ContextVar("named_folders", default=None)


def shared_folder(spark, purpose):
    """A new folder for checkpoints and stage tables, reachable by every executor.

    The cluster names the parent in ``spark.checkpoint.dir``.  Without that setting a
    folder in the warehouse is used, which all executors share as well.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if not parent:
        parent = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
    folder = f"{parent.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if _NAMED.get() is not None:
        _NAMED.get().append(folder)
    return folder


def file_system(spark, folder):
    """(file system, path) of a folder, by the session's own settings."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


@contextmanager
def temporary_folders(spark):
    """Delete at its end every folder that :func:`shared_folder` names inside the block.

    For stage tables nothing reads any more once the result is written or collected.
    """
    named = []
    token = _NAMED.set(named)
    try:
        yield
    finally:
        _NAMED.reset(token)
        for folder in named:
            system, path = file_system(spark, folder)
            system.delete(path, True)


def finished(spark, purpose, make):
    """The rows of ``make()`` as a table, without the stage tables made on the way."""
    path = shared_folder(spark, purpose)
    with temporary_folders(spark):
        rows = make()
        schema = rows.schema
        rows.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def stored(df, purpose):
    """The rows of ``df`` as a table in the shared folder, computed once.

    For values that must be the same wherever they are used, such as row numbers.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
