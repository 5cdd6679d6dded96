"""Several tables from one streaming query, each batch in all of them or in none.

A batch is written once per output, into a folder of its own number, and counts only
from the moment its commit row is written.  A query that dies between two outputs
repeats the batch under the same number when it restarts: every folder is then written
anew, so nothing is doubled and nothing is missing.
"""

import inspect
import time

from pyspark import StorageLevel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.sinks.tables import CHECKPOINT_TRIGGER

BATCH = "batch_id"
COMMITS = "_commits"
COMMIT = T.StructType([T.StructField("outputs", T.ArrayType(T.StringType())), T.StructField(BATCH, T.LongType())])


def _folder(root, name, batch):
    return f"{root.rstrip('/')}/{name}/{BATCH}={batch}"


def write_batch(rows, batch, outputs, root):
    """Write one batch to every output, then its commit row.

    The batch is computed once and kept on the executors meanwhile, in memory or on
    disk; what a lost executor held is computed again.
    """
    started = time.monotonic()
    held = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, derive in outputs.items():
            more = [(time.monotonic() - started) * 1000] if len(inspect.signature(derive).parameters) > 1 else []
            derive(held, *more).write.mode("overwrite").parquet(_folder(root, name, batch))
        names = F.array(*[F.lit(n) for n in outputs])
        commit = rows.sparkSession.range(1).select(names.alias("outputs"))
        commit.coalesce(1).write.mode("overwrite").parquet(_folder(root, COMMITS, batch))
    finally:
        held.unpersist()


def start_fan_out(rows, outputs, root, checkpoint, trigger=None):
    """Start a query that writes ``{name: function of a batch}`` as tables below ``root``.

    Functions get the batch as a plain DataFrame and return what their table takes of it:
    joins, aggregates and several passes are allowed, as they are not on a stream.  Tables
    are written in the order given; a function of two arguments also gets the milliseconds
    its batch has taken until then.
    """
    for name in outputs:
        if not name or "/" in name or name.startswith(("_", ".")):
            raise ValueError(f"not a name for an output: {name!r}")
    writer = rows.writeStream.foreachBatch(lambda held, batch: write_batch(held, batch, outputs, root))
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": CHECKPOINT_TRIGGER})).start()


def committed_batches(spark, root):
    """Numbers of the batches that reached every output, as ``batch_id``."""
    path = f"{root.rstrip('/')}/{COMMITS}"
    return spark.read.schema(COMMIT).parquet(path).select(BATCH)


def read_fan_out(spark, root, name, schema):
    """Rows of one output, with ``batch_id``, of committed batches only.

    The commit rows are few and narrow; joined on the partition column, they also keep
    the folders of an unfinished batch from being read.
    """
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())]))
    return rows.parquet(f"{root.rstrip('/')}/{name}").join(committed_batches(spark, root), BATCH, "left_semi")
