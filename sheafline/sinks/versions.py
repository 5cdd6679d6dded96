"""A chunk table in versioned buckets, for replacing documents while others read.

Documents are spread over a fixed number of buckets.  A batch writes a new version of
the buckets its documents lie in, and nothing else; then it writes one row that says
which version of each bucket holds.  Readers go by the newest such row, so they see a
batch whole or not at all, and a batch that died halfway is simply written again.
"""

from pyspark import StorageLevel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.operators.documents import KEY, replace_documents
from sheafline.session import file_system
from sheafline.sinks.tables import CHECKPOINT_TRIGGER

VERSIONS = "_versions"
DATA = "data"
BUCKETS = 64
_ENTRY = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("version", T.LongType())])
_MANIFEST = T.StructType([T.StructField("buckets", T.ArrayType(_ENTRY)), T.StructField("version", T.LongType())])


def _exists(spark, folder):
    system, path = file_system(spark, folder)
    return system.exists(path)


class VersionedTable:
    """Rows of ``schema`` (with company_id and document_id) below ``root``, in ``buckets`` buckets."""

    def __init__(self, spark, root, schema, buckets=BUCKETS):
        self.spark, self.root, self.schema, self.buckets = spark, root.rstrip("/"), schema, buckets

    def bucket_of(self):
        return F.pmod(F.xxhash64(*KEY), F.lit(self.buckets)).cast("int")

    def manifests(self):
        """{version: {bucket: version that holds}} of all committed batches; one entry per bucket."""
        if not _exists(self.spark, f"{self.root}/{VERSIONS}"):
            return {}
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/{VERSIONS}").collect()
        return {r["version"]: {e["bucket"]: e["version"] for e in r["buckets"]} for r in rows}

    def current(self):
        """(version, {bucket: version that holds}); version is None before the first batch."""
        committed = self.manifests()
        newest = max(committed, default=None)
        return newest, committed.get(newest, {})

    def _folder(self, bucket, version):
        return f"{self.root}/{DATA}/bucket={bucket}/version={version}"

    def _read(self, entries):
        if not entries:
            return self.spark.createDataFrame([], self.schema)
        folders = [self._folder(b, v) for b, v in sorted(entries.items())]
        return self.spark.read.schema(self.schema).option("basePath", f"{self.root}/{DATA}").parquet(*folders).select(*self.schema.names)

    def read(self):
        """All rows as of the newest committed batch."""
        return self._read(self.current()[1])

    def replace(self, processed, incoming, version):
        """Make ``incoming`` the only rows of the ``processed`` documents, as batch ``version``.

        Only the buckets of processed documents are read and written, so ``incoming`` must hold
        no other documents.  Rows without company or document match none and are added.
        Writing a version that is committed already changes nothing, so a repeated batch is
        harmless.
        """
        newest, entries = self.current()
        if newest is not None and version <= newest:
            return
        touched = [r[0] for r in processed.select(self.bucket_of()).distinct().collect()]
        old = self._read({b: v for b, v in entries.items() if b in set(touched)})
        rows = replace_documents(old, incoming.select(*self.schema.names), processed.select(*KEY))
        # One bucket may hold most of the rows; the hint splits it over several tasks.
        placed = rows.withColumns({"bucket": self.bucket_of(), "version": F.lit(version)}).hint("rebalance", "bucket")
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("bucket", "version").parquet(f"{self.root}/{DATA}")
        held = {b: v for b, v in entries.items() if b not in set(touched)}
        held |= {b: version for b in touched if _exists(self.spark, self._folder(b, version))}
        self._commit(version, held)

    def _commit(self, version, entries):
        # A single file, which its rename makes visible at once.
        listed = [(sorted(entries.items()),)]
        row = self.spark.createDataFrame(listed, T.StructType(_MANIFEST.fields[:1])).coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.root}/{VERSIONS}/version={version}")

    def drop_old_versions(self, keep=2):
        """Delete bucket versions no reader of the newest ``keep`` batches needs; returns how many."""
        committed = self.manifests()
        newest = sorted(committed)[-keep:] if keep > 0 else []
        needed = {e for v in newest for e in committed[v].items()}
        known = {e for entries in committed.values() for e in entries.items()}
        for bucket, version in sorted(known - needed):
            system, path = file_system(self.spark, self._folder(bucket, version))
            system.delete(path, True)
        for version in sorted(set(committed) - set(newest)):
            system, path = file_system(self.spark, f"{self.root}/{VERSIONS}/version={version}")
            system.delete(path, True)
        return len(known - needed)


def newest_documents(rows, order):
    """Each document of a batch once: the row with the highest ``order``, of equal ones the highest hash."""
    hashed = rows.withColumn("__hash", F.xxhash64(*rows.columns))
    rank = F.struct(F.col(order).alias("order"), F.col("__hash").alias("hash"))
    last = hashed.groupBy(*KEY).agg(F.max(rank).alias("__last")).select(*[F.col(k).alias(f"__{k}") for k in KEY], "__last")
    same = F.lit(True)
    for k in KEY:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    same = same & F.col(order).eqNullSafe(F.col("__last.order")) & (F.col("__hash") == F.col("__last.hash"))
    # Copies of the winning row agree in all columns.
    return hashed.join(last, same).select(*rows.columns).dropDuplicates(list(KEY))


def start_replacing(documents, table, make_chunks, checkpoint, order="updated_at", trigger=None):
    """Keep ``table`` at the chunks ``make_chunks`` gives for the newest version of each document.

    A document that comes again replaces its chunks, also by none.  Inside a batch the
    row with the highest ``order`` counts; a later batch replaces an earlier one.
    """

    def replace(batch, number):
        held = newest_documents(batch, order).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            table.replace(held.select(*KEY), make_chunks(held), number)
        finally:
            held.unpersist()

    writer = documents.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": CHECKPOINT_TRIGGER})).start()
