"""Pairings between events, objects, chunks and vectors.

No join here forces a physical strategy: Spark broadcasts a side only while its
size is under the session threshold, and adaptive execution splits a partition
that one key makes too large.  Sides that are looked up are narrow and hold each
key once (see :func:`unique_keys`).
"""

import pandas as pd
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.operators.events import STAGE_DOWNLOAD
from sheafline.session import stored

# Files returned to Spark at a time, which bounds the memory of a task.
FILES_PER_BATCH = 16


def unique_keys(rows, keys):
    """Each key once, as the lookup side of a join.

    Adaptive execution splits a skewed partition only when both sides of the join
    are plain shuffles.  A deduplicated side normally is not one: it is already
    partitioned by its keys, and the join takes it as it is.  Deduplicating under
    a hash of the keys as well leaves that partitioning open, so the join adds a
    shuffle of its own, of unique and narrow rows.
    """
    marked = rows.select(*keys, F.xxhash64(*keys).alias("__hash"))
    return marked.distinct().drop("__hash")


def fetch_objects(events, objects, path="s3_path"):
    """(found, missing): events with their object, and events without one.

    The inner join lets either side be the small one; its sides are plain
    shuffles, so adaptive execution splits an object with most of the events.
    Missing events are found against the listing alone, so no content is read or
    moved for them.
    """
    found = events.join(objects.withColumnRenamed("path", path), path)
    return found, missing_objects(events, objects, path).withColumn("stage", F.lit(STAGE_DOWNLOAD))


def read_by_path(events, root, file_system=None, path="s3_path"):
    """Events with the file each one names, read by the task: ``content``, or ``error`` and ``stage``.

    The counterpart of :func:`fetch_objects` for stores too large to list or
    shuffle: only events move, and each task opens the files of its own events.
    Files found and files missing are rows of one result, so that both come from one
    pass: write it once, or hand it to :func:`extraction.extract_events`.
    ``file_system()`` returns a PyArrow file system and the root inside it.
    """

    def default_file_system():
        return FileSystem.from_uri(root) if "://" in root else (LocalFileSystem(), root)

    def read(frames):
        store, base = (file_system or default_file_system)()
        for frame in frames:
            for start in range(0, len(frame), FILES_PER_BATCH):
                part = frame.iloc[start : start + FILES_PER_BATCH]
                results = [_read_file(store, base, p) for p in part[path]]
                yield part.assign(
                    content=pd.Series([c for c, _ in results], index=part.index, dtype=object),
                    error=pd.Series([e for _, e in results], index=part.index, dtype=object),
                )

    schema = T.StructType(
        events.schema.fields
        + [T.StructField("content", T.BinaryType()), T.StructField("error", T.StringType())]
    )
    fetched = events.mapInPandas(read, schema)
    return fetched.withColumn("stage", F.when(F.col("error").isNotNull(), F.lit(STAGE_DOWNLOAD)))


def _read_file(store, base, path):
    try:
        with store.open_input_stream(f"{base.rstrip('/')}/{path}") as file:
            return file.read(), None
    except Exception as error:
        return None, f"{type(error).__name__}: {error}"


def existing_objects(events, listing, path="s3_path"):
    return _against_listing(events, listing, path, "left_semi")


def missing_objects(events, listing, path="s3_path"):
    return _against_listing(events, listing, path, "left_anti")


def _against_listing(events, listing, path, how):
    paths = listing.select(F.col("path").alias(path))
    return events.join(unique_keys(paths, [path]), path, how)


def windowed_flow_gap(consumed, produced, width, ts="ts"):
    """Consumed against produced messages per window.

    Both sides are counted by one grouping over their union: same result as a
    full outer join of two counts, with one shuffle instead of three.
    """
    sides = consumed.select(F.col(ts).alias("ts"), F.lit(1).alias("c"), F.lit(0).alias("p")).unionByName(
        produced.select(F.col(ts).alias("ts"), F.lit(0).alias("c"), F.lit(1).alias("p"))
    )
    return (
        sides.groupBy(F.window("ts", width).alias("w"))
        .agg(F.sum("c").alias("consumed"), F.sum("p").alias("produced"))
        .select(
            F.col("w.start").alias("window_start"),
            "consumed",
            "produced",
            (F.col("consumed") - F.col("produced")).alias("gap"),
        )
    )


def reconcile_status(documents, objects, chunks, vectors):
    """Per document: stored chunks, object flag and indexed vectors.

    documents(company_id, document_id, s3_path), objects(path), chunks and
    vectors(company_id, document_id, chunk_id).  Counts are reduced to one row
    per document before they are joined; duplicates of a vector count once.
    """
    key = ["company_id", "document_id"]
    stored = chunks.groupBy(*key).agg(F.count(F.lit(1)).alias("chunk_count"))
    indexed = vectors.groupBy(*key).agg(F.countDistinct("chunk_id").alias("vector_count"))
    paths = unique_keys(objects.select(F.col("path").alias("s3_path")), ["s3_path"])
    listing = paths.withColumn("object_exists", F.lit(True))
    counted = documents.join(stored, key, "left").join(indexed, key, "left")
    joined = counted.join(listing, "s3_path", "left")
    return joined.select(
        *key,
        F.coalesce("chunk_count", F.lit(0)).alias("chunk_count"),
        F.coalesce("object_exists", F.lit(False)).alias("object_exists"),
        F.coalesce("vector_count", F.lit(0)).alias("vector_count"),
        (F.coalesce("chunk_count", F.lit(0)) == F.coalesce("vector_count", F.lit(0))).alias("in_sync"),
    )


def flag_duplicates(uploads, existing, arrival=None):
    """Add ``accepted`` to uploads (document_id, company_id, filename).

    An upload is refused when a document of the same name exists in any state
    but ``error``.  The lookup side holds each name once, so no row multiplies.
    With ``arrival``, a column that orders the batch, later uploads of a name are
    refused as well, as if each had been checked when it arrived: by arrival, those
    without one last, then by document.  For that every upload gets a number, under which
    the rows are stored; the first of each name is found by aggregation, one row per task
    and name, and joined back by that number alone, so a name with most of the rows does
    no harm.  A document sent twice is two uploads.  Uploads without tenant or name match
    nothing.
    """
    key, columns = ["company_id", "filename"], uploads.columns
    taken = unique_keys(existing.filter(F.col("status") != "error"), key)
    if arrival is not None:
        uploads = stored(uploads.withColumn("__upload", F.monotonically_increasing_id()), "uploads")
    flagged = uploads.join(taken.withColumn("__taken", F.lit(True)), key, "left")
    accepted = F.col("__taken").isNull()
    if arrival is not None:
        named = F.col("company_id").isNotNull() & F.col("filename").isNotNull()
        order = F.struct(F.col(arrival).isNull(), F.col(arrival), F.col("document_id"), F.col("__upload"))
        first = uploads.filter(named).groupBy(*key).agg(F.min_by("__upload", order).alias("__upload"))
        firsts = first.select("__upload", F.lit(True).alias("__first"))
        flagged = flagged.join(firsts, "__upload", "left")
        accepted = accepted & (F.col("__first").isNotNull() | ~named)
    return flagged.select(*columns, accepted.alias("accepted"))


def guard_duplicates(uploads, existing, arrival=None):
    """(accepted, rejected) uploads."""
    flagged = flag_duplicates(uploads, existing, arrival)
    return (
        flagged.filter("accepted").drop("accepted"),
        flagged.filter("NOT accepted").drop("accepted"),
    )
