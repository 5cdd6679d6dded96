"""Stored files as rows."""

from pyspark.sql import functions as F

from sheafline.functions import mime
from sheafline.operators.events import STAGE_DOWNLOAD
from sheafline.session import file_system


def read_objects(spark, root, pattern=None):
    """Files below ``root`` as (path relative to root, length, content).

    Content is only read when a query selects it.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).withColumn("path", relative_path(F.col("path"), qualified(spark, root)))


def qualified(spark, root):
    """``root`` as the file system spells it in the paths it lists."""
    system, path = file_system(spark, root)
    return system.makeQualified(path).toString()


def split_by_length(objects, max_bytes):
    """(files to read, dead letters): files above ``max_bytes`` keep path, length and a reason.

    The filter on the length reaches the file listing, so an oversize file is not opened.
    """
    fits = F.col("length") <= max_bytes
    reason = F.concat(F.lit("file of "), "length", F.lit(f" bytes is above the limit of {max_bytes}"))
    oversize = objects.filter(~fits).select(
        *[c for c in objects.columns if c != "content"], reason.alias("error"), F.lit(STAGE_DOWNLOAD).alias("stage")
    )
    return objects.filter(fits), oversize


def list_objects(spark, root):
    """Listing only: no file is opened."""
    return read_objects(spark, root).select("path", "length", "modificationTime")


def relative_path(path, root):
    """Part of a listed path below ``root``, which is spelled as in the list (:func:`qualified`).

    The path is cut by length and stays as it is: it is no URL, so a ``%`` or ``+`` in a
    name means itself.  A path outside ``root`` is kept whole.
    """
    below = root.rstrip("/") + "/"
    cut = F.substring(path, F.lit(len(below) + 1), F.char_length(path))
    return F.when(F.startswith(path, F.lit(below)), cut).otherwise(path)


def with_guessed_type(objects):
    return objects.withColumn("content_type", mime.guess_type(F.col("path")))
