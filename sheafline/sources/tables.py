"""Parquet tables of a data folder."""

from pyspark.sql import functions as F

from sheafline.session import prepare


def read_table(spark, folder, name):
    """One table; naive timestamps are taken as UTC instants."""
    df = prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    naive = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df


# Number of partitions the text-heavy queries deal their input to.  Unset, inputs are
# read as their files are split.
DEAL_SETTING = "spark.sheafline.inputPartitions"


def dealt(df):
    """``df`` in the number of partitions the session's owner asks for, if they do.

    For inputs in too few files or row groups to occupy a cluster; it moves all rows, so
    it is a choice of the caller and never depends on the size of the input.
    """
    partitions = df.sparkSession.conf.get(DEAL_SETTING, None)
    return df.repartition(int(partitions)) if partitions else df
