"""The date-partitioned parquet lake and the overwrite sinks."""

import uuid

from pyspark.sql import functions as F

from shoplens.schema import EVENT_FIELDS, LAKE, PARTITIONS
from shoplens.session import shared_dir, shuffles_freed


BATCH = "batch"  # innermost folder of what a stream writes


def with_partitions(df, timestamp="timestamp"):
    """Zero-padded year, month and day; a time that does not parse falls on today."""
    when = F.coalesce(F.try_to_timestamp(F.col(timestamp).cast("string")), F.current_timestamp())
    return df.withColumns({p: F.date_format(when, f) for p, f in zip(PARTITIONS, ("yyyy", "MM", "dd"))})


def partition_path(timestamp="timestamp"):
    when = F.coalesce(F.try_to_timestamp(F.col(timestamp).cast("string")), F.current_timestamp())
    return F.date_format(when, "'year='yyyy'/month='MM'/day='dd")


def write(events, path, mode="append"):
    """Rebalanced by day: few files per day, and a day too big for one task is split."""
    with_partitions(events).hint("rebalance", *PARTITIONS) \
        .write.mode(mode).partitionBy(*PARTITIONS).parquet(path)


def read(spark, path, days=None):
    """Reads from the root, so a filter on the partition columns prunes directories."""
    lake = spark.read.schema(LAKE).parquet(path).select(*EVENT_FIELDS, *PARTITIONS)
    return lake if days is None else lake.where(F.make_date("year", "month", "day").between(*days))


def events(lake):
    return lake.select(*EVENT_FIELDS)


def overwrite(df, path):
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_path(spark, name):
    """A new folder in the cluster's shared folder."""
    return f"{shared_dir(spark)}/shoplens/{spark.sparkContext.applicationId}/{name}/{uuid.uuid4().hex}"


def written(df, name):
    """Writes a frame to a folder of its own and reads it back: what is still read is never overwritten."""
    return overwrite(df, fresh_path(df.sparkSession, name))
