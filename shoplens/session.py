"""Session settings the jobs rely on."""

import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(app_name, master=None, **conf):
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark):
    """Calendar days, hours and partition paths are UTC whatever session we are handed."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark):
    """The cluster's shared folder. Without one only a session in a single process (tests) gets a local folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    fallback = getattr(spark, "_shoplens_dir", None)
    if fallback is None:
        fallback = spark._shoplens_dir = tempfile.mkdtemp(prefix="shoplens-")
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(f"{fallback}/checkpoint")
    return fallback


FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark):
    """For a frame that is written once: Spark deletes the shuffles of a write as it ends. Otherwise they stay on the
    executors' disks until the driver's garbage collection comes upon the plan, and those of several jobs pile up."""
    before = spark.conf.get(FREES_SHUFFLES, "false")
    spark.conf.set(FREES_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREES_SHUFFLES, before)


def parallelism(spark):
    """Partitions for a stage whose rows multiply, so its input size says little about its work."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
