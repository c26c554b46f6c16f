"""Experiment assignments and the log of what users did with recommendations."""

from pyspark.sql import functions as F

from shoplens import config
from shoplens.functions.experiments import variant
from shoplens.operators.evaluation import stored_rows


def assignments(users):
    return users.select(F.col("user_id").cast("string").alias("user_id")).distinct() \
        .select("user_id", variant(F.col("user_id")).alias("variant"))


def check_events(events):
    """Adds ``valid``: both ids present, a known variant and a known event type."""
    ok = F.col("user_id").isNotNull() & F.col("item_id").isNotNull() \
        & F.col("variant").isin(*config.VARIANTS) & F.col("event_type").isin(*config.EXPERIMENT_EVENTS)
    return events.withColumn("valid", F.coalesce(ok, F.lit(False)))


def append_events(events, path):
    """Appends the valid rows with an id and the time of writing."""
    rows = check_events(events).where("valid").drop("valid")
    if "event_id" not in rows.columns:
        rows = rows.withColumn("event_id", F.expr("uuid()"))
    if "event_timestamp" not in rows.columns:
        rows = rows.withColumn("event_timestamp", F.current_timestamp())
    rows.write.mode("append").parquet(path)


def append_assignments(users, path):
    """Appends users who have no assignment yet; the others keep theirs and its time."""
    stored = stored_rows(users.sparkSession, path, "user_id string, variant string, assigned_at timestamp")
    assignments(users).join(stored.select("user_id"), "user_id", "left_anti") \
        .withColumn("assigned_at", F.current_timestamp()).write.mode("append").parquet(path)
