"""Session features that follow the stream: profile and shares of each user that moved."""

from pyspark.sql import functions as F

from shoplens.operators.rerank.context import session_docs, session_rows
from shoplens.streaming.sessions import latest_version, write_changes


def feature_batch(items, hot_items, path):
    """foreachBatch function: features of the users that changed, with their session version.

    The changes are written before they are used twice, so the stateful step runs once per
    batch; the batch id is part of both paths, so a batch that is run again replaces its rows.
    """
    def write(changes, batch_id):
        write_changes(f"{path}/changes")(changes, batch_id)
        stored = changes.sparkSession.read.schema(changes.schema).parquet(f"{path}/changes/batch={batch_id}")
        docs = session_docs(session_rows(latest_version(stored), items, hot_items))
        moved = stored.groupBy("user_id").agg(F.max("version").alias("version"))
        moved.join(docs, "user_id", "left").write.mode("overwrite").parquet(f"{path}/features/batch={batch_id}")
    return write


def latest_features(spark, path):
    """The newest features of every user over all batches; null features after a session ended."""
    stored = spark.read.parquet(f"{path}/features")
    newest = stored.groupBy("user_id").agg(F.max("version").alias("version"))
    return stored.join(newest, ["user_id", "version"], "left_semi")
