"""User-item interactions and item features from weighted, decayed events."""

from pyspark.sql import functions as F

from shoplens import config
from shoplens.functions import events as E
from shoplens.operators.ranking import top_k


def weigh(events):
    return events.withColumn("event_weight", E.event_weight())


def decay(weighted):
    """Decays to the newest event of the data, read by a one-value subquery (no driver trip)."""
    newest = weighted.agg(F.max("timestamp")).scalar()
    return weighted.withColumn("decay_factor", E.decay_factor(newest)) \
        .withColumn("weighted_score", F.col("event_weight") * F.col("decay_factor"))


def interaction_matrix(decayed):
    """One row per pair. Pairs with score 0 (only removals) stay: they count as seen."""
    return decayed.groupBy(F.col("user_id").cast("int").alias("user_id"), F.col("item_id").cast("int").alias("item_id")) \
        .agg(F.sum("weighted_score").alias("interaction_score"))


def matrix_of(events):
    return interaction_matrix(decay(weigh(events)))


def item_features(weighted):
    """Undecayed popularity, and (purchases + carts) per view."""
    stats = weighted.groupBy("item_id").agg(
        F.sum("event_weight").alias("popularity_score"),
        E.count_type("view").alias("views"),
        F.count_if(F.col("event_type").isin("purchase", "cart")).alias("converted"))
    rate = F.when(F.col("views") > 0, F.col("converted") / F.col("views")).otherwise(0.0)
    return stats.select("item_id", F.col("popularity_score").cast("double").alias("popularity_score"),
                        rate.alias("conversion_rate"))


def decayed_popularity(matrix):
    return matrix.groupBy("item_id").agg(F.sum("interaction_score").alias("popularity_score"))


def top_pairs(matrix, k=config.TOP_N):
    """Strongest k items of every user."""
    scored = matrix.withColumn("interaction_score", F.round("interaction_score", config.SCORE_DIGITS))
    return top_k(scored, "user_id", [F.desc("interaction_score"), "item_id"], k)


def user_counts(events):
    return events.groupBy("user_id").agg(F.count("*").alias("n_events"))


def user_segments(events):
    return user_counts(events).withColumn("segment", E.segment())


def cold_users(events):
    return user_counts(events).where(F.col("n_events") <= config.COLD_START_MAX_EVENTS).select("user_id")


def split_pairs(matrix, percent=config.TRAIN_PERCENT):
    """(train, test) by a hash of the pair, so a pair falls on the same side in every run."""
    pair = F.concat_ws("|", F.col("user_id").cast("string"), F.col("item_id").cast("string"))
    side = E.hash_percent(pair, F.md5)
    return matrix.where(side < percent), matrix.where(side >= percent)
