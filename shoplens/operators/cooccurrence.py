"""Items engaged with in the same session."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens import config
from shoplens.operators.ranking import top_k

SESSION_BLOCK = 64


def engaged_items(weighted):
    """(session_id, item_id, w): what a session engaged with, by its strongest event."""
    return weighted.groupBy("session_id", "item_id").agg(F.max("event_weight").alias("w")).where(F.col("w") > 0)


def eligible_session_items(weighted, max_items=None):
    """(session_id, item_id, w, n) of sessions with two and more engaged items, n their number.

    With ``max_items`` longer sessions are left out whole (``left_out`` counts them); each session is then trimmed to
    max_items + 1 rows before the shuffle, which is enough to tell that it is too long.
    """
    engaged = engaged_items(weighted)
    if max_items is None:
        sizes = engaged.groupBy("session_id").agg(F.count("*").alias("n")).where(F.col("n") > 1)
        return engaged.join(sizes, "session_id")
    trimmed = top_k(engaged, "session_id", ["item_id"], max_items + 1, "_rn").drop("_rn")
    size = F.count("*").over(Window.partitionBy("session_id"))
    return trimmed.withColumn("n", size).where(F.col("n").between(2, max_items))


def left_out(weighted, max_items=config.MAX_SESSION_ITEMS):
    """One row: the sessions that a cut at ``max_items`` leaves out, their items and their pairs."""
    sizes = engaged_items(weighted).groupBy("session_id").agg(F.count("*").alias("n")).where(F.col("n") > max_items)
    total = lambda value: F.coalesce(F.sum(value), F.lit(0)).cast("bigint")
    return sizes.agg(F.count("*").alias("sessions"), total(F.col("n")).alias("items"),
                     total(F.expr("n * (n - 1) div 2")).alias("pairs"))


def session_pairs(session_items, block=SESSION_BLOCK):
    """(item_a < item_b, w): each pair of a session once, w = the weaker of the two.

    A session of up to ``block`` items is one row and makes its pairs in place. A longer one is dealt to blocks of about
    that many items by hash, and each pair of its blocks is a row of its own with two short lists: so the pairs of a giant
    session, which no plan can avoid, come from many tasks, and no list grows with it.
    """
    entry = F.struct("item_id", "w")
    light = session_items.where(F.col("n") <= block).groupBy("session_id").agg(F.collect_list(entry).alias("left")) \
        .select("left", F.col("left").alias("right"))
    heavy = session_items.where(F.col("n") > block).withColumn("blocks", F.ceil(F.col("n") / block).cast("int")) \
        .withColumn("own", F.pmod(F.xxhash64("item_id"), F.col("blocks")).cast("int"))
    dealt = heavy.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "session_id", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", entry.alias("e"))
    in_block = lambda which: F.collect_list(F.when(F.col("own") == F.col(which), F.col("e")))
    parts = dealt.groupBy("session_id", "low", "high").agg(in_block("low").alias("left"), in_block("high").alias("right"))
    ordered = lambda own: F.filter(own, lambda e: e["item_id"] > F.col("a.item_id"))
    same = F.col("low") == F.col("high")
    # between two blocks every pair counts, smaller item first; inside one, the later items
    between = parts.where(~same).select(F.explode("left").alias("a"), "right").select("a", F.explode("right").alias("b"))
    inside = light.unionByName(parts.where(same).select("left", "right")).select(F.explode("left").alias("a"), "right") \
        .select("a", F.explode(ordered("right")).alias("b"))
    return inside.unionByName(between).select(
        F.least("a.item_id", "b.item_id").alias("item_a"), F.greatest("a.item_id", "b.item_id").alias("item_b"),
        F.least("a.w", "b.w").alias("w"))


def scored_pairs(weighted, max_items=None):
    """Both directions of every pair with its cosine-style score and session count."""
    items = eligible_session_items(weighted, max_items)
    totals = items.groupBy("item_id").agg(F.sum("w").alias("total"))
    together = session_pairs(items).groupBy("item_a", "item_b").agg(
        F.sum("w").alias("w"), F.count("*").alias("sessions"))
    # null-safe, so that no filter on ids reaches the sessions below and their shuffles serve the totals as well
    side = lambda x: totals.select(F.col("item_id").alias(f"_{x}"), F.col("total").alias(f"total_{x}"))
    met = lambda x: F.col(f"item_{x}").eqNullSafe(F.col(f"_{x}"))
    both = together.where(F.col("item_a").isNotNull() & F.col("item_b").isNotNull()).join(side("a"), met("a")).join(side("b"), met("b"))
    score = F.round(F.col("w") / F.sqrt(F.col("total_a") * F.col("total_b")), config.SCORE_DIGITS)
    mirrored = F.explode(F.array(F.struct(F.col("item_a").alias("item_id"), F.col("item_b").alias("other_id")),
                                 F.struct(F.col("item_b").alias("item_id"), F.col("item_a").alias("other_id"))))
    return both.select(mirrored.alias("d"), score.alias("score"), "sessions") \
        .select("d.item_id", "d.other_id", "score", "sessions")


def bought_together(weighted, k=config.NEIGHBOURS, max_items=None):
    """(item_id, rank, other_id, score, sessions): the k strongest partners of each item, from all sessions or short ones."""
    ranked = top_k(scored_pairs(weighted, max_items), "item_id", [F.desc("score"), "other_id"], k)
    return ranked.select("item_id", "rank", "other_id", F.round("score", 4).alias("score"), "sessions")
