"""Categories that the same shoppers engage with."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens import config
from shoplens.operators.ranking import top_k


def user_categories(weighted):
    return weighted.where(F.col("category_code").isNotNull() & (F.col("event_weight") > 0)) \
        .select("user_id", "category_code").distinct()


def shared_users(user_cats, min_users=config.MIN_SHARED_USERS, block=config.PAIR_BLOCK):
    """(category_a < category_b, users) with at least min_users users in common.

    A category with fewer users than that cannot be in any such pair and is dropped first.
    A user's categories are cut into blocks; pairs inside a block come from its own row,
    pairs across blocks from one row per pair of blocks, spread over all tasks. A user with
    thousands of categories is thus shared out, and the usual user is a single row. Counts
    are added up before they are shuffled.
    """
    frequent = user_cats.groupBy("category_code").agg(F.count("*").alias("n")).where(F.col("n") >= min_users)
    useful = user_cats.join(frequent.select("category_code"), "category_code", "left_semi")
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("category_code"))
    blocks = useful.withColumn("block", F.floor((place - 1) / block).cast("int")) \
        .groupBy("user_id", "block").agg(F.sort_array(F.collect_list("category_code")).alias("cats"))
    inside = blocks.select("cats", F.posexplode("cats").alias("p", "category_a")).select(
        "category_a", F.explode(F.slice("cats", F.col("p") + 2, F.size("cats"))).alias("category_b"))
    wide = blocks.where(F.col("block") > 0).select("user_id").distinct()
    of_wide = blocks.join(wide, "user_id", "left_semi")
    later = of_wide.select("user_id", F.col("block").alias("later_block"), F.col("cats").alias("later_cats"))
    across = of_wide.join(later, "user_id").where(F.col("block") < F.col("later_block")) \
        .repartition("user_id", "block", "later_block") \
        .select("later_cats", F.explode("cats").alias("category_a")) \
        .select("category_a", F.explode("later_cats").alias("category_b"))
    return inside.unionByName(across).groupBy("category_a", "category_b") \
        .agg(F.count("*").alias("users")).where(F.col("users") >= min_users)


def category_complements(weighted, k=config.COMPLEMENTS, min_users=config.MIN_SHARED_USERS,
                         block=config.PAIR_BLOCK):
    """(category, rank, other, score, users): shared users, scaled by size and shrunk when few."""
    user_cats = user_categories(weighted)
    sizes = user_cats.groupBy("category_code").agg(F.count("*").alias("n"))
    pairs = shared_users(user_cats, min_users, block) \
        .join(sizes.toDF("category_a", "n_a"), "category_a").join(sizes.toDF("category_b", "n_b"), "category_b")
    score = F.col("users") / F.sqrt(F.col("n_a") * F.col("n_b")) \
        * F.col("users") / (F.col("users") + config.COMPLEMENT_SHRINKAGE)
    mirrored = F.explode(F.array(F.struct(F.col("category_a").alias("category"), F.col("category_b").alias("other")),
                                 F.struct(F.col("category_b").alias("category"), F.col("category_a").alias("other"))))
    scored = pairs.select(mirrored.alias("d"), F.round(score, config.SCORE_DIGITS).alias("score"), "users") \
        .select("d.category", "d.other", "score", "users")
    return top_k(scored, "category", [F.desc("score"), "other"], k) \
        .select("category", "rank", "other", F.round("score", 4).alias("score"), "users")
