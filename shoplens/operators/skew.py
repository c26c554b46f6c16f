"""Joins that stay even when one key holds a large share of the rows."""

from pyspark.sql import functions as F

from shoplens import config


def heavy_keys(counts, key, count, share=config.HEAVY_SHARE, total=None):
    """Keys that hold more than ``share`` of all rows: fewer than 1 / share of them, always.

    ``total``: the number of all rows as a one-value subquery, where that takes less than adding up the counts."""
    total = counts.agg(F.sum(count)).scalar() if total is None else total
    return counts.where(F.col(count) > total * F.lit(share)).select(key)


def salted_join(big, small, key, heavy, how="inner", salts=config.SALTS, by=None):
    """``big`` joined to ``small`` on ``key`` with the rows of heavy keys dealt out over ``salts`` tasks.

    Only the few heavy keys' rows of ``small`` are repeated. The salt is a hash of the row (of
    its columns ``by``), so a task that is run again deals the same way; rows without a key are
    dealt out as well.
    """
    marks = F.broadcast(heavy.select(key, F.lit(True).alias("_heavy")))
    spread = F.pmod(F.xxhash64(*(by or big.columns)), F.lit(salts)).cast("int")
    left = big.join(marks, key, "left") \
        .withColumn("_salt", F.when(F.col("_heavy").isNotNull() | F.col(key).isNull(), spread).otherwise(0)).drop("_heavy")
    copies = F.when(F.col("_heavy").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = small.join(marks, key, "left").withColumn("_salt", F.explode(copies)).drop("_heavy")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def split_join(big, small, key, heavy, how="inner", hot=None):
    """``big`` joined to ``small`` on ``key`` without sending a heavy key to one task.

    Rows of heavy keys meet a broadcast of just those keys' rows of ``small`` and never
    move; every other row takes the ordinary shuffled join. Rows without a key, which an
    outer join would otherwise pile up in one partition, stay with the first group.
    ``heavy`` is bounded by its caller (see heavy_keys), and so is its part of ``small``, which may be given
    as ``hot`` where ``small`` is a plan of its own that need not run twice.
    """
    marked = big.join(F.broadcast(heavy.select(key, F.lit(True).alias("_heavy"))), key, "left")
    stays = F.col("_heavy").isNotNull() | F.col(key).isNull()
    few = small.join(F.broadcast(heavy), key, "left_semi") if hot is None else hot
    met = marked.where(stays).drop("_heavy").join(F.broadcast(few), key, how)
    rest = marked.where(~stays).drop("_heavy").join(small, key, how)
    return met.unionByName(rest)
