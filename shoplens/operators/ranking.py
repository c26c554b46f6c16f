"""Top-k and ordered lists (places in a whole order: see ordered)."""

from pyspark.sql import Window
from pyspark.sql import functions as F


def top_k(df, keys, order, k, rank="rank"):
    """First k rows of each key. Spark trims every key to k before the shuffle as well."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def ranked_list(df, key, fields, out, rank="rank"):
    """One row per key with its (already cut) rows as an array of structs in rank order."""
    entry = F.struct(rank, F.struct(*fields).alias("entry"))
    ordered = F.transform(F.sort_array(F.collect_list(entry)), lambda r: r["entry"])
    return df.groupBy(key).agg(ordered.alias(out))


def head_list(df, order, n, field):
    """The first n values of ``field`` as a one-value subquery (n is a fixed, small number)."""
    rows = df.orderBy(*order).limit(n)
    numbered = rows.withColumn("_rn", F.row_number().over(Window.orderBy(*order)))
    packed = F.transform(F.sort_array(F.collect_list(F.struct("_rn", F.col(field).alias("_v")))), lambda r: r["_v"])
    return numbered.agg(packed.alias("head")).scalar()
