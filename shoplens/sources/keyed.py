"""Key -> JSON document tables and ranked index tables, written by the executors."""

from pyspark.sql import functions as F

from shoplens.operators.ordered import numbered

WITH_NULLS = {"ignoreNullFields": "false"}


def documents(df, prefix, key):
    """(key, value): '<prefix>:<id>' and the whole row as JSON."""
    return df.select(F.concat(F.lit(f"{prefix}:"), F.col(key).cast("string")).alias("key"),
                     F.to_json(F.struct(*df.columns), WITH_NULLS).alias("value"))


def write_documents(docs, path=None, writer=None):
    """To parquet, or through ``writer(iterator of rows)`` run once per partition on the executors."""
    if writer is not None:
        docs.foreachPartition(writer)
    if path is not None:
        docs.write.mode("overwrite").parquet(path)


def get(docs, keys, schema):
    """The decoded documents of the wanted keys; keys without a document are left out."""
    return docs.join(keys, "key", "left_semi").select("key", F.from_json("value", schema).alias("doc")) \
        .select("key", "doc.*")


def recommendation_documents(routed):
    """recommendations:<user> -> [{item_id, score, source}], scores with six digits."""
    entries = F.transform("recommendations", lambda r: F.struct(
        r["item_id"].alias("item_id"), F.round(r["rating"].cast("double"), 6).alias("score"),
        F.col("source").alias("source")))
    return routed.select(F.concat(F.lit("recommendations:"), F.col("user_id").cast("string")).alias("key"),
                         F.to_json(entries, WITH_NULLS).alias("value"), "source")


def ranked_indexes(items):
    """(index_name, rank, item_id, score): the whole catalog, and each root category.

    Equal scores go by member text descending, as in a sorted set read from the top. The
    catalog-wide index is one group of everything, hence places from range partitions.
    """
    scored = items.select("item_id", F.coalesce("popularity_score", F.lit(0.0)).alias("score"), "root")
    both = scored.select(F.explode(F.array(F.lit("catalog:popular"), F.concat(F.lit("catalog:category:"), "root")))
                         .alias("index_name"), "item_id", "score")
    return numbered(both, [F.desc("score"), F.desc(F.col("item_id").cast("string"))], "index_name")


def top_of_index(indexes, name, start, count):
    return indexes.where((F.col("index_name") == name) & F.col("rank").between(start + 1, start + count))
