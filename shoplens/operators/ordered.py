"""Places in a total order without one task for all rows or for one group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens.session import parallelism
from shoplens.sources.lake import written

_SHIFT = 33  # monotonically_increasing_id: the partition above, the place in it below


def numbered(df, order, group=(), name="rank", partitions=None):
    """Adds ``name``: each row's place (long, from 1) in ``order`` among the rows of its ``group`` columns.

    The rows are range-partitioned on group and order and written once with their place in their partition. A
    group's rows lie in consecutive partitions, so a place is the number of the group's rows in earlier partitions
    (a prefix sum over a counting table with one row per group and partition) plus the place among the group's rows
    of the same partition. No window holds a group: with equal scores everywhere the rows still spread by the rest
    of the order, which should be total; rows that are equal in all of it are placed as they come. Nulls are a
    group of their own. An empty table stays empty.
    """
    group = [group] if isinstance(group, str) else list(group)
    spread = [*group, *order]
    partitions = partitions or parallelism(df.sparkSession)
    placed = written(df.repartitionByRange(partitions, *spread).sortWithinPartitions(*spread)
                     .withColumn("_at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_part", F.shiftright("_at", _SHIFT))
    counts = placed.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    # one row per partition that a group has rows in
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_part").alias("_p"), "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return placed.join(starts, same).withColumn(name, F.col("_at") - F.col("_first") + F.col("_before") + 1) \
        .select(*df.columns, name)
