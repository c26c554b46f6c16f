import random

from event_tables import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens.operators.ordered import numbered


def test_equals_a_window(spark):
    rng = random.Random(1)
    data = [(rng.choice([None, "a", "b", "c"]), rng.choice([0.5, 0.5, 0.5, rng.random(), None]), i) for i in range(700)]
    df = spark.createDataFrame(data, "g string, s double, i int")
    order = [F.desc("s"), F.col("i")]
    plain = df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("long"))
    assert rows(numbered(df, order, "g", partitions=9), "i") == rows(plain, "i")
    plain = df.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))
    assert rows(numbered(df, order, partitions=9), "i") == rows(plain, "i")
    assert numbered(df.where("false"), order, "g").count() == 0


def test_equal_scores_spread_over_tasks(spark):
    df = spark.range(20000).select(F.lit("x").alias("g"), F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("s"), "id")
    ranked = numbered(df, [F.desc("s"), F.col("id")], "g", partitions=10)
    written = spark.read.parquet(*sorted({f.rsplit("/", 1)[0] for f in ranked.inputFiles()}))
    sizes = written.groupBy(F.shiftright("_at", 33)).count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) < 4000
    assert sorted(r.rank for r in ranked.select("rank").collect()) == list(range(1, 20001))
