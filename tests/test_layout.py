"""Where intermediate rows stay: disks are freed between writes, parts are written one by one, lookups compare numbers."""

import time

import pytest
from event_tables import rows
from pyspark.sql import functions as F

from shoplens.functions import vectors as V
from shoplens.llm.common import staged
from shoplens.operators import catalog, interactions as I, items as IT, profiles
from shoplens.operators.rerank.factors import candidate_items
from shoplens.session import FREES_SHUFFLES
from shoplens.sources.lake import written

EVENT = ("timestamp string, event_type string, item_id int, category_id bigint, category_code string, brand string, "
         "price double, user_id int, session_id string")


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles().iterator()
    found = set()
    while files.hasNext():
        name = files.next().getName()
        if name.startswith("shuffle_"):
            found.add(name)
    return found


@pytest.mark.parametrize("write", [written, staged])
def test_a_write_leaves_no_shuffle_behind(spark, write):
    before = shuffle_files(spark)
    setting = spark.conf.get(FREES_SHUFFLES, "false")
    df = spark.range(5000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    assert sum(r.n for r in write(df, "freed").collect()) == 5000
    assert spark.conf.get(FREES_SHUFFLES, "false") == setting
    until = time.time() + 10  # Spark deletes beside the next job
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left


def shop_events(spark):
    data = []
    for i in range(60):
        user = None if i % 13 == 0 else i % 7
        item = i % 9
        data.append((f"2019-10-{1 + i % 28:02d} 10:00:00", ("view", "cart", "purchase")[i % 3], item, 100 + item % 2,
                     None if item == 4 else f"home.light.lamp{item % 3}", None if item == 5 else f"b{item % 4}", 1.0 + item, user, f"s{i % 11}"))
    return spark.createDataFrame(data, EVENT).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def test_parts_of_documents_are_written_one_by_one(spark):
    weighted = I.weigh(shop_events(spark)).localCheckpoint()
    matrix = I.interaction_matrix(I.decay(weighted)).localCheckpoint()
    tfidf = IT.item_tfidf(weighted).localCheckpoint()
    names = []

    def stage(df, name):
        names.append(name)
        return written(df, name)

    users = profiles.user_docs(weighted, matrix, tfidf, stage=stage)
    items = catalog.item_docs(weighted, matrix, tfidf, stage=stage)
    assert names == ["user_stats", "user_recent", "user_categories", "user_brands", "user_seen", "user_profile",
                     "item_described", "item_also"]
    text = lambda docs, key: [r.asDict(recursive=True) for r in docs.orderBy(key).collect()]
    assert text(users, "user_id") == text(profiles.user_docs(weighted, matrix, tfidf), "user_id")
    assert text(items, "item_id") == text(catalog.item_docs(weighted, matrix, tfidf), "item_id")
    by_user = {r.user_id: r for r in users.collect()}
    assert set(by_user) == {None, *range(7)}  # rows without a user have a document as well
    events = weighted.collect()
    for user, doc in by_user.items():
        own = [r.item_id for r in events if r.user_id == user]
        assert doc.n_events == len(own) and doc.seen == sorted(set(own)) and len(doc.recent) == min(10, len(own)) and doc.profile
    # a user has one row of each part, so nothing is added up before the rows move
    plan = users.select("*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(user_id") == 1


def test_token_lookups_by_hash(spark):
    maps = [({"a": 0.5, "b": 0.25}, {"b": 2.0, "c": 1.0, "a": 4.0}), ({"é": 1.0}, {"é": 3.0}), ({}, {"a": 1.0}), (None, {"a": 1.0})]
    df = spark.createDataFrame(maps, "a map<string,double>, b map<string,double>")
    hashed = V.map_cosine(V.by_hash(F.col("a")), V.by_hash(F.col("b")), V.map_norm(F.col("a")), V.map_norm(F.col("b")))
    plain = V.map_cosine(F.col("a"), F.col("b"), V.map_norm(F.col("a")), V.map_norm(F.col("b")))
    found = df.select(hashed.alias("h"), plain.alias("p")).collect()
    assert [r.h for r in found] == [r.p for r in found] and found[0].h > 0 and found[1].h == 1.0


def test_candidates_carry_numbers_for_tokens(spark):
    items = spark.createDataFrame([(1, "x", "a.b", 7, 2.0, 1.0, {"cat:a": 1.0}, None)], "item_id int, brand string, category_code string, "
                                  "category_id bigint, price double, popularity_score double, tokens map<string,double>, factors array<double>")
    requests = spark.createDataFrame([("r", 5, [(1, "popular")], [])], "request_id string, user_id int, "
                                     "candidates array<struct<item_id:int,source:string>>, seen array<int>")
    met = candidate_items(requests, items, items.select("item_id"))
    assert dict(met.dtypes)["tokens"] == "map<bigint,double>" and rows(met.select("request_id", "item_id"), "item_id") == [("r", 1)]
