"""Operators on small hand-made tables, against what they should give and against brute force."""

import itertools
import json
import math
import re

import pytest
from event_tables import make_events, rows
from pyspark.sql import functions as F

from shoplens.functions import events as E
from shoplens.functions import text, vectors as V
from shoplens.functions.experiments import variant
from shoplens.operators import (catalog, complements, content, cooccurrence, evaluation, experiments,
                                interactions as I, items as IT, listing, metrics, neighbours, profiles)
from shoplens.operators.ranking import head_list
from shoplens.operators.skew import heavy_keys, salted_join, split_join
from shoplens.sources import contract, keyed, lake


@pytest.fixture(scope="module")
def shop(spark):
    """Conflicting metadata, removals only, no views, nothing but ids, a too long session."""
    long_session = [(m, "view", 100 + m, "bulk.item", "b", 1.0, 50, "bot") for m in range(60)]
    return make_events(spark, [
        (0, "view", 1, "home.lamp", "acme", 10.0, 1, "s1"), (1, "cart", 2, "home.sofa", None, 20.0, 1, "s1"),
        (2, "purchase", 2, "home.sofa", "nord", 30.0, 2, "s2"), (3, "view", 1, None, "zeta", 12.0, 2, "s2"),
        (4, "remove_from_cart", 3, None, None, 5.0, 3, "s3"), (5, "gift", 1, "home.lamp", "acme", 11.0, 4, "s4"),
        (6, "purchase", 1, "home.lamp", "acme", 10.0, 4, "s4"), (60 * 24 * 14, "view", 2, "home.sofa", "nord", 25.0, 1, "s5"),
        *long_session]).cache()


def test_weights_and_decay(spark, shop):
    decayed = I.decay(I.weigh(shop)).where("session_id <> 'bot'")
    got = {(r.user_id, r.item_id, r.event_type): (r.event_weight, r.decay_factor) for r in decayed.collect()}
    assert got[(4, 1, "gift")][0] == 0 and got[(3, 3, "remove_from_cart")][0] == 0
    assert got[(2, 2, "purchase")] == (5, 0.5) and got[(1, 2, "view")] == (1, 1.0)


def test_matrix_keeps_zero_pairs_and_features_stay_undecayed(spark, shop):
    matrix = {(r.user_id, r.item_id): r.interaction_score for r in I.matrix_of(shop).collect()}
    assert matrix[(3, 3)] == 0.0 and matrix[(1, 2)] == pytest.approx(1.5 + 1.0)
    features = {r.item_id: (r.popularity_score, r.conversion_rate) for r in I.item_features(I.weigh(shop)).collect()}
    assert features[1] == (7.0, 0.5) and features[2] == (9.0, 2.0) and features[3] == (0.0, 0.0)


def test_metadata_mixes_events_and_tokens_have_no_repeats(spark, shop):
    basics = IT.item_basics(shop).where("item_id in (1, 3)")
    got = {r.item_id: (r.category_code, r.brand) for r in basics.collect()}
    assert got == {1: ("home.lamp", "zeta"), 3: (None, None)}
    tokens = {r.token for r in IT.token_rows(basics).where("item_id = 1").collect()}
    assert tokens == {"cat:home", "cat:home.lamp", "cid:101", "brand:zeta"}


def test_tfidf_against_a_loop(spark, shop):
    tokens = {}
    for r in IT.token_rows(IT.item_basics(shop)).collect():
        tokens.setdefault(r.item_id, []).append(r.token)
    n = shop.select("item_id").distinct().count()
    df = {}
    for t in itertools.chain.from_iterable(tokens.values()):
        df[t] = df.get(t, 0) + 1
    got = {(r.item_id, r.token): r.weight for r in IT.item_tfidf(shop).collect()}
    for item, own in tokens.items():
        w = {t: math.log((n + 1) / (df[t] + 1)) + 1 for t in own}
        length = math.sqrt(sum(x * x for x in w.values()))
        for t in own:
            assert got[(item, t)] == pytest.approx(w[t] / length)
    assert len(got) == sum(map(len, tokens.values()))


def test_a_cut_of_sessions_is_a_parameter_and_is_counted(spark, shop):
    weighted = I.weigh(shop)
    kept = {r.session_id for r in cooccurrence.eligible_session_items(weighted, 50).collect()}
    assert kept == {"s1", "s2"}
    assert {r.session_id for r in cooccurrence.eligible_session_items(weighted).collect()} == {"s1", "s2", "bot"}
    assert tuple(cooccurrence.left_out(weighted, 50).first()) == (1, 60, 60 * 59 // 2)
    assert tuple(cooccurrence.left_out(weighted, 60).first()) == (0, 0, 0)
    for cut in (50, None):
        pairs = {(r.item_id, r.other_id): (r.score, r.sessions) for r in cooccurrence.scored_pairs(weighted, cut).collect()}
        assert pairs[(1, 2)] == pairs[(2, 1)] == (pytest.approx(2 / math.sqrt(2 * 8), abs=1e-9), 2)
    assert len(pairs) == 2 + 60 * 59


@pytest.mark.parametrize("block", [1, 3, 64, 1000])
def test_pairs_of_long_sessions_do_not_depend_on_the_block(spark, block):
    import random
    rng = random.Random(block)
    sessions = {"long": rng.sample(range(500), 130), "short": [3, 9], "one": [4]}
    data = [(s, i, rng.choice([1, 3, 5]), len(own)) for s, own in sessions.items() for i in own]
    weight = {(s, i): w for s, i, w, _ in data}
    expected = sorted((a, b, min(weight[s, a], weight[s, b])) for s, own in sessions.items() for a, b in itertools.combinations(sorted(own), 2))
    got = cooccurrence.session_pairs(spark.createDataFrame(data, "session_id string, item_id int, w int, n long"), block)
    assert sorted(map(tuple, got.collect())) == expected


@pytest.mark.parametrize("block", [1, 2, 3, 128])
def test_category_pairs_do_not_depend_on_the_block(spark, block):
    import random
    rng = random.Random(3)
    data = [(u, f"c{c}") for u in range(12) for c in rng.sample(range(9), rng.randint(1, 9))]
    expected = {}
    for u in range(12):
        own = sorted(c for x, c in data if x == u)
        for pair in itertools.combinations(own, 2):
            expected[pair] = expected.get(pair, 0) + 1
    expected = {p: n for p, n in expected.items() if n >= 2}
    got = complements.shared_users(spark.createDataFrame(data, "user_id int, category_code string"), 2, block)
    assert {(r.category_a, r.category_b): r.users for r in got.collect()} == expected


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_joins_equal_the_plain_join(spark, how):
    big = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(200)] + [(None, -1)], "k int, v int")
    small = spark.createDataFrame([(i, f"d{i}") for i in range(0, 150)], "k int, d string")
    counts = big.groupBy("k").agg(F.count("*").alias("n"))
    heavy = heavy_keys(counts, "k", "n", 0.1)
    assert [r.k for r in heavy.collect()] == [1]
    plain = rows(big.join(small, "k", how), "v")
    assert rows(split_join(big, small, "k", heavy, how).select("k", "v", "d"), "v") == plain
    assert rows(salted_join(big, small, "k", heavy, how, 5).select("k", "v", "d"), "v") == plain


def test_head_list_keeps_the_order(spark):
    df = spark.createDataFrame([(i, float(i % 4)) for i in range(20)], "i int, s double")
    assert spark.range(1).select(head_list(df, [F.desc("s"), "i"], 4, "i").alias("h")).first().h == [3, 7, 11, 15]


@pytest.mark.parametrize("head", [0, 3, 2000])
def test_baseline_is_exact_for_users_who_have_the_whole_head(spark, head):
    import random
    rng = random.Random(5)
    popularity = [(i, float(rng.randint(0, 9))) for i in range(40)]
    have = [(u, i) for u in range(6) for i in rng.sample(range(40), [0, 2, 10, 25, 38, 40][u])]
    order = sorted(popularity, key=lambda p: (-p[1], p[0]))
    expected = {(u, i): n for u in range(6)
                for n, i in enumerate([i for i, _ in order if (u, i) not in set(have)][:5], 1)}
    got = evaluation.popularity_baseline(
        spark.createDataFrame(popularity, "item_id int, popularity_score double"),
        spark.createDataFrame([(u,) for u in range(6)], "user_id int"),
        spark.createDataFrame([(u, i, 1.0) for u, i in have], "user_id int, item_id int, interaction_score double"), 5, head)
    assert {(r.user_id, r.item_id): r["rank"] for r in got.collect()} == expected


def test_ranking_metrics(spark):
    recs = spark.createDataFrame([(1, 10, 1), (1, 11, 15), (2, 12, 1)], "user_id int, item_id int, rank int")
    truth = spark.createDataFrame([(1, 10), (1, 11), (2, 99), (3, 98)], "user_id int, item_id int")
    got = {r.k: r for r in evaluation.ranking_metrics(recs, truth, F.lit(10)).collect()}
    assert got[10].n_users == 3 and got[10].precision == pytest.approx(0.1 / 3) and got[20].recall == pytest.approx(1 / 3)
    assert got[10].hit_rate == pytest.approx(1 / 3) and got[10].coverage == 0.2 and got[20].coverage == 0.3


def test_content_never_repeats_history_and_caps_brands(spark):
    events = make_events(spark, [(i, "view", i, "home.lamp", "acme" if i < 8 else f"b{i}", 5.0, 100 + i, f"s{i}")
                                 for i in range(12)] + [(50, "view", 0, "home.lamp", "acme", 5.0, 1, "s")])
    recs = content.recommend(I.matrix_of(events).where("user_id = 1"), IT.item_tfidf(events),
                             I.item_features(I.weigh(events)), k=8)
    got = [r.item_id for r in recs.orderBy("rank").collect()]
    assert 0 not in got and len(got) == 8
    assert [i < 8 for i in got] == [True] * 3 + [False] * 4 + [True]


def _executed(df):
    """The plan that was run, with the exchanges that were reused."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_profile_rows_of_usual_users_are_not_summed_before_they_move(spark):
    history = [(u, i, 1.0 + i) for u in range(1500) for i in (u % 5, 5 + u % 3)] + [(9999, i, 2.0) for i in range(8)] * 20 + [(None, 1, 3.0)] * 2
    tfidf = [(i, t, 0.1 * (i + 1)) for i in range(8) for t in (f"a{i % 2}", f"b{i % 4}")]
    got = profiles.token_profiles(spark.createDataFrame(history, "user_id int, item_id int, interaction_score double"),
                                  spark.createDataFrame(tfidf, "item_id int, token string, weight double"))
    want = {}
    for u, i, s in history:
        for j, t, w in tfidf:
            if i == j:
                want.setdefault(u, {})[t] = want.get(u, {}).get(t, 0.0) + s * w
    found = {(r.user_id, r.token): r.profile_weight for r in got.collect()}
    assert len(found) == sum(map(len, want.values()))
    for u, own in want.items():
        norm = math.sqrt(sum(x * x for x in own.values()))
        assert all(found[u, t] == pytest.approx(x / norm) for t, x in own.items())
    moved = _executed(got).split("REPARTITION_BY_NUM")[1]
    assert "Union" in moved.split("HashAggregate")[0]


def test_item_users_are_counted_over_bare_pairs(spark):
    events = make_events(spark, [(0, "view", 1, "a.b", "x", 1.0, 1, "s"), (1, "cart", 1, "a.b", "y", 2.0, 1, "s"), (2, "view", 1, None, "x", 3.0, 2, "t"),
                                 (3, "view", 1, None, None, 3.0, None, "t"), (4, "view", -1, "c.d", "x", 3.0, 7, "t"), (5, "view", 2, None, "x", 3.0, None, "t")]) \
        .withColumn("item_id", F.expr("nullif(item_id, -1)"))
    meta = IT.item_metadata(events)
    assert {r.item_id: (r.brand, r.views, r.carts, r.unique_users) for r in meta.collect()} == {1: ("y", 3, 1, 2), None: ("x", 1, 0, 1), 2: ("x", 1, 0, 0)}
    assert "distinct" not in _executed(meta)


def test_partners_and_totals_share_the_sessions(spark):
    events = make_events(spark, [(i, "view", i % 4 if i % 7 else -1, "a.b", "x", 1.0, 1, f"s{i // 3}" if i % 9 else None) for i in range(40)]) \
        .withColumn("item_id", F.expr("nullif(item_id, -1)"))
    plan = _executed(cooccurrence.bought_together(I.weigh(events)))
    assert len(re.findall(r"[-:] Exchange hashpartitioning\(session_id#\d+, item_id", plan)) == 1


def test_content_scores_stay_in_their_block(spark, capsys):
    """No row per user and pool item is aggregated, joined or sorted; results as by a plain loop, odd weights included."""
    tfidf = [(i, t, w) for i in range(12) for t, w in ((f"cat:{i % 3}", 0.6), (f"brand:{i % 2}", 0.5), ("cat:all", 0.4)) if not (i > 8 and t[0] == "b")]
    scores = [(1, 0, 2.0), (1, 5, 1.0), (2, 1, 0.0), (2, 4, 3.0), (3, 2, None), (4, 7, 0.0), (5, 9, None), (5, 3, 1.0), (6, 99, 1.0), (7, 10, 1e-9)]
    known = {u: {i for v, i, _ in scores if v == u} for u, _, _ in scores}
    popular = {i: None if i == 6 else float(i * 7 % 5) for i in range(12)}
    recs = content.recommend(spark.createDataFrame(scores, "user_id int, item_id int, interaction_score double"),
                             spark.createDataFrame(tfidf, "item_id int, token string, weight double"),
                             spark.createDataFrame(list(popular.items()), "item_id int, popularity_score double"), k=4, pool_size=11, cap=2)
    order = sorted(popular, key=lambda i: (popular[i] is None, -(popular[i] or 0), i))[:11]
    brand = {i: next((t for j, t, _ in tfidf if j == i and t[0] == "b"), i) for i in order}
    want = []
    for u, own in sorted(known.items()):
        profile = {}
        for v, i, s in scores:
            for j, t, w in tfidf:
                if v == u and i == j:
                    profile.setdefault(t, []).extend([] if s is None else [s * w])
        norm = sum(sum(p) ** 2 for p in profile.values()) ** 0.5
        profile = {t: sum(p) / norm if p else None for t, p in profile.items()} if norm else {}
        found = {}
        for i in order:
            shared = [(profile[t], w) for j, t, w in tfidf if j == i and t in profile]
            if i not in own and (shared or i in order[:7]):
                terms = [p * w for p, w in shared if p is not None]
                found[i] = None if shared and not terms else round(sum(terms), 10)
        best = sorted(found, key=lambda i: (found[i] is None, -(found[i] or 0), order.index(i)))
        late = [i for n, i in enumerate(best) if sum(brand[j] == brand[i] for j in best[:n]) >= 2]
        shown = ([i for i in best if i not in late] + late)[:4]
        want += [(u, i, found[i], n + 1) for n, i in enumerate(shown)]
    assert rows(recs, "user_id", "rank") == want
    recs.explain()
    plan = capsys.readouterr().out
    assert "FlatMapCoGroupsInArrow" in plan and "HashAggregate(keys=[user_id#" in plan
    assert "inline(" not in plan and "keys=[user_id, item_id" not in plan


@pytest.mark.parametrize("item_block,pool_block", [(8192, 2048), (5, 3)])
def test_neighbours_against_a_loop(spark, item_block, pool_block):
    import random
    rng = random.Random(11)
    data = {i: [rng.uniform(-1, 1) for _ in range(6)] for i in range(30)}
    data[30] = list(data[0])
    data[31] = [0.0] * 6
    factors = spark.createDataFrame(list(data.items()), "item_id int, factors array<double>")
    units = neighbours.unit_vectors(factors)
    pool = units.where("item_id % 2 = 0")
    got = {}
    for r in neighbours.nearest(units, pool, 4, item_block, pool_block).orderBy("item_id", "rank").collect():
        got.setdefault(r.item_id, []).append(r.other_id)
    length = lambda v: math.sqrt(sum(x * x for x in v))
    for i, v in data.items():
        if not any(v):
            assert i not in got
            continue
        scores = {j: round(sum(a * b for a, b in zip(v, w)) / length(v) / length(w), 10)
                  for j, w in data.items() if j % 2 == 0 and j != i and any(w)}
        expected = sorted((j for j in scores if scores[j] > 0), key=lambda j: (-scores[j], j))[:4]
        assert got.get(i, []) == expected


def test_seen_and_recent_are_cut_before_collecting(spark, shop):
    seen = profiles.seen(I.matrix_of(shop), 3).where("user_id = 50")
    assert [r.item_id for r in seen.orderBy("item_id").collect()] == [100, 101, 102]
    assert [r.item_id for r in profiles.recent(shop, 2).where("user_id = 50").orderBy("rank").collect()] == [159, 158]
    assert profiles.shares(I.weigh(shop).withColumn("category", E.category_key()), "category").where("user_id = 3").count() == 0


def test_plans_trim_groups_before_the_shuffle(spark, shop):
    plan = profiles.seen(I.matrix_of(shop))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_text(spark):
    df = spark.createDataFrame([("sony", "electronics.audio.head_phone"), (None, None), ("hdd", "a.tv"), ("x3y-z's", "")],
                               "brand string, category_code string")
    names = [r.n for r in df.select(text.display_name().alias("n")).collect()]
    assert names == ["Sony Head Phone", "Unbranded Product", "HDD TV", "X3Y-Z'S Product"]
    assert [r.p for r in df.select(text.category_path().alias("p")).collect()][:2] == [["Electronics", "Audio", "Head Phone"], ["Other"]]


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0, 9.0], {"a": 1.0}, {"a": 2.0}), (None, [1.0], None, {"b": 1.0})],
                               "a array<double>, b array<double>, m map<string,double>, n map<string,double>")
    cos = V.map_cosine(F.col("m"), F.col("n"), V.map_norm(F.col("m")), V.map_norm(F.col("n")))
    assert rows(df.select(V.dot("a", "b"), cos)) == [(11.0, 1.0), (None, 0.0)]


def test_variant_is_the_sha256_bucket(spark):
    import hashlib
    users = [str(i) for i in range(300)] + ["guest-é"]
    got = {r.u: r.v for r in spark.createDataFrame([(u,) for u in users], "u string").select("u", variant(F.col("u")).alias("v")).collect()}
    for u in users:
        assert got[u] == ("control" if int(hashlib.sha256(u.encode()).hexdigest()[:8], 16) % 100 < 50 else "treatment")


def test_contract_rejects_with_a_reason(spark):
    raw = spark.createDataFrame([
        ("2020-01-02 03:04:05", "view", "7", 2053013555631882655, "a.b", "x", 1.5, 1, "s"), ("nonsense", "view", "7", None, None, None, 1.0, 1, "s"),
        ("2020-01-02", "wish", "7", None, None, None, 1.0, 1, "s"), ("2020-01-02", "cart", "7", None, None, None, 0.0, 1, "s"),
        ("2020-01-02", "cart", "seven", None, None, None, 1.0, 1, "s"), ("2020-01-02", "cart", "7", None, None, None, float("nan"), 1, "s")],
        "event_time string, event_type string, product_id string, category_id bigint, category_code string, brand string, price double, "
        "user_id int, user_session string")
    valid, rejected = contract.clean(raw)
    assert [(r.item_id, r.category_id) for r in valid.collect()] == [(7, 2053013555631882655)]
    assert sorted(r.reason for r in rejected.collect()) == [
        "missing item_id", "missing price", "missing timestamp", "price not positive", "unknown event_type"]


def test_partition_of_unreadable_time_is_today(spark):
    df = spark.createDataFrame([("2020-03-04T05:06:07",), ("???",), (None,)], "timestamp string")
    paths = [r.p for r in df.select(lake.partition_path().alias("p"), F.date_format(F.current_date(), "'year='yyyy'/month='MM'/day='dd").alias("t")).collect()]
    today = df.select(F.date_format(F.current_date(), "'year='yyyy'/month='MM'/day='dd").alias("t")).first().t
    assert paths == ["year=2020/month=03/day=04", today, today]


def test_lake_roundtrip_prunes_directories(spark, shop, tmp_path):
    path = str(tmp_path / "lake")
    lake.write(shop, path)
    day = lake.read(spark, path, ("2020-01-15", "2020-01-15"))
    assert lake.read(spark, path).count() == shop.count() and day.count() == 1
    assert "PartitionFilters: [isnotnull" in day._jdf.queryExecution().executedPlan().toString()


def test_csv_sample_and_messages(spark, shop, tmp_path):
    path = str(tmp_path / "csv")
    shop.coalesce(1).write.option("header", True).csv(path)
    assert contract.read_csv(spark, path, 5).count() == 5
    message = json.loads(contract.to_messages(shop.where("user_id = 3")).first().value)
    assert list(message) == list(contract.EVENT_FIELDS) and message["brand"] is None
    broken = spark.createDataFrame([("{oops",)], "value string")
    assert contract.from_messages(broken).first().user_id is None


def test_keyed_documents_and_writer(spark, tmp_path):
    df = spark.createDataFrame([(1, None, [1, 2]), (2, "x", [])], "id int, name string, xs array<int>")
    docs = keyed.documents(df, "thing", "id")
    assert docs.where("key = 'thing:1'").first().value == '{"id":1,"name":null,"xs":[1,2]}'
    folder = str(tmp_path)

    def writer(batch):
        import uuid
        with open(f"{folder}/{uuid.uuid4().hex}.txt", "w") as out:
            for row in batch:
                out.write(row.key + "\n")

    keyed.write_documents(docs, writer=writer)
    assert sorted(line for f in tmp_path.glob("*.txt") for line in f.read_text().split()) == ["thing:1", "thing:2"]
    found = keyed.get(docs, spark.createDataFrame([("thing:2",), ("thing:9",)], "key string"), df.schema)
    assert rows(found) == [("thing:2", 2, "x", [])]


def test_documents_are_committed_whole(spark, tmp_path):
    from pyspark.errors import PythonException
    from shoplens.sources import documents
    path = str(tmp_path / "docs")
    frame = lambda n, text: spark.range(n).repartition(4).select(F.concat(F.lit("k:"), F.col("id").cast("string")).alias("key"), F.lit(text).alias("value"))
    assert documents.read(spark, path).count() == 0
    documents.write(frame(50, 'é "x"\n'), path)
    assert {(r.key, r.value) for r in documents.read(spark, path).collect()} == {(f"k:{i}", 'é "x"\n') for i in range(50)}

    def fails(batches):
        for batch in batches:
            yield batch
            if any(k.endswith("7") for k in batch["key"]):
                raise ValueError("a task that fails after some rows")

    with pytest.raises(PythonException):
        documents.write(frame(50, "new").mapInPandas(fails, "key string, value string"), path)
    assert {r.value for r in documents.read(spark, path).collect()} == {'é "x"\n'}
    assert len(list((tmp_path / "docs").glob("*.jsonl"))) <= 4
    documents.write(frame(3, "more"), path, "append")
    assert documents.read(spark, path).count() == 53
    documents.write(frame(2, "only"), path)
    assert rows(documents.read(spark, path), "key") == [("k:0", "only"), ("k:1", "only")]
    assert len(list((tmp_path / "docs").glob("*.jsonl"))) <= 2


def test_experiment_rows_are_checked(spark, tmp_path):
    df = spark.createDataFrame([("1", "5", "control", "click"), ("1", "5", "blue", "click"), ("1", None, "control", "click"),
                                ("1", "5", "treatment", "view")], "user_id string, item_id string, variant string, event_type string")
    experiments.append_events(df, str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    assert stored.count() == 1 and stored.first().event_timestamp is not None


def test_missing_evaluation_report_is_empty(spark, tmp_path):
    assert evaluation.latest_report(spark, str(tmp_path / "nothing")).count() == 0


LISTED = ("item_id int, brand string, category_code string, category_id bigint, price double, views bigint, carts bigint, "
          "purchases bigint, unique_users bigint, popularity_score double, conversion_rate double, root string")


def test_listing_needs_every_term(spark):
    items = spark.createDataFrame([(i, "sony", "tv.oled" if i % 2 else "tv.lcd", 1, 9.0, 0, 0, 0, 1, float(i), 0.0, "tv") for i in range(9)], LISTED)
    page = listing.listing(items, listing.trigram_postings(items), "tv", "OLED sony", 1, 2).orderBy("position").collect()
    assert [(r.item_id, r.total) for r in page] == [(5, 4), (3, 4)]


@pytest.mark.parametrize("block_items", [3, 4096])
def test_search_equals_a_scan(spark, block_items):
    import random
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))
    rows_ = [(i, rng.choice([None, word(), "Äbc"]), rng.choice([None, "", f"{word()}.{word()}"]), 1, 1.0, 0, 0, 0, 1, rng.choice([None, 1.0, 2.0]), 0.0, "x")
             for i in range(120)]
    items = spark.createDataFrame(rows_, LISTED).cache()
    postings = listing.trigram_postings(items, block_items).cache()
    public = {r.item_id: f"{r.name} {r.category_code or ''} {r.item_id}".lower() for r in catalog.public_view(items).collect()}
    for query in ("a", "ab", "abc", "b c", "abca 1", "bb cab", ".", " ", None, "zzz", "äb", "%", "unbranded prod"):
        got = {r.item_id for r in listing.matching(items, postings, query=query).collect()}
        assert got == {i for i, hay in public.items() if all(t in hay for t in (query or "").lower().split())}, query


def test_pages_by_key_walk_the_whole_listing(spark):
    items = spark.createDataFrame([(i, "b", "c", 1, 1.0, 0, 0, 0, 1, [None, 2.0, 2.0, 5.0][i % 4], 0.0, "c") for i in range(50)], LISTED)
    rows_ = listing.matching(items, listing.trigram_postings(items), "c").cache()
    whole = [r.item_id for r in rows_.orderBy(*catalog.by_popularity()).collect()]
    walked, after = [], None
    while True:
        page = listing.page(rows_, 7, after).collect()
        if not page:
            break
        walked += [r.item_id for r in page]
        after = (page[-1].popularity_score or 0.0, page[-1].item_id)
    assert walked == whole and len(whole) == 50


def test_user_stats_and_summary_read_the_events_once(spark, shop):
    stats = {r.user_id: r for r in profiles.user_stats(shop).collect()}
    assert (stats[1].n_events, stats[1].n_items, stats[1].n_sessions, stats[1].avg_price) == (3, 2, 2, 18.33)
    assert (stats[50].n_events, stats[50].n_items, stats[50].n_sessions, stats[50].segment) == (60, 60, 1, "warm")
    odd = make_events(spark, [(0, "view", 1, None, None, None, 1, None), (1, "gift", 1, None, None, 2.0, 1, "s")])
    row = profiles.user_stats(odd).first()
    assert (row.n_events, row.views, row.n_items, row.n_sessions, row.avg_price) == (2, 1, 1, 1, 2.0)
    plan = profiles.user_stats(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_run_summary_counts(spark, shop):
    row = metrics.run_summary(shop, I.matrix_of(shop)).first()
    assert (row.events, row.users, row.sessions, row.cold_start_users) == (68, 5, 6, 4)
    assert row.interaction_pairs == 66


def test_an_assignment_is_written_once(spark, tmp_path):
    from shoplens.operators import experiments
    path = str(tmp_path / "assignments")
    users = spark.createDataFrame([(1,), (2,)], "user_id int")
    experiments.append_assignments(users, path)
    experiments.append_assignments(users.unionByName(spark.createDataFrame([(3,)], "user_id int")), path)
    assert sorted(r.user_id for r in spark.read.parquet(path).collect()) == ["1", "2", "3"]


def test_a_missing_report_is_empty_and_a_broken_one_is_an_error(spark, tmp_path):
    import pytest
    from pyspark.errors import ParseException
    from shoplens.operators import evaluation
    assert evaluation.latest_report(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ParseException):
        evaluation.stored_rows(spark, str(tmp_path), "no schema at all (")


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    import pytest
    from types import SimpleNamespace
    from shoplens.session import shared_dir
    conf = SimpleNamespace(get=lambda key, default=None: default)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError):
        shared_dir(cluster)
