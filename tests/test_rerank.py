"""The re-ranker on hand-made items, users and pages."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from shoplens import config
from shoplens.operators.rerank import rerank, variety
from shoplens.operators.rerank.candidates import complement_categories, popular_in_category
from shoplens.operators import profiles
from shoplens.sources.lake import overwrite

ITEMS = ("item_id int, brand string, category_code string, category_id bigint, price double, popularity_score double, "
         "tokens map<string,double>, factors array<double>, similar array<struct<item_id:int,score:double>>, "
         "also array<struct<item_id:int,score:double,sessions:bigint>>")
USERS = ("user_id int, avg_price double, factors array<double>, profile map<string,double>, "
         "categories array<struct<key:string,share:double>>, brands array<struct<key:string,share:double>>, seen array<int>")
LISTS = "user_id int, recommendations array<struct<item_id:int,rating:float>>, source string"
SESSIONS = "user_id int, position int, item_id int, event_type string"
COMPLEMENTS = "category string, rank int, other string, score double, users bigint"
REQUESTS = "request_id string, user_id int, context_item_id int, limit int"

LAMP, SOFA, DESK = "home.light.lamp", "home.living.sofa", "office.desk"


def thing(item_id, code=LAMP, brand="acme", price=40.0, popularity=7.0, factors=None, similar=None, also=None, tokens=None):
    own = tokens if tokens is not None else {f"cat:{code}": 0.8, f"brand:{brand}": 0.6}
    return (item_id, brand, code, 1, price, popularity, own, factors, similar, also)


_RUNS = itertools.count()


def staged(spark):
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/rerank-{next(_RUNS)}"
    return lambda df, name: overwrite(df, f"{folder}/{name}")


def run(spark, items, requests, users=(), lists=(), sessions=(), complements=(), known=None):
    table = lambda rows, ddl: spark.createDataFrame(list(rows), ddl)
    return rerank(table(requests, REQUESTS), table(items, ITEMS), table(users, USERS), table(lists, LISTS),
                  table(sessions, SESSIONS), table(complements, COMPLEMENTS), staged(spark), known)


def by_item(result, request="r"):
    found = {}
    for row in result.where(F.col("request_id") == request).collect():
        found[row.item_id] = (row, {f.key: f.value for f in row.factors})
    return found


@pytest.mark.parametrize("profile", sorted(config.RANKING_PROFILES))
def test_weights_of_a_profile_add_up_to_one(profile):
    assert math.isclose(sum(weight for _, weight in config.RANKING_PROFILES[profile].values()), 1.0)


def test_guest_gets_popularity_only(spark):
    found = by_item(run(spark, [thing(1), thing(2, popularity=1.0)], [("r", None, None, 5)]))
    row, values = found[1]
    assert row.source == "popular"
    assert values["popularity"] == pytest.approx(1.0)
    assert all(values[k] == 0.0 for k in ("als", "content", "session", "brand", "category", "price"))
    assert row.score == pytest.approx(0.03)
    assert found[2][1]["popularity"] == pytest.approx(math.log(2) / math.log(8), abs=1e-4)


def test_score_is_the_weighted_sum_and_contributions_add_up(spark):
    user = (5, 40.0, [1.0, 0.0], {f"cat:{LAMP}": 1.0}, [(LAMP, 1.0)], [("acme", 1.0)], [])
    row, values = by_item(run(spark, [thing(1, factors=[0.5, 0.0])], [("r", 5, None, 5)], [user]))[1]
    assert row.score == pytest.approx(sum(f.weight * f.value for f in row.factors), abs=1e-3)
    assert sum(f.contribution for f in row.factors) == pytest.approx(1.0, abs=1e-3)
    assert values["price"] == pytest.approx(1.0) and values["category"] == pytest.approx(1.0)
    assert values["content"] == pytest.approx(0.8, abs=1e-4)


def test_prediction_is_clipped_not_scaled(spark):
    user = (5, None, [1.0, 1.0], None, None, None, None)
    items = [thing(1, factors=[0.25, 0.25]), thing(2, factors=[0.9, 0.8]), thing(3, factors=[-1.0, 0.0]), thing(4)]
    found = by_item(run(spark, items, [("r", 5, None, 9)], [user]))
    assert [found[i][1]["als"] for i in (1, 2, 3, 4)] == pytest.approx([0.5, 1.0, 0.0, 0.0])
    assert found[2][0].als_prediction == pytest.approx(1.7)
    assert found[3][0].als_prediction == 0.0 and found[4][0].als_prediction is None


def test_page_of_an_item_prefers_what_resembles_it(spark):
    user = (5, None, [1.0, 0.0], None, None, None, None)
    items = [thing(9, SOFA, "nord"), thing(1, SOFA, "acme", factors=[0.1, 0.0]), thing(2, DESK, "other", factors=[0.9, 0.0])]
    result = run(spark, items, [("r", 5, 9, 5)], [user])
    order = [r.item_id for r in result.orderBy("position").collect()]
    assert order == [1, 2]
    assert by_item(result)[1][0].source == "category"


def test_session_click_promotes_its_category(spark):
    items = [thing(1, LAMP, "a"), thing(2, SOFA, "b", popularity=9.0), thing(3, LAMP, "c")]
    requests = [("quiet", 6, None, 2), ("clicked", 5, None, 2)]
    result = run(spark, items, requests, sessions=[(5, 0, 3, "cart"), (5, 1, 77, "view")])
    quiet, clicked = by_item(result, "quiet"), by_item(result, "clicked")
    assert quiet[1][1]["session"] == 0.0
    assert clicked[1][1]["session"] > clicked[2][1]["session"]
    assert clicked[1][0].position == 1 and 3 not in clicked


def test_partners_of_the_page_and_first_source(spark):
    items = [thing(9, SOFA, also=[(1, 0.9, 4)], similar=[(1, 0.8), (2, 0.7)]), thing(1), thing(2), thing(3, DESK)]
    found = by_item(run(spark, items, [("r", None, 9, 9)]))
    assert {i: found[i][0].source for i in found} == {1: "copurchase", 2: "similar", 3: "popular"}
    assert found[1][1]["copurchase"] == 0.9 and found[2][1]["copurchase"] == 0.0


def test_exclusions_and_list_source(spark):
    user = (5, None, None, None, None, None, [1])
    items = [thing(i) for i in range(1, 6)]
    found = by_item(run(spark, items, [("r", 5, 2, 9)], [user], [(5, [(1, 0.5), (3, 0.4), (44, 0.3)], "content")],
                        [(5, 0, 4, "view")]))
    assert set(found) == {3, 5}
    assert found[3][0].source == "category" and found[5][0].source == "category"


def test_price_fit_values(spark):
    user = (5, 100.0, None, None, None, None, None)
    found = by_item(run(spark, [thing(1, price=100.0), thing(2, price=200.0), thing(3, price=50.0), thing(4, price=None)],
                        [("r", 5, None, 9)], [user]))
    assert [found[i][1]["price"] for i in (1, 2, 3, 4)] == pytest.approx([1.0, 0.5, 0.5, 0.0])


def test_half_credit_for_the_same_department(spark):
    user = (5, None, None, None, [(LAMP, 0.6), (SOFA, 0.2)], None, None)
    items = [thing(1, LAMP), thing(2, "home.kitchen.pan"), thing(3, DESK)]
    found = by_item(run(spark, items, [("r", 5, None, 9)], [user]))
    assert [found[i][1]["category"] for i in (1, 2, 3)] == pytest.approx([0.7, 0.4, 0.0])


def test_learned_complement_scores_and_enters_the_list(spark):
    items = [thing(9, SOFA), thing(1, LAMP, popularity=1.0)] + [thing(i, DESK) for i in range(20, 60)]
    found = by_item(run(spark, items, [("r", None, 9, 60)], complements=[(SOFA, 1, LAMP, 0.4, 3)]))
    assert found[1][0].source == "complement" and found[1][1]["complement"] == 1.0
    assert found[59][1]["complement"] == 0.0


def test_department_tops_up_missing_complements(spark):
    codes = [("home.a", 5.0), ("home.b", 9.0), ("home.c", 7.0), ("home.d", 1.0), ("office.x", 99.0)]
    items = spark.createDataFrame([thing(i, code, popularity=p) for i, (code, p) in enumerate(codes)], ITEMS) \
        .withColumn("root", F.split_part("category_code", F.lit("."), F.lit(1)))
    learned = spark.createDataFrame([("home.a", 1, "home.c", 0.5, 2)], COMPLEMENTS)
    rows = complement_categories(items.select("category_code"), learned, items)
    got = {r.category_code: [(c.category, c.kind, c.value) for c in r.complements] for r in rows.collect()}
    assert got["home.a"] == [("home.c", "learned", 1.0), ("home.b", "department", 0.3), ("home.d", "department", 0.3)]
    assert [c for c, _, _ in got["home.b"]] == ["home.c", "home.a", "home.d"]
    assert got["office.x"] == []


def test_variety_lets_another_category_in(spark):
    items = [thing(50, LAMP, "x", price=500.0)] + [thing(i, LAMP, "acme", price=500.0) for i in range(1, 7)] \
        + [thing(99, "home.audio", "sono", price=100.0)]
    result = run(spark, items, [("r", None, 50, 6)], complements=[(LAMP, 1, "home.audio", 0.4, 5)])
    shown = result.orderBy("position").collect()
    assert shown[0].item_id == 1 and 99 in [r.item_id for r in shown[:3]]
    other = next(r for r in shown if r.item_id == 99)
    assert other.score < shown[0].score
    second = [r for r in shown if r.item_id != 99][1]
    assert second.same_category_before == 1 and second.multiplier == pytest.approx(0.6)


def test_variety_equals_the_greedy_choice(spark):
    """Against a plain greedy loop on many random lists."""
    import random
    rng = random.Random(7)
    data, expected = [], {}
    for n in range(60):
        listing = [(i, rng.choice("abc"), rng.choice([0.1, 0.25, 0.4, 0.4, 0.7, 0.9])) for i in range(rng.randint(1, 15))]
        kind = rng.choice(["home", "product"])
        decay, left, picks, order = config.VARIETY_DECAY[kind], list(listing), {}, []
        while left and len(order) < 8:
            best = max(left, key=lambda e: (round(e[2] * decay ** picks.get(e[1], 0), 12), -e[0]))
            left.remove(best)
            picks[best[1]] = picks.get(best[1], 0) + 1
            order.append(best[0])
        expected[str(n)] = order
        data += [(str(n), 8, kind, i, c, s) for i, c, s in listing]
    scored = spark.createDataFrame(data, "request_id string, limit int, profile_name string, item_id int, item_category string, score double")
    got = {}
    for r in variety.diversify(scored).orderBy("request_id", "position").collect():
        got.setdefault(r.request_id, []).append(r.item_id)
    assert got == expected


def test_changed_positions(spark):
    ddl = "request_id string, position int, item_id int"
    before = spark.createDataFrame([("r", 1, 10), ("r", 2, 20), ("r", 3, 30)], ddl)
    after = spark.createDataFrame([("r", 1, 10), ("r", 2, 30), ("r", 3, 20), ("r", 4, 40)], ddl)
    assert variety.changed_positions(before, after).first().changed == 3


def _history(spark, sizes, step=2):
    pairs = [(user, step * i, 1.0) for user, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(pairs, "user_id int, item_id int, interaction_score double")


@pytest.mark.parametrize("block", [7, 2048])
def test_no_known_item_is_offered_to_a_user_with_500(spark, block):
    matrix = _history(spark, {5: 500, 6: 200, 7: 3})
    seen = {r.user_id: r.s for r in profiles.seen(matrix).groupBy("user_id").agg(F.sort_array(F.collect_list("item_id")).alias("s")).collect()}
    assert len(seen[5]) == config.SEEN_ITEMS
    users = [(u, None, None, None, None, None, seen[u]) for u in (5, 6, 7)] + [(8, None, None, None, None, None, None)]
    lists = [(u, [(i, 0.5) for i in range(380, 440)], "als") for u in (5, 6, 7, 8)]
    known = profiles.known_blocks(matrix, size=block)
    assert {r.user_id for r in known.collect()} == {5} and max(len(r["items"]) for r in known.collect()) <= block
    result = run(spark, [thing(i, f"c{i}") for i in range(380, 440)], [(f"r{u}", u, None, 60) for u in (5, 6, 7, 8)], users, lists, known=known)
    shown = {u: set(by_item(result, f"r{u}")) for u in (5, 6, 7, 8)}
    assert shown[5] == {i for i in range(380, 440) if i % 2}
    assert shown[6] == {i for i in range(380, 440) if i % 2 or i >= 400}
    assert shown[7] == shown[8] == set(range(380, 440))


def test_known_blocks_are_sorted_and_whole(spark):
    blocks = profiles.known_blocks(_history(spark, {1: 1000, 2: 201, 3: 200}, 3), size=64).orderBy("user_id", "low").collect()
    assert [i for r in blocks if r.user_id == 1 for i in r["items"]] == [3 * i for i in range(1000)]
    assert all(r.low == r["items"][0] and r.high == r["items"][-1] for r in blocks) and {r.user_id for r in blocks} == {1, 2}
    assert profiles.known_blocks(_history(spark, {3: 5}), size=64).count() == 0


def test_category_lists_read_the_whole_catalog(spark):
    items = spark.range(12_000).select(
        F.col("id").cast("int").alias("item_id"), F.when(F.col("id") < 11_990, "big.one").otherwise("small.one").alias("category_code"),
        F.lit(1).cast("long").alias("category_id"), (12_000.0 - F.col("id")).alias("popularity_score"), F.lit("x").alias("brand"))
    got = popular_in_category(items, "category_code", 3).collect()
    assert {(r.category_code, r["rank"], r.item_id) for r in got} == {
        ("big.one", 1, 0), ("big.one", 2, 1), ("big.one", 3, 2), ("small.one", 1, 11_990), ("small.one", 2, 11_991), ("small.one", 3, 11_992)}
    plan = popular_in_category(items, "category_code", 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_page_of_an_item_beyond_the_popular_head(spark, monkeypatch):
    """Department complements and category lists of items that are nowhere near the most popular ones."""
    monkeypatch.setattr(config, "POPULAR_HEAD", 3)
    items = [thing(i, "big.shelf", popularity=100.0 + i) for i in range(1, 6)] \
        + [thing(20, "rare.a", popularity=1.0), thing(21, "rare.a", popularity=0.5), thing(22, "rare.b", popularity=0.4)]
    found = by_item(run(spark, items, [("r", None, 20, 9)]))
    assert found[21][0].source == "category" and found[22][0].source == "complement"
    assert found[22][1]["complement"] == config.DEPARTMENT_VALUE


def test_viewers_move_once_and_requests_keep_what_scoring_reads(spark):
    """Heavy and usual users get their own documents; viewer rows are not dealt anew, candidate lists not written again."""
    from shoplens.operators.rerank import prepared_requests, session_docs, session_rows
    table = lambda data, ddl: spark.createDataFrame(list(data), ddl)
    items = table([thing(1), thing(2)], ITEMS)
    ids = spark.range(1500).select(F.col("id").cast("int").alias("user_id"))
    asks = ids.unionByName(spark.range(40).select(F.lit(7).alias("user_id"))).unionByName(spark.range(3).select(F.lit(None).cast("int").alias("user_id")))
    requests = asks.select(F.expr("uuid()").alias("request_id"), "user_id", F.when(F.col("user_id") == 9, 1).alias("context_item_id"), F.lit(5).alias("limit")) \
        .localCheckpoint()
    users = ids.select("user_id", F.col("user_id").cast("double").alias("avg_price"), *[
        F.lit(None).cast(t).alias(n) for n, t in (("factors", "array<double>"), ("profile", "map<string,double>"),
                                                  ("categories", "array<struct<key:string,share:double>>"),
                                                  ("brands", "array<struct<key:string,share:double>>"), ("seen", "array<int>"))])
    head = items.select("item_id", F.col("item_id").alias("place"))
    live = session_docs(session_rows(table([], SESSIONS), items, head.select("item_id")))
    rows = prepared_requests(requests, items, users, table([], LISTS), live, table([], COMPLEMENTS), head)
    assert not {"session", "recommendations", "categories", "brands"} & set(rows.columns)
    assert [f.name for f in rows.schema["context"].dataType] == ["tokens"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "hashpartitioning(user_id" in line and "_salt" in line]
    got = rows.select("user_id", "reference_price", "profile_name", "context").collect()
    assert len(got) == 1543 and sum(r.user_id is None for r in got) == 3
    assert all(r.reference_price == (None if r.user_id in (None, 0) else 40.0 if r.user_id == 9 else float(r.user_id)) for r in got)
    assert {r.user_id for r in got if r.profile_name == "product"} == {9} == {r.user_id for r in got if r.context is not None}


def test_session_rows_are_numbered_before_items_meet_them(spark):
    """No sort by user carries what the catalog brings along, and rows hold only what session documents read."""
    from shoplens.operators.rerank.context import session_rows
    catalog = "item_id int, brand string, category_code string, category_id long, price double, popularity_score double, " \
              "tokens map<string,double>, factors array<double>, similar array<struct<item_id:int,score:double>>, " \
              "also array<struct<item_id:int,score:double,sessions:bigint>>"
    items = spark.createDataFrame([(i, "b", "c", 1, 2.0, 1.0, {"t": 1.0}, [1.0], [(i, 0.5)], [(i, 0.5, 2)]) for i in (1, 2, 3)], catalog)
    sessions = spark.createDataFrame([(7, 0, 9, "view"), (7, 1, 2, "view"), (7, 2, 1, "cart"), (8, 0, 3, "view"), (8, 1, None, "view")],
                                     "user_id int, position int, item_id int, event_type string")
    found = session_rows(sessions, items, items.select("item_id").limit(1))
    assert sorted((r.user_id, r.position, r.item_id, r.tokens["t"]) for r in found.collect()) == [(7, 0, 2, 1.0), (7, 1, 1, 1.0), (8, 0, 3, 1.0)]
    assert "factors" not in found.columns
    below = lambda node: [node] + [x for i in range(node.children().size()) for x in below(node.children().apply(i))]
    windows = [x for x in below(found._jdf.queryExecution().optimizedPlan()) if x.nodeName() == "Window"]
    assert windows and not any("also" in x.output().mkString(",") for x in windows)
