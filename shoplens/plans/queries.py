"""Registered queries over the driver's tables."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens import config
from shoplens.functions import events as E
from shoplens.functions import text, vectors as V
from shoplens.functions.experiments import variant
from shoplens.operators import (catalog, complements, content, cooccurrence, evaluation, experiments,
                                interactions as I, items as IT, listing, metrics, profiles, sanity)
from shoplens.plans.oracles import settled, sql
from shoplens.operators import factorization, neighbours, routing
from shoplens.operators.rerank import candidates as RC, context as RX, factors as RF, variety as RV, views
from shoplens.plans import jobs
from shoplens.plans.workspace import workspace
from shoplens.sources import contract, documents, keyed, lake
from shoplens.sources.tables import behaviour_events, table
from shoplens.streaming import features as SF, ingest, sessions as SS

QUERIES, ORACLES = {}, {}


def query(name, oracle=None):
    def register(build):
        QUERIES[name] = build
        if oracle:
            ORACLES[name] = sql(oracle)
        return build
    return register


def r6(column, name=None):
    return F.round(column, 6).alias(name or column)


def _weighted(spark, d):
    return I.weigh(workspace(spark, d).table("events"))


def _matrix(spark, d):
    return I.matrix_of(behaviour_events(spark, d))


# --- events, weights, interactions ------------------------------------------------

@query("event_weight", "SELECT event_type, w AS event_weight, count(*) AS events FROM wt GROUP BY ALL")
def event_weight(spark, d):
    return _weighted(spark, d).groupBy("event_type", "event_weight").agg(F.count("*").alias("events"))


@query("event_weight_unknown_types", """SELECT event_type, CASE event_type WHEN 'purchase' THEN 5 WHEN 'cart' THEN 3
    WHEN 'view' THEN 1 ELSE 0 END AS event_weight, count(*) AS events FROM events GROUP BY ALL""")
def event_weight_unknown_types(spark, d):
    return I.weigh(table(spark, d, "events")).groupBy("event_type", "event_weight").agg(F.count("*").alias("events"))


@query("time_decay", """SELECT user_id, item_id, event_type, strftime(timestamp, '%Y-%m-%d %H:%M') AS at,
    round(decay, 6) AS decay_factor, round(w * decay, 6) AS weighted_score FROM dc""")
def time_decay(spark, d):
    return I.decay(_weighted(spark, d)).select(
        "user_id", "item_id", "event_type", E.minute_text("timestamp").alias("at"),
        r6("decay_factor"), r6("weighted_score"))


@query("interaction_matrix", "SELECT user_id, item_id, round(score, 6) AS interaction_score FROM mx")
def interaction_matrix(spark, d):
    return _matrix(spark, d).select("user_id", "item_id", r6("interaction_score"))


@query("top_pairs_per_user", f"""SELECT user_id, item_id, rank, {settled('score', 6)} AS interaction_score FROM (
    SELECT user_id, item_id, round(score, 10) AS score, CAST(row_number() OVER (PARTITION BY user_id
      ORDER BY round(score, 10) DESC, item_id) AS INT) AS rank FROM mx) WHERE rank <= {config.TOP_N}""")
def top_pairs_per_user(spark, d):
    return I.top_pairs(_matrix(spark, d)).select("user_id", "item_id", "rank", r6("interaction_score"))


@query("item_features", """SELECT item_id, popularity AS popularity_score, round(conversion, 6) AS conversion_rate FROM feat""")
def item_features(spark, d):
    return I.item_features(_weighted(spark, d)).select("item_id", "popularity_score", r6("conversion_rate"))


@query("user_segments", """SELECT user_id, n AS n_events, CASE WHEN n <= 3 THEN 'cold_start' ELSE 'warm' END AS segment FROM counts""")
def user_segments(spark, d):
    return I.user_segments(behaviour_events(spark, d))


@query("cold_users", "SELECT user_id FROM cold")
def cold_users(spark, d):
    return I.cold_users(behaviour_events(spark, d))


@query("train_test_split", f"""SELECT user_id, item_id, CASE WHEN side < {config.TRAIN_PERCENT} THEN 'train' ELSE 'test' END AS part
    FROM pair_side""")
def train_test_split(spark, d):
    train, test = I.split_pairs(_matrix(spark, d))
    label = lambda df, part: df.select("user_id", "item_id", F.lit(part).alias("part"))
    return label(train, "train").unionByName(label(test, "test"))


# --- scalar expressions ---------------------------------------------------------------

@query("typed_events", """SELECT user_id, item_id, event_type, CAST(category_id AS VARCHAR) AS category_id, category_code, brand,
    round(price, 8) AS price, strftime(timestamp, '%Y-%m-%d %H:%M') AS at, session_id, w AS event_weight, category FROM wt""")
def typed_events(spark, d):
    loaded = contract.load_events(behaviour_events(spark, d))
    return loaded.select("user_id", "item_id", "event_type", "category_id", "category_code", "brand",
                         F.round("price", 8).alias("price"),
                         E.minute_text("timestamp").alias("at"), "session_id", "event_weight", "category")


@query("category_fallback", "SELECT category, count(*) AS events FROM wt GROUP BY ALL")
def category_fallback(spark, d):
    return behaviour_events(spark, d).groupBy(E.category_key().alias("category")).agg(F.count("*").alias("events"))


@query("root_category", "SELECT coalesce(split_part(category_code, '.', 1), 'other') AS root, count(*) AS events FROM ev GROUP BY ALL")
def root_category(spark, d):
    return behaviour_events(spark, d).groupBy(E.root_category().alias("root")).agg(F.count("*").alias("events"))


@query("category_prefixes", "SELECT item_id, token FROM tokens WHERE token LIKE 'cat:%'")
def category_prefixes(spark, d):
    return IT.item_basics(behaviour_events(spark, d)).select("item_id", F.explode(E.category_prefixes()).alias("token"))


@query("item_tokens", "SELECT item_id, token FROM tokens")
def item_tokens(spark, d):
    return IT.token_rows(IT.item_basics(behaviour_events(spark, d)))


TITLE = "upper(substr({0}, 1, 1)) || lower(substr({0}, 2))"
NAME = f"coalesce({TITLE.format('brand')}, 'Unbranded') || ' ' || coalesce({TITLE.format('''split_part(category_code, '.', -1)''')}, 'Product')"


@query("display_names", f"SELECT item_id, {NAME} AS name FROM meta")
def display_names(spark, d):
    return IT.item_basics(behaviour_events(spark, d)).select("item_id", text.display_name().alias("name"))


PUBLIC = f"""item_id, brand, category_code, category_id, price, views, carts, purchases, unique_users, popularity_score,
    conversion_rate, {NAME} AS name, coalesce(array_to_string(list_transform(string_split(category_code, '.'),
      lambda t: {TITLE.format('t')}), ' > '), 'Other') AS category_path, root AS category_root"""


@query("public_items", f"SELECT {PUBLIC}, false AS has_embedding FROM items")
def public_items(spark, d):
    return catalog.public_view(catalog.described_items(_weighted(spark, d))) \
        .withColumn("category_path", F.array_join("category_path", " > "))


@query("item_labels", """SELECT item_id, coalesce(code, 'cid:' || CAST(cid AS VARCHAR)) || ' | ' || coalesce(brand, '-') AS label FROM basics""")
def item_labels(spark, d):
    return IT.item_basics(behaviour_events(spark, d)).select("item_id", text.item_label().alias("label"))


@query("event_time_text", """SELECT strftime(ts, '%Y-%m-%d %H:%M') AS minute, strftime(ts, '%Y-%m-%d %H:00') AS hour,
    count(*) AS events FROM events GROUP BY ALL""")
def event_time_text(spark, d):
    return table(spark, d, "events").groupBy(E.minute_text("ts").alias("minute"), E.hour_text("ts").alias("hour")) \
        .agg(F.count("*").alias("events"))


@query("experiment_assignments", """SELECT user_id, CASE WHEN CAST('0x' || substr(sha256(user_id), 1, 8) AS BIGINT) % 100 < 50
    THEN 'control' ELSE 'treatment' END AS variant FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id FROM ev)""")
def experiment_assignments(spark, d):
    return experiments.assignments(behaviour_events(spark, d))


# --- items and content -----------------------------------------------------------------

@query("item_metadata", "SELECT * FROM meta")
def item_metadata(spark, d):
    return IT.item_metadata(behaviour_events(spark, d))


@query("item_tfidf", "SELECT item_id, token, round(weight, 6) AS weight FROM tfidf")
def item_tfidf(spark, d):
    return IT.item_tfidf(behaviour_events(spark, d)).select("item_id", "token", r6("weight"))


@query("item_token_maps", "SELECT item_id, token, round(weight, 4) AS weight FROM tfidf")
def item_token_maps(spark, d):
    return IT.token_maps(IT.item_tfidf(behaviour_events(spark, d))).select("item_id", F.explode("tokens").alias("token", "weight"))


@query("candidate_pool", "SELECT item_id, popularity AS popularity_score FROM pool")
def candidate_pool(spark, d):
    return IT.popular_pool(I.item_features(_weighted(spark, d))).select("item_id", "popularity_score")


@query("user_token_profiles", "SELECT user_id, token, round(w, 6) AS profile_weight FROM profile")
def user_token_profiles(spark, d):
    ws = workspace(spark, d)
    return profiles.token_profiles(ws.table("interaction_matrix"), ws.table("item_tfidf")) \
        .select("user_id", "token", r6("profile_weight"))


@query("user_profile_export", "SELECT user_id, token, w AS weight FROM topprofile")
def user_profile_export(spark, d):
    ws = workspace(spark, d)
    return profiles.top_profile_tokens(profiles.token_profiles(ws.table("interaction_matrix"), ws.table("item_tfidf"))) \
        .select("user_id", "token", "weight")


@query("content_similarity", """SELECT user_id, item_id, round(sum(w * weight), 6) AS score FROM
    (SELECT user_id, token, w / norm AS w FROM (SELECT user_id, token, w, sqrt(sum(w * w) OVER (PARTITION BY user_id)) AS norm
      FROM (SELECT user_id, token, sum(score * weight) AS w FROM coldmx JOIN tfidf USING (item_id) GROUP BY ALL)) WHERE norm > 0)
    JOIN tfidf USING (token) WHERE item_id IN (SELECT item_id FROM pool) GROUP BY ALL""")
def content_similarity(spark, d):
    ws = workspace(spark, d)
    tfidf = ws.table("item_tfidf")
    cold = content.cold_history(ws.table("events"), ws.table("interaction_matrix"))
    pool = IT.popular_pool(ws.table("item_features"))
    return content.similarity(profiles.token_profiles(cold, tfidf), content.pool_tokens(tfidf, pool)) \
        .select("user_id", "item_id", r6("score"))


@query("content_recommendations", f"SELECT user_id, item_id, {settled('score', 6)} AS score, CAST(rank AS INT) AS rank FROM content")
def content_recommendations(spark, d):
    ws = workspace(spark, d)
    history = content.cold_history(ws.table("events"), ws.table("interaction_matrix"))
    return content.recommend(history, ws.table("item_tfidf"), ws.table("item_features")) \
        .select("user_id", "item_id", r6("score"), "rank")


def _content(spark, d):
    return workspace(spark, d).table("content_recommendations")


# --- mining ------------------------------------------------------------------------------

@query("session_pairs", """SELECT x.item_id AS item_a, y.item_id AS item_b, CAST(sum(least(x.w, y.w)) AS BIGINT) AS w, count(*) AS sessions
    FROM elig x JOIN elig y ON x.session_id = y.session_id AND x.item_id < y.item_id GROUP BY ALL""")
def session_pairs(spark, d):
    pairs = cooccurrence.session_pairs(cooccurrence.eligible_session_items(_weighted(spark, d)))
    return pairs.groupBy("item_a", "item_b").agg(F.sum("w").alias("w"), F.count("*").alias("sessions"))


@query("bought_together", f"SELECT item_id, CAST(rank AS INT) AS rank, other_id, {settled('score', 4)} AS score, sessions FROM also")
def bought_together(spark, d):
    return cooccurrence.bought_together(_weighted(spark, d))


@query("sessions_left_out", f"""SELECT count(*) AS sessions, CAST(coalesce(sum(n), 0) AS BIGINT) AS items, CAST(coalesce(sum(n * (n - 1) // 2), 0) AS BIGINT) AS pairs
    FROM (SELECT session_id, count(*) AS n FROM sess GROUP BY session_id HAVING count(*) > 5)""")
def sessions_left_out(spark, d):
    """What a cut of sessions at five items would leave out."""
    return cooccurrence.left_out(_weighted(spark, d), 5)


@query("bought_together_short", """SELECT item_id, CAST(rank AS INT) AS rank, other_id, CAST(round(CAST(score AS DECIMAL(24, 10)), 4) AS DOUBLE) AS score, sessions FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, other_id) AS rank FROM (
      SELECT p.item_id, p.other_id, round(p.w / sqrt(a.total * b.total), 10) AS score, p.sessions FROM (
        SELECT x.item_id, y.item_id AS other_id, sum(least(x.w, y.w)) AS w, count(*) AS sessions FROM sess x JOIN sess y
          ON x.session_id = y.session_id AND x.item_id <> y.item_id WHERE x.session_id IN (SELECT session_id FROM sess GROUP BY session_id
            HAVING count(*) BETWEEN 2 AND 5) GROUP BY ALL) p
      JOIN (SELECT item_id, sum(w) AS total FROM sess WHERE session_id IN (SELECT session_id FROM sess GROUP BY session_id
        HAVING count(*) BETWEEN 2 AND 5) GROUP BY item_id) a ON a.item_id = p.item_id
      JOIN (SELECT item_id, sum(w) AS total FROM sess WHERE session_id IN (SELECT session_id FROM sess GROUP BY session_id
        HAVING count(*) BETWEEN 2 AND 5) GROUP BY item_id) b ON b.item_id = p.other_id)) WHERE rank <= 12""")
def bought_together_short(spark, d):
    """Partners from sessions of at most five items: the cut as a parameter."""
    return cooccurrence.bought_together(_weighted(spark, d), max_items=5)


@query("category_shared_users", """SELECT x.category_code AS category_a, y.category_code AS category_b, count(*) AS users FROM ucat x
    JOIN ucat y ON x.user_id = y.user_id AND x.category_code < y.category_code GROUP BY ALL HAVING count(*) >= 2""")
def category_shared_users(spark, d):
    return complements.shared_users(complements.user_categories(_weighted(spark, d)))


@query("category_complements", f"SELECT category, CAST(rank AS INT) AS rank, other, {settled('score', 4)} AS score, users FROM compl")
def category_complements(spark, d):
    return complements.category_complements(_weighted(spark, d))


# --- profiles ------------------------------------------------------------------------------

@query("user_stats", "SELECT * FROM ustats")
def user_stats(spark, d):
    return profiles.user_stats(behaviour_events(spark, d))


@query("category_shares", "SELECT user_id, key, share, CAST(rank AS INT) AS rank FROM cats")
def category_shares(spark, d):
    return profiles.shares(_weighted(spark, d).withColumn("category", E.category_key()), "category")


@query("brand_shares", "SELECT user_id, key, share, CAST(rank AS INT) AS rank FROM brands")
def brand_shares(spark, d):
    return profiles.shares(_weighted(spark, d), "brand")


@query("recent_events", f"""SELECT user_id, CAST(rank AS INT) AS rank, item_id, event_type, strftime(timestamp, '%Y-%m-%d %H:%M') AS at FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY timestamp DESC, item_id, event_type, price) AS rank FROM ev)
    WHERE rank <= {config.RECENT_ITEMS}""")
def recent_events(spark, d):
    return profiles.recent(behaviour_events(spark, d))


@query("seen_items", "SELECT user_id, item_id FROM seen")
def seen_items(spark, d):
    return profiles.seen(_matrix(spark, d)).select("user_id", "item_id")


# --- catalog --------------------------------------------------------------------------------

@query("category_rollup", """SELECT root AS key, count(*) AS n_items, round(sum(popularity_score), 2) AS popularity,
    """ + TITLE.format("root") + """ AS label FROM items GROUP BY root""")
def category_rollup(spark, d):
    return catalog.category_labels(catalog.category_rollup(catalog.described_items(_weighted(spark, d))))


@query("catalog_indexes", """SELECT 'catalog:popular' AS index_name, row_number() OVER (ORDER BY popularity_score DESC,
      CAST(item_id AS VARCHAR) DESC) AS rank, item_id, popularity_score AS score FROM items
    UNION ALL SELECT 'catalog:category:' || root, row_number() OVER (PARTITION BY root ORDER BY popularity_score DESC,
      CAST(item_id AS VARCHAR) DESC), item_id, popularity_score FROM items""")
def catalog_indexes(spark, d):
    return keyed.ranked_indexes(catalog.described_items(_weighted(spark, d))).select("index_name", "rank", "item_id", "score")


@query("top_of_index", """SELECT item_id, popularity_score AS score, place AS rank FROM idx WHERE place BETWEEN 11 AND 40""")
def top_of_index(spark, d):
    indexes = keyed.ranked_indexes(catalog.described_items(_weighted(spark, d)))
    return keyed.top_of_index(indexes, "catalog:popular", 10, 30).select("item_id", "score", "rank")


@query("catalog_listing", f"""SELECT * FROM (SELECT {PUBLIC}, count(*) OVER () AS total,
      CAST(row_number() OVER (ORDER BY place) AS INT) AS position FROM idx WHERE root = 'standard'
      AND contains(lower({NAME} || ' ' || coalesce(category_code, '') || ' ' || CAST(item_id AS VARCHAR)), 'brand#1'))
    WHERE position BETWEEN 3 AND 26""")
def catalog_listing(spark, d):
    ws = workspace(spark, d)
    return listing.listing(ws.table("item_docs"), ws.table("trigram_postings"), "standard", "Brand#1", 2, 24) \
        .drop("has_embedding").withColumn("category_path", F.array_join("category_path", " > "))


@query("catalog_search", f"""SELECT item_id, name FROM (SELECT item_id, {NAME} AS name, lower({NAME} || ' ' || coalesce(category_code, '') || ' '
    || CAST(item_id AS VARCHAR)) AS hay FROM items) WHERE contains(hay, 'an') AND contains(hay, '7') AND contains(hay, 'brand#')""")
def catalog_search(spark, d):
    """Everything that holds three terms, two of them shorter than a trigram."""
    ws = workspace(spark, d)
    return listing.matching(ws.table("item_docs"), ws.table("trigram_postings"), query="7 an Brand#").select("item_id", "name")


# --- evaluation -------------------------------------------------------------------------------

@query("evaluable_truth", """SELECT user_id, item_id, user_id IN (SELECT user_id FROM ecold) AS cold FROM truth""")
def evaluable_truth(spark, d):
    train, test = I.split_pairs(workspace(spark, d).table("interaction_matrix"))
    users, truth = evaluation.evaluable(train, test)
    cold = evaluation.cold_by_train(users, train).withColumn("cold", F.lit(True))
    return truth.join(cold, "user_id", "left").withColumn("cold", F.coalesce("cold", F.lit(False)))


@query("popularity_baseline", "SELECT user_id, item_id, CAST(rank AS INT) AS rank FROM poprecs")
def popularity_baseline(spark, d):
    train, test = I.split_pairs(workspace(spark, d).table("interaction_matrix"))
    users, _ = evaluation.evaluable(train, test)
    return evaluation.popularity_baseline(I.decayed_popularity(train), users, train)


def _metric_sql(segment, model, recs, users, k):
    return f"""SELECT '{segment}' AS segment, '{model}' AS model, {k} AS k, CAST(count(*) AS INT) AS n_users,
      round(avg(hits / {k}), 6) AS precision, round(avg(hits / n_relevant), 6) AS recall,
      round(avg(CAST(hits > 0 AS DOUBLE)), 6) AS hit_rate,
      round((SELECT count(DISTINCT item_id) FROM {recs} WHERE rank <= {k} AND user_id IN (SELECT user_id FROM {users}))
        / (SELECT count(DISTINCT item_id) FROM train), 6) AS coverage
    FROM (SELECT t.user_id, count(*) AS n_relevant, count(r.item_id) AS hits FROM truth t
      LEFT JOIN (SELECT * FROM {recs} WHERE rank <= {k}) r ON r.user_id = t.user_id AND r.item_id = t.item_id
      WHERE t.user_id IN (SELECT user_id FROM {users}) GROUP BY t.user_id)"""


_RUNS = [("all", "popularity", "poprecs", "eusers"), ("cold_start", "popularity", "poprecs", "ecold"),
         ("cold_start", "content_tfidf", "econtent", "ecold")]


@query("ranking_metrics", " UNION ALL ".join(_metric_sql("all", "popularity", "poprecs", "eusers", k) for k in config.EVAL_KS))
def ranking_metrics(spark, d):
    train, test = I.split_pairs(workspace(spark, d).table("interaction_matrix"))
    users, truth = evaluation.evaluable(train, test)
    recs = evaluation.popularity_baseline(I.decayed_popularity(train), users, train)
    n_catalog = train.select("item_id").distinct().agg(F.count("*")).scalar()
    return _rounded_metrics(evaluation.ranking_metrics(recs, truth, n_catalog)
                            .withColumn("model", F.lit("popularity")))


def _rounded_metrics(df):
    return df.select("segment", "model", "k", "n_users", r6("precision"), r6("recall"), r6("hit_rate"), r6("coverage"))


@query("offline_evaluation", " UNION ALL ".join(_metric_sql(*run, k) for run in _RUNS for k in config.EVAL_KS))
def offline_evaluation(spark, d):
    ws = workspace(spark, d)
    return _rounded_metrics(evaluation.evaluate(ws.table("item_tfidf"), jobs.train_test(ws), stage=ws.stage))


# --- run figures and exploration ----------------------------------------------------------------

@query("event_mix", "SELECT event_type, count(*) AS events FROM events GROUP BY ALL")
def event_mix(spark, d):
    return metrics.event_mix(table(spark, d, "events"))


@query("events_per_hour", "SELECT strftime(ts, '%Y-%m-%d %H:00') AS hour, count(*) AS events FROM events GROUP BY ALL")
def events_per_hour(spark, d):
    return metrics.events_per_hour(table(spark, d, "events"), "ts")


@query("top_roots", """SELECT coalesce(split_part(category_code, '.', 1), 'other') AS root, count(*) AS events,
    count(*) FILTER (event_type = 'purchase') AS purchases FROM ev GROUP BY ALL ORDER BY events DESC, root LIMIT 10""")
def top_roots(spark, d):
    return metrics.top_roots(behaviour_events(spark, d))


@query("run_summary", """SELECT count(*) AS events, strftime(min(timestamp), '%Y-%m-%d %H:%M') AS start,
    strftime(max(timestamp), '%Y-%m-%d %H:%M') AS end, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items,
    (SELECT count(*) FROM mx) AS interaction_pairs, count(DISTINCT session_id) AS sessions,
    (SELECT count(*) FROM cold) AS cold_start_users, 3 AS cold_start_threshold,
    round((SELECT count(*) FROM mx) / (count(DISTINCT user_id) * count(DISTINCT item_id)), 6) AS matrix_density,
    round((SELECT count(DISTINCT item_id) FROM content) / count(DISTINCT item_id), 4) AS recommended_coverage FROM ev""")
def run_summary(spark, d):
    ws = workspace(spark, d)
    return metrics.run_summary(ws.table("events"), ws.table("interaction_matrix"), _content(spark, d).select("item_id").distinct())


@query("lake_summary", """SELECT count(*) AS events, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items,
    (SELECT count(*) FROM mx) AS pairs, round((SELECT count(*) FROM mx) / (count(DISTINCT user_id) * count(DISTINCT item_id)), 8) AS density FROM ev""")
def lake_summary(spark, d):
    return metrics.lake_summary(behaviour_events(spark, d)).withColumn("density", F.round("density", 8))


@query("null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM ev" for c in
    ("timestamp", "event_type", "item_id", "category_id", "category_code", "brand", "price", "user_id", "session_id")))
def null_counts(spark, d):
    return metrics.null_counts(behaviour_events(spark, d))


@query("volume_profile", """SELECT count(*) AS events, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ev)) AS duplicate_rows,
    count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items, round(count(*) / count(DISTINCT user_id), 6) AS events_per_user,
    round(count(*) / count(DISTINCT item_id), 6) AS events_per_item,
    round(1 - (SELECT count(*) FROM mx) / (count(DISTINCT user_id) * count(DISTINCT item_id)), 8) AS sparsity FROM ev""")
def volume_profile(spark, d):
    return metrics.volume(behaviour_events(spark, d)).select(
        "events", "duplicate_rows", "users", "items", r6("events_per_user"), r6("events_per_item"),
        F.round("sparsity", 8).alias("sparsity"))


@query("event_shares", """SELECT event_type, count(*) AS events, round(count(*) * 100 / (SELECT count(*) FROM ev), 6) AS pct FROM ev GROUP BY ALL""")
def event_shares(spark, d):
    return metrics.event_shares(behaviour_events(spark, d)).select("event_type", "events", r6("pct"))


def _activity_sql(key):
    return f"""SELECT count(*) AS keys, round(avg(n), 6) AS mean, round(stddev(n), 6) AS std, min(n) AS min,
      round(quantile_cont(n, 0.25), 6) AS p25, round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.75), 6) AS p75,
      max(n) AS max FROM (SELECT count(*) AS n FROM ev GROUP BY {key})"""


def _threshold_sql(key, thresholds):
    return " UNION ALL ".join(f"""SELECT {t} AS threshold, round(avg(CAST(n <= {t} AS DOUBLE)) * 100, 6) AS pct
      FROM (SELECT count(*) AS n FROM ev GROUP BY {key})""" for t in thresholds)


for _name, _key, _clip, _steps in (("user", "user_id", 50, (1, 2, 3, 5, 10)), ("item", "item_id", 50, ()),
                                   ("session", "session_id", 30, (1, 2, 3, 5))):
    @query(f"{_name}_activity", _activity_sql(_key))
    def _activity(spark, d, key=_key):
        return metrics.activity(behaviour_events(spark, d), key).select(
            "keys", r6("mean"), r6("std"), "min", r6("p25"), r6("p50"), r6("p75"), "max")

    @query(f"{_name}_activity_histogram", f"""SELECT least(n, {_clip}) AS events, count(*) AS keys
        FROM (SELECT count(*) AS n FROM ev GROUP BY {_key}) GROUP BY ALL""")
    def _histogram(spark, d, key=_key, clip=_clip):
        return metrics.clipped_histogram(behaviour_events(spark, d), key, clip)

    if _steps:
        @query(f"{_name}_activity_thresholds", _threshold_sql(_key, _steps))
        def _thresholds(spark, d, key=_key, steps=_steps):
            return metrics.share_up_to(behaviour_events(spark, d), key, steps).select("threshold", r6("pct"))

for _name, _key in (("top_items", "item_id"), ("top_categories", "category_code")):
    @query(_name, f"SELECT {_key}, count(*) AS events FROM ev WHERE {_key} IS NOT NULL GROUP BY ALL ORDER BY events DESC, {_key} LIMIT 10")
    def _busiest(spark, d, key=_key):
        return metrics.busiest(behaviour_events(spark, d), key)


@query("completeness", """SELECT round(avg(CAST(category_code IS NULL AS DOUBLE)) * 100, 6) AS no_category_pct,
    round(avg(CAST(brand IS NULL AS DOUBLE)) * 100, 6) AS no_brand_pct,
    round(avg(CAST(category_code IS NULL AND brand IS NULL AS DOUBLE)) * 100, 6) AS neither_pct FROM ev""")
def completeness(spark, d):
    return metrics.completeness(behaviour_events(spark, d)).select(
        r6("no_category_pct"), r6("no_brand_pct"), r6("neither_pct"))


@query("events_by_hour_of_day", "SELECT CAST(hour(timestamp) AS INT) AS hour, count(*) AS events FROM ev GROUP BY ALL")
def events_by_hour_of_day(spark, d):
    return metrics.by_hour_of_day(behaviour_events(spark, d))


@query("events_by_weekday", "SELECT dayname(timestamp) AS weekday, count(*) AS events FROM ev GROUP BY ALL")
def events_by_weekday(spark, d):
    return metrics.by_weekday(behaviour_events(spark, d))


# --- spot checks ----------------------------------------------------------------------------------

@query("cold_start_report", """SELECT user_id, overlap, round((SELECT avg(CAST(overlap <> '' AS DOUBLE)) FROM samplelap), 6)
    AS overlapping_share FROM samplelap""")
def cold_start_report(spark, d):
    recs = _content(spark, d)
    users = sanity.sample_users(recs.select("user_id").distinct())
    return sanity.cold_report(workspace(spark, d).table("events"), recs, users).select(
        "user_id", F.array_join("overlap", ",").alias("overlap"), r6("overlapping_share"))


@query("cold_start_history", f"""SELECT user_id, item_id, event_type, coalesce(code, 'cid:' || CAST(cid AS VARCHAR)) || ' | ' ||
    coalesce(basics.brand, '-') AS label FROM ev JOIN basics USING (item_id) WHERE user_id IN (SELECT user_id FROM sample)""")
def cold_start_history(spark, d):
    users = sanity.sample_users(_content(spark, d).select("user_id").distinct())
    return sanity.cold_history_rows(workspace(spark, d).table("events"), users)


@query("cold_start_recommended", f"""SELECT user_id, CAST(rank AS INT) AS rank, item_id, coalesce(code, 'cid:' || CAST(cid AS VARCHAR)) || ' | ' ||
    coalesce(basics.brand, '-') AS label, {settled('score', 6)} AS score, (user_id, code) IN (SELECT (user_id, code) FROM samplecodes) AND code IS NOT NULL
    AS known_category FROM content JOIN basics USING (item_id) WHERE rank <= 10 AND user_id IN (SELECT user_id FROM sample)""")
def cold_start_recommended(spark, d):
    users = sanity.sample_users(_content(spark, d).select("user_id").distinct())
    return sanity.recommended_rows(workspace(spark, d).table("events"), _content(spark, d), users).withColumn("score", r6("score"))


# --- embedding neighbours, routing ------------------------------------------------------------------

@query("vector_norms", """SELECT CAST(vec_id AS INT) AS item_id, round(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS norm,
    round(list_sum(list_transform(embedding, lambda x: round(CAST(x AS DOUBLE), 5))), 6) AS rounded_sum FROM embeddings""")
def vector_norms(spark, d):
    vectors = table(spark, d, "embeddings")
    rounded = V.round_vector(F.transform("embedding", lambda x: x.cast("double")))
    return vectors.select(F.col("vec_id").cast("int").alias("item_id"), r6(V.norm("embedding"), "norm"),
                          F.round(F.aggregate(rounded, F.lit(0.0), lambda acc, x: acc + x), 6).alias("rounded_sum"))


@query("embedding_neighbours", f"SELECT item_id, other_id, {settled('score', 4)} AS score, CAST(rank AS INT) AS rank FROM sim")
def embedding_neighbours(spark, d):
    ws = workspace(spark, d)
    return neighbours.similar_items(jobs.stored_vectors(ws, "item_id"), ws.table("item_features"), ws.table("interaction_matrix")) \
        .select("item_id", "other_id", "score", "rank")


@query("source_routing", "SELECT user_id, source, count(*) AS items, min(item_id) AS lowest FROM ctlists GROUP BY ALL")
def source_routing(spark, d):
    ws = workspace(spark, d)
    return routing.route(ws.table("popular_lists"), ws.table("content_lists")) \
        .select("user_id", "source", F.size("recommendations").cast("bigint").alias("items"),
                F.array_min(F.transform("recommendations", lambda r: r["item_id"])).alias("lowest"))


@query("users_by_source", "SELECT source, count(DISTINCT user_id) AS users FROM ctlists GROUP BY ALL")
def users_by_source(spark, d):
    return routing.users_by_source(workspace(spark, d).table("control_lists"))


@query("personas", """(SELECT user_id, segment, 'als' AS source, n_events, views, carts, purchases, key AS top_category FROM ustats
      LEFT JOIN (SELECT user_id, key FROM cats WHERE rank = 1) USING (user_id)
      WHERE segment = 'warm' AND user_id IN (SELECT user_id FROM ctlists WHERE source = 'als')
      ORDER BY purchases DESC, carts DESC, n_events DESC, user_id LIMIT 12)
    UNION ALL (SELECT user_id, segment, 'content', n_events, views, carts, purchases, key FROM ustats
      LEFT JOIN (SELECT user_id, key FROM cats WHERE rank = 1) USING (user_id)
      WHERE user_id IN (SELECT user_id FROM ctlists WHERE source = 'content') ORDER BY n_events DESC, carts DESC, user_id LIMIT 8)""")
def personas(spark, d):
    ws = workspace(spark, d)
    users = ws.table("user_docs").withColumn("top_category", F.col("categories")[0]["key"])
    return catalog.personas(users, ws.table("control_lists").select("user_id", "source"))


# --- re-ranker ------------------------------------------------------------------------------------------

@query("popular_in_category", f"""SELECT category_code AS category, item_id, CAST(rank AS INT) AS rank FROM incode WHERE rank <= {config.CATEGORY_CANDIDATES}
    UNION ALL SELECT CAST(category_id AS VARCHAR), item_id, CAST(rank AS INT) FROM inid WHERE rank <= {config.CATEGORY_CANDIDATES}""")
def popular_in_category(spark, d):
    items = workspace(spark, d).table("item_docs")
    part = lambda key: RC.popular_in_category(items, key).select(F.col(key).cast("string").alias("category"), "item_id", "rank")
    return part("category_code").unionByName(part("category_id"))


@query("complement_categories", """SELECT category AS category_code, CAST(rank AS INT) AS position, other AS category, score, users, kind, value FROM allcompl""")
def complement_categories(spark, d):
    ws = workspace(spark, d)
    items = ws.table("item_docs")
    codes = items.where(F.col("category_code").isNotNull()).select("category_code")
    rows = RC.complement_categories(codes, ws.table("category_complements"), items)
    return rows.select("category_code", F.posexplode("complements").alias("p", "c")) \
        .select("category_code", (F.col("p") + 1).alias("position"), "c.*")


@query("session_profile", "SELECT user_id, token, round(w, 6) AS weight FROM sprof")
def session_profile(spark, d):
    return RX.session_profiles(workspace(spark, d).table("session_items")).select("user_id", "token", r6("weight"))


@query("session_shares", """SELECT user_id, 'category' AS kind, key, round(share, 6) AS share FROM scats
    UNION ALL SELECT user_id, 'brand', key, round(share, 6) FROM sbrands""")
def session_shares(spark, d):
    rows = workspace(spark, d).table("session_items")
    part = lambda kind: RX.session_shares(rows, kind).select("user_id", F.lit(kind).alias("kind"), "key", r6("share"))
    return part("category").unionByName(part("brand"))


@query("root_shares", """SELECT request_id, root, round(share, 6) AS share FROM req JOIN vroots USING (user_id)""")
def root_shares(spark, d):
    return workspace(spark, d).table("prepared_requests").select("request_id", F.explode("root_shares").alias("root", "share")).select("request_id", "root", r6("share"))


@query("reference_price", "SELECT request_id, round(ref, 6) AS reference_price FROM refprice")
def reference_price(spark, d):
    return workspace(spark, d).table("prepared_requests").select("request_id", r6("reference_price"))


@query("copurchase_scores", "SELECT request_id, item_id, score FROM copur")
def copurchase_scores(spark, d):
    return workspace(spark, d).table("prepared_requests").select("request_id", F.explode("copurchase").alias("item_id", "score"))


def _rerank_tables(ws):
    return ws.table("prepared_requests"), ws.table("item_docs"), ws.table("popular_head").select("item_id"), ws.table("known_blocks")


@query("rerank_candidates", "SELECT request_id, item_id, source FROM cand")
def rerank_candidates(spark, d):
    ws = workspace(spark, d)
    return RF.candidate_items(*_rerank_tables(ws)).select("request_id", "item_id", "source")


_FACTOR_COLUMNS = ("context", "complement", "copurchase", "content", "session", "category", "price", "brand", "popularity")


def _with_factors(ws):
    return RF.with_factors(*_rerank_tables(ws))


@query("rerank_factors", f"SELECT request_id, item_id, {settled('als_raw', 6)} AS als_raw, {settled('least(coalesce(als_raw, 0.0), 1.0)', 6)} AS als, "
       + ", ".join(f"round({c}, 6) AS {c}" for c in _FACTOR_COLUMNS) + " FROM fac")
def rerank_factors(spark, d):
    return _with_factors(workspace(spark, d)).select("request_id", "item_id", r6("als_raw"), r6("als"), *[r6(c) for c in _FACTOR_COLUMNS])


def _explained_sql(profile, product):
    value = lambda name: "least(coalesce(als_raw, 0.0), 1.0)" if name == "als" else name
    part = lambda name, weight: f"CAST({weight} AS DOUBLE) * {value(name)} / final"
    return " UNION ALL ".join(
        f"SELECT request_id, item_id, '{name}' AS key, '{label}' AS label, CAST({weight} AS DOUBLE) AS weight, "
        f"{settled(f'round({value(name)}, 10)', 4)} AS value, "
        f"CASE WHEN final <> 0 THEN {settled(f'round({part(name, weight)}, 10)', 4)} ELSE 0.0 END AS contribution "
        f"FROM placed WHERE {product}product" for name, (label, weight) in profile.items())


@query("rerank_scores", "SELECT request_id, item_id, score FROM scored")
def rerank_scores(spark, d):
    return RF.with_scores(_with_factors(workspace(spark, d))).select("request_id", "item_id", "score")


@query("rerank_explanations", _explained_sql(config.RANKING_PROFILES["product"], "") + " UNION ALL "
       + _explained_sql(config.RANKING_PROFILES["home"], "NOT "))
def rerank_explanations(spark, d):
    shown = RF.explained(RV.diversify(RF.with_scores(_with_factors(workspace(spark, d)))))
    return shown.select("request_id", "item_id", F.explode("factors").alias("f")).select(
        "request_id", "item_id", "f.key", "f.label", "f.weight", "f.value", "f.contribution")


@query("reranked", f"""SELECT request_id, CAST(position AS INT) AS position, item_id, source, score,
    CAST(j AS INT) AS same_category_before, round(pow(dec, j), 4) AS multiplier, CAST(round(CAST(adj AS DECIMAL(24, 12)), 4) AS DOUBLE) AS rank_score,
    {settled('als_raw', 4)} AS als_prediction FROM placed""")
def reranked(spark, d):
    return RF.explained(RV.diversify(RF.with_scores(_with_factors(workspace(spark, d))))).select(
        "request_id", "position", "item_id", "source", "score", "same_category_before", "multiplier", "rank_score", "als_prediction")


@query("strategies", "SELECT user_id, coalesce(any_value(source), 'none') AS strategy, count(item_id) AS precomputed_count FROM counts LEFT JOIN ctlists USING (user_id) GROUP BY user_id")
def strategies(spark, d):
    ws = workspace(spark, d)
    return views.strategies(ws.table("user_docs"), ws.table("control_lists")) \
        .select("user_id", "strategy", F.col("precomputed_count").cast("bigint").alias("precomputed_count"))


@query("rank_changes", """SELECT a.request_id, count(*) FILTER (b.item_id IS DISTINCT FROM a.item_id) AS changed FROM placed a
    LEFT JOIN (SELECT replace(request_id, 'product:', 'home:') AS request_id, position, item_id FROM placed WHERE request_id LIKE 'product:%') b
      USING (request_id, position) WHERE a.request_id LIKE 'home:%' GROUP BY ALL""")
def rank_changes(spark, d):
    """Home pages against the product pages the same users saw just before."""
    placed = RV.diversify(RF.with_scores(_with_factors(workspace(spark, d)))).select("request_id", "position", "item_id")
    product = placed.where(F.col("request_id").startswith("product:")) \
        .withColumn("request_id", F.replace("request_id", F.lit("product:"), F.lit("home:")))
    return RV.changed_positions(product, placed.where(F.col("request_id").startswith("home:")))


@query("item_details", f"""SELECT i.item_id, {NAME} AS name, (SELECT count(*) FROM tokw t WHERE t.item_id = i.item_id) AS tokens,
    coalesce(len(v.v), 0) AS embedding_dims, coalesce(s.n, 0) AS n_similar, coalesce(s.best, -1) AS best_similar,
    coalesce(a.n, 0) AS n_also, coalesce(a.best, -1) AS best_also, a.name AS best_also_name, coalesce(c.n, 0) AS n_complements
    FROM items i LEFT JOIN vec v ON v.id = i.item_id
    LEFT JOIN (SELECT item_id, count(*) AS n, arg_min(other_id, rank) AS best FROM sim GROUP BY ALL) s ON s.item_id = i.item_id
    LEFT JOIN (SELECT also.item_id, count(*) AS n, arg_min(other_id, rank) AS best, arg_min({NAME}, rank) AS name FROM also
      JOIN items o ON o.item_id = also.other_id GROUP BY ALL) a ON a.item_id = i.item_id
    LEFT JOIN (SELECT category, count(*) AS n FROM allcompl GROUP BY ALL) c ON c.category = i.category_code""")
def item_details(spark, d):
    ws = workspace(spark, d)
    items = ws.table("item_docs")
    related = RC.complement_categories(items.where(F.col("category_code").isNotNull()).select("category_code"),
                                       ws.table("category_complements"), items)
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint")
    best = lambda c: F.coalesce(F.col(c)[0]["item_id"], F.lit(-1))
    return views.item_details(items, related).select(
        "item_id", "name", size("tokens").alias("tokens"), F.col("embedding_dims").cast("bigint").alias("embedding_dims"),
        size("similar").alias("n_similar"), best("similar").alias("best_similar"), size("also").alias("n_also"),
        best("also").alias("best_also"), F.col("also")[0]["item"]["name"].alias("best_also_name"),
        size("complements").alias("n_complements"))


@query("user_details", f"""SELECT u.user_id, true AS known, coalesce(c.strategy, 'none') AS strategy, coalesce(c.n, 0) AS precomputed_count,
    u.n_events, u.segment, u.avg_price, (SELECT count(*) FROM topprofile t WHERE t.user_id = u.user_id) AS profile_tokens,
    coalesce(len(v.v), 0) AS embedding_dims, least(u.n_events, {config.RECENT_ITEMS}) AS n_recent, l.n AS n_session, l.name AS newest_name
    FROM ustats u LEFT JOIN vec v ON v.id = u.user_id
    LEFT JOIN (SELECT user_id, any_value(source) AS strategy, count(*) AS n FROM ctlists GROUP BY ALL) c ON c.user_id = u.user_id
    LEFT JOIN (SELECT user_id, count(*) AS n, arg_min({NAME}, pos) AS name FROM live JOIN items USING (item_id) GROUP BY ALL) l ON l.user_id = u.user_id""")
def user_details(spark, d):
    ws = workspace(spark, d)
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint")
    return views.user_details(ws.table("user_docs"), ws.table("control_lists"), ws.table("sessions"), ws.table("item_docs")).select(
        "user_id", "known", "strategy", F.col("precomputed_count").cast("bigint").alias("precomputed_count"),
        "profile.n_events", "profile.segment", "profile.avg_price", size("profile_tokens").alias("profile_tokens"),
        F.col("embedding_dims").cast("bigint").alias("embedding_dims"), size("recent").alias("n_recent"),
        size("session").alias("n_session"), F.col("session")[0]["item"]["name"].alias("newest_name"))


# --- sources, sinks, exports -------------------------------------------------------------------------

_CONTRACT_SQL = """SELECT strftime(timestamp, '%Y-%m-%d %H:%M') AS at, event_type, item_id, category_id, category_code, brand,
    round(price, 8) AS price, user_id, session_id FROM ev"""


def _contract_view(df):
    return df.select(E.minute_text(F.try_to_timestamp(F.col("timestamp").cast("string"))).alias("at"), "event_type", "item_id", "category_id",
                     "category_code", "brand", F.round("price", 8).alias("price"), "user_id", "session_id")


@query("csv_source", _CONTRACT_SQL)
def csv_source(spark, d):
    ws = workspace(spark, d)
    path = _fresh(ws, "events_csv")
    ws.table("events").write.option("header", True).csv(path)
    return _contract_view(contract.read_csv(spark, path))


@query("wire_messages", _CONTRACT_SQL)
def wire_messages(spark, d):
    return _contract_view(contract.from_messages(contract.to_messages(behaviour_events(spark, d))))


def _raw_shop_rows(spark, d):
    """The driver's event table under the field names of the public shop data set."""
    return table(spark, d, "events").select(
        F.col("ts").cast("string").alias("event_time"), "event_type", F.get_json_object("props", "$.k").alias("product_id"),
        F.lit(None).cast("bigint").alias("category_id"), F.lit(None).cast("string").alias("category_code"),
        F.lit(None).cast("string").alias("brand"), F.col("value").alias("price"), "user_id",
        F.md5(F.col("user_id").cast("string")).alias("user_session"))


_RAW_SHOP_SQL = """(SELECT ts, event_type, CAST(json_extract_string(props, '$.k') AS INT) AS item_id, value AS price, CAST(user_id AS INT) AS user_id,
    CASE WHEN ts IS NULL THEN 'missing timestamp' WHEN event_type IS NULL THEN 'missing event_type'
      WHEN json_extract_string(props, '$.k') IS NULL THEN 'missing item_id' WHEN value IS NULL THEN 'missing price'
      WHEN user_id IS NULL THEN 'missing user_id'
      WHEN event_type NOT IN ('view', 'cart', 'purchase', 'remove_from_cart') THEN 'unknown event_type'
      WHEN NOT value > 0 THEN 'price not positive' END AS reason FROM events)"""


@query("clean_events", f"""SELECT strftime(ts, '%Y-%m-%d %H:%M') AS at, event_type, item_id, round(price, 6) AS price, user_id
    FROM {_RAW_SHOP_SQL} WHERE reason IS NULL""")
def clean_events(spark, d):
    valid, _ = contract.clean(_raw_shop_rows(spark, d))
    return valid.select(E.minute_text("timestamp").alias("at"), "event_type", "item_id", r6("price"), "user_id")


@query("rejected_events", f"SELECT reason, event_type, count(*) AS events FROM {_RAW_SHOP_SQL} WHERE reason IS NOT NULL GROUP BY ALL")
def rejected_events(spark, d):
    _, rejected = contract.clean(_raw_shop_rows(spark, d))
    return rejected.groupBy("reason", "event_type").agg(F.count("*").alias("events"))


_PATH_SQL = "'year=' || strftime(timestamp, '%Y') || '/month=' || strftime(timestamp, '%m') || '/day=' || strftime(timestamp, '%d')"


@query("partition_paths", f"SELECT {_PATH_SQL} AS path, count(*) AS events FROM ev GROUP BY ALL")
def partition_paths(spark, d):
    return behaviour_events(spark, d).groupBy(lake.partition_path().alias("path")).agg(F.count("*").alias("events"))


_LAKE_SQL = """SELECT CAST(year(timestamp) AS INT) AS year, CAST(month(timestamp) AS INT) AS month, CAST(day(timestamp) AS INT) AS day,
    event_type, count(*) AS events, round(sum(price), 2) AS price FROM ev GROUP BY ALL"""


def _lake_view(df):
    return df.groupBy("year", "month", "day", "event_type").agg(F.count("*").alias("events"), F.round(F.sum("price"), 2).alias("price"))


@query("lake_scan", _LAKE_SQL)
def lake_scan(spark, d):
    ws = workspace(spark, d)
    path = _fresh(ws, "lake")
    lake.write(behaviour_events(spark, d), path)
    return _lake_view(lake.read(spark, path))


def _wire_folder(ws):
    return ws.folder("wire", lambda path: contract.to_messages(ws.table("events")).select("value").write.text(path))


def _fresh(ws, name):
    """A new folder per call: a stream's checkpoint belongs to one run, and nothing that is read is overwritten."""
    return ws.fresh(name)


@query("stream_to_lake", _LAKE_SQL)
def stream_to_lake(spark, d):
    ws = workspace(spark, d)
    run = _fresh(ws, "stream_lake")
    ingest.to_lake(ingest.file_messages(spark, _wire_folder(ws), 4), f"{run}/lake", f"{run}/checkpoint", available_now=True) \
        .awaitTermination()
    return _lake_view(lake.read(spark, f"{run}/lake"))


def _broken_folder(ws):
    """Messages of the click table: other event types, no item, no price, and lines that are no message."""
    raw = table(ws.spark, ws.source, "events")
    fields = {"timestamp": F.col("ts").cast("string"), "event_type": F.col("event_type"),
              "item_id": F.when(F.col("event_id") % 5 != 0, F.get_json_object("props", "$.k").cast("int")),
              "price": F.when(F.col("event_id") % 7 != 0, F.col("value")).otherwise(-F.col("value")), "user_id": F.col("user_id").cast("int"),
              "session_id": F.concat(F.lit("s"), F.col("user_id").cast("string"))}
    text = F.when(F.col("event_id") % 11 == 0, F.lit("no message")).otherwise(F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])))
    return ws.folder("broken_wire", lambda path: raw.select(text.alias("value")).write.text(path))


_BROKEN_SQL = """(SELECT *, CASE WHEN event_id % 11 = 0 THEN 'unreadable message' WHEN event_type IS NULL THEN 'missing event_type'
    WHEN event_id % 5 = 0 OR json_extract_string(props, '$.k') IS NULL THEN 'missing item_id' WHEN value IS NULL THEN 'missing price'
    WHEN user_id IS NULL THEN 'missing user_id' WHEN event_type NOT IN ('purchase', 'cart', 'view', 'remove_from_cart') THEN 'unknown event_type'
    WHEN NOT (CASE WHEN event_id % 7 <> 0 THEN value ELSE -value END > 0) THEN 'price not positive' END AS reason FROM events)"""


@query("stream_rejects", f"""SELECT coalesce(reason, 'in the lake') AS reason, count(*) AS messages FROM {_BROKEN_SQL} GROUP BY ALL""")
def stream_rejects(spark, d):
    """Where each message of a stream went: into the lake, or to the dead letters with a reason."""
    ws = workspace(spark, d)
    run = _fresh(ws, "stream_rejects")
    ingest.to_lake(ingest.file_messages(spark, _broken_folder(ws), 4), f"{run}/lake", f"{run}/checkpoint", True, f"{run}/rejects").awaitTermination()
    taken = lake.read(spark, f"{run}/lake").select(F.lit("in the lake").alias("reason"))
    return taken.unionByName(ingest.dead_letters(spark, f"{run}/rejects").select("reason")).groupBy("reason").agg(F.count("*").alias("messages"))


_LIVE_SQL = "SELECT user_id, CAST(pos AS INT) AS position, item_id, event_type, strftime(timestamp, '%Y-%m-%d %H:%M') AS at FROM live"


@query("live_sessions", _LIVE_SQL)
def live_sessions(spark, d):
    return SS.last_sessions(behaviour_events(spark, d)).select(
        "user_id", "position", "item_id", "event_type", E.minute_text("timestamp").alias("at"))


def _session_changes(ws, sink, run):
    events = ingest.typed(ingest.decoded(ingest.file_messages(ws.spark, _wire_folder(ws))))
    SS.start(SS.session_stream(events), sink, f"{run}/checkpoint", availableNow=True).awaitTermination()


@query("session_stream", _LIVE_SQL)
def session_stream(spark, d):
    """Each user's session as of the user's newest event, before it expired."""
    ws = workspace(spark, d)
    run = _fresh(ws, "session_stream")
    _session_changes(ws, SS.write_changes(f"{run}/changes"), run)
    changes = spark.read.schema(SS.OUTPUT).parquet(f"{run}/changes").where(F.col("position") >= 0)
    return SS.latest_version(changes).select("user_id", "position", "item_id", "event_type", E.minute_text("timestamp").alias("at"))


@query("session_feature_stream", "SELECT user_id, token, round(w, 6) AS weight FROM sprof")
def session_feature_stream(spark, d):
    ws = workspace(spark, d)
    run = _fresh(ws, "session_features")
    items = ws.table("item_docs")
    _session_changes(ws, SF.feature_batch(items, ws.table("popular_head").select("item_id"), run), run)
    with_session = spark.read.parquet(f"{run}/features").where(F.col("session").isNotNull())
    newest = with_session.groupBy("user_id").agg(F.max("version").alias("version"))
    return with_session.join(newest, ["user_id", "version"], "left_semi") \
        .select("user_id", F.explode("session_profile").alias("token", "w")).select("user_id", "token", r6("w", "weight"))


@query("recommendation_documents", """SELECT 'recommendations:' || CAST(user_id AS VARCHAR) AS key, CAST(rank AS INT) AS position, item_id, source
    FROM ctlists""")
def recommendation_documents(spark, d):
    docs = keyed.recommendation_documents(workspace(spark, d).table("control_lists"))
    decoded = F.from_json("value", "array<struct<item_id:int,score:double,source:string>>")
    return docs.select("key", F.posexplode(decoded).alias("p", "r")) \
        .select("key", (F.col("p") + 1).alias("position"), "r.item_id", "r.source")


@query("content_list_scores", """SELECT 'recommendations:' || CAST(user_id AS VARCHAR) AS key, item_id,
    round(CAST(CAST(score AS FLOAT) AS DOUBLE), 6) AS score FROM content""")
def content_list_scores(spark, d):
    lists = workspace(spark, d).table("content_lists").withColumn("source", F.lit("content"))
    decoded = F.from_json("value", "array<struct<item_id:int,score:double,source:string>>")
    return keyed.recommendation_documents(lists).select("key", F.explode(decoded).alias("r")) \
        .select("key", "r.item_id", "r.score")


@query("item_documents", """SELECT 'item:' || CAST(item_id AS VARCHAR) AS key, item_id, category_code, category_id, price, views, unique_users,
    popularity_score, (SELECT count(*) FROM tokw t WHERE t.item_id = items.item_id) AS tokens FROM items""")
def item_documents(spark, d):
    ws = workspace(spark, d)
    path = _fresh(ws, "item_documents")
    documents.write(keyed.documents(ws.table("item_docs"), "item", "item_id"), path)
    docs = documents.read(spark, path)
    return keyed.get(docs, docs.select("key"), ws.table("item_docs").schema).select(
        "key", "item_id", "category_code", "category_id", "price", "views", "unique_users", "popularity_score",
        F.size("tokens").cast("bigint").alias("tokens"))


@query("user_documents", """SELECT 'user:' || CAST(user_id AS VARCHAR) AS key, n_events, avg_price, segment, last_seen,
    (SELECT count(*) FROM seen WHERE seen.user_id = u.user_id) AS seen, (SELECT count(*) FROM cats c WHERE c.user_id = u.user_id) AS categories,
    (SELECT count(*) FROM topprofile t WHERE t.user_id = u.user_id) AS profile FROM ustats u""")
def user_documents(spark, d):
    ws = workspace(spark, d)
    docs = ws.stage(keyed.documents(ws.table("user_docs"), "user", "user_id"), "user_documents")
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint").alias(c)
    return keyed.get(docs, docs.select("key"), ws.table("user_docs").schema).select(
        "key", "n_events", "avg_price", "segment", "last_seen", size("seen"), size("categories"), size("profile"))


_EXPERIMENT_SQL = """(SELECT CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS item_id,
    CASE WHEN CAST('0x' || substr(sha256(CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 50 THEN 'control' ELSE 'treatment' END AS variant,
    CASE event_type WHEN 'view' THEN 'impression' WHEN 'purchase' THEN 'conversion' ELSE event_type END AS event_type FROM events)"""


@query("experiment_events", f"""SELECT user_id, item_id, variant, event_type, count(*) AS events FROM {_EXPERIMENT_SQL}
    WHERE event_type IN ('impression', 'click', 'conversion') AND item_id IS NOT NULL GROUP BY ALL""")
def experiment_events(spark, d):
    ws = workspace(spark, d)
    raw = table(spark, d, "events")
    named = F.create_map(F.lit("view"), F.lit("impression"), F.lit("purchase"), F.lit("conversion"))
    rows = raw.select(F.col("user_id").cast("string").alias("user_id"), F.get_json_object("props", "$.k").alias("item_id"),
                      variant(F.col("user_id")).alias("variant"), F.coalesce(named[F.col("event_type")], "event_type").alias("event_type"))
    path = _fresh(ws, "experiment_events")
    experiments.append_events(rows, path)
    return spark.read.parquet(path).groupBy("user_id", "item_id", "variant", "event_type").agg(F.count("*").alias("events"))


@query("evaluation_report", " UNION ALL ".join(_metric_sql(*run, k) for run in _RUNS for k in config.EVAL_KS))
def evaluation_report(spark, d):
    ws = workspace(spark, d)
    measured = evaluation.evaluate(ws.table("item_tfidf"), jobs.train_test(ws), stage=ws.stage)
    path = _fresh(ws, "evaluation_metrics")
    lake.overwrite(evaluation.stamped(measured), path)
    return _rounded_metrics(evaluation.latest_report(spark, path))


def _settings_sql():
    shown = {**{f"weight {k}": v for k, v in (("purchase", 5), ("cart", 3), ("view", 1), ("remove_from_cart", 0))},
             "half_life_days": 14, "top_n": 20, "candidate_pool": 2000, "als rank": 20, "als maxIter": 15, "als regParam": 0.1}
    return " UNION ALL ".join(f"SELECT '{k}' AS setting, '{v}' AS value" for k, v in shown.items())


@query("run_settings", _settings_sql() + " UNION ALL SELECT 'events', CAST(count(*) AS VARCHAR) FROM ev")
def run_settings(spark, d):
    """What a run was made with, one setting a row."""
    ws = workspace(spark, d)
    run = metrics.run_settings(metrics.run_summary(ws.table("events"), ws.table("interaction_matrix")))
    weights = F.transform(F.map_entries("event_weights"), lambda e: F.struct(F.concat(F.lit("weight "), e["key"]).alias("setting"), e["value"].cast("string").alias("value")))
    fit = F.filter(F.transform(F.map_entries("als"), lambda e: F.struct(F.concat(F.lit("als "), e["key"]).alias("setting"), e["value"].alias("value"))),
                   lambda e: e["setting"].isin("als rank", "als maxIter", "als regParam"))
    single = F.array(*[F.struct(F.lit(c).alias("setting"), F.col(c).cast("string").alias("value"))
                       for c in ("half_life_days", "top_n", "candidate_pool", "events")])
    return run.select(F.explode(F.concat(weights, fit, single)).alias("s")).select("s.setting", "s.value")


# --- factor model (results depend on floating point: rows only) -----------------------------------------

@query("als_top_n")
def als_top_n(spark, d):
    return factorization.exploded(workspace(spark, d).table("als_lists"))


@query("als_prediction_summary")
def als_prediction_summary(spark, d):
    ws = workspace(spark, d)
    return factorization.prediction_summary(factorization.predictions(ws.model("als"), jobs.train_test(ws)[1]))


@query("als_unseen_recommendations")
def als_unseen_recommendations(spark, d):
    ws = workspace(spark, d)
    train, test = jobs.train_test(ws)
    users, _ = evaluation.evaluable(train, test)
    return factorization.unseen_recommendations(ws.model("als"), users, train, max(config.EVAL_KS))


@query("als_evaluation")
def als_evaluation(spark, d):
    ws = workspace(spark, d)
    return evaluation.evaluate(ws.table("item_tfidf"), jobs.train_test(ws), ws.model("als"), stage=ws.stage)


@query("als_neighbours")
def als_neighbours(spark, d):
    ws = workspace(spark, d)
    return neighbours.similar_items(factorization.item_factors(ws.model("als")), ws.table("item_features"), ws.table("interaction_matrix"))


@query("als_routed_lists")
def als_routed_lists(spark, d):
    return workspace(spark, d).table("routed_lists").select("user_id", "source", F.size("recommendations").alias("items"))


MISS = 0.02  # of the right side; factors are stored as floats and the solver stops at a relative error


@query("als_invariants", """SELECT 'users with factors' AS fact, count(DISTINCT user_id) AS value FROM train
    UNION ALL SELECT 'items with factors', count(DISTINCT item_id) FROM train
    UNION ALL SELECT 'users off their equations', 0 UNION ALL SELECT 'saved factors that differ', 0
    UNION ALL SELECT 'listed items', count(DISTINCT user_id) * least(20, count(DISTINCT item_id)) FROM train
    UNION ALL SELECT 'listed items out of order', 0
    UNION ALL SELECT 'unseen items', CAST(sum(least(20, (SELECT count(DISTINCT item_id) FROM train) - n)) AS BIGINT) FROM
      (SELECT user_id, count(*) AS n FROM train WHERE user_id IN (SELECT user_id FROM eusers) GROUP BY user_id)
    UNION ALL SELECT 'unseen items that are known', 0
    UNION ALL SELECT 'predicted pairs', count(*) FROM test WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)
    UNION ALL SELECT 'identical predictions', 0
    UNION ALL SELECT 'routed users', count(*) FROM (SELECT user_id FROM train UNION SELECT user_id FROM content)
    UNION ALL SELECT 'neighbours with a score outside 0 to 1', 0
    UNION ALL SELECT 'sampled users', least(5, count(*)) FROM counts WHERE n >= 10""")
def als_invariants(spark, d):
    """Facts that hold for every right fit and every right list, whatever the floats."""
    ws = workspace(spark, d)
    model, (train, test) = ws.model("als"), jobs.train_test(ws)
    users, _ = evaluation.evaluable(train, test)
    listed, unseen = factorization.exploded(ws.table("als_lists")), ws.stage(factorization.unseen_recommendations(model, users, train, config.TOP_N), "unseen")
    by_rank = Window.partitionBy("user_id").orderBy("rank")
    falls = lambda df: df.withColumn("before", F.lag("score").over(by_rank)).where(F.col("before") < F.col("score"))
    reloaded = factorization.load(ws.path("models/als"))
    near = neighbours.similar_items(factorization.item_factors(model), ws.table("item_features"), ws.table("interaction_matrix"))
    facts = {
        "users with factors": factorization.user_factors(model), "items with factors": factorization.item_factors(model),
        "users off their equations": factorization.normal_equations(model, train).where(F.col("miss") > MISS),
        "saved factors that differ": factorization.item_factors(reloaded).exceptAll(factorization.item_factors(model)),
        "listed items": listed, "listed items out of order": falls(listed), "unseen items": unseen,
        "unseen items that are known": unseen.join(train, ["user_id", "item_id"], "left_semi"),
        "predicted pairs": factorization.predictions(model, test),
        "identical predictions": factorization.prediction_summary(factorization.predictions(model, test)).where("identical"),
        "routed users": ws.table("routed_lists"), "neighbours with a score outside 0 to 1": near.where(~F.col("score").between(0, 1)),
        "sampled users": sanity.sample_users(sanity.active_users(ws.table("events")))}
    rows = [df.agg(F.count("*").alias("value")).select(F.lit(fact).alias("fact"), "value") for fact, df in facts.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


@query("als_reranked")
def als_reranked(spark, d):
    """The re-ranker served by the fitted model: its factors in items and users, its lists, its neighbours."""
    ws = workspace(spark, d)
    values = RF.with_factors(ws.table("als_prepared_requests"), ws.table("als_item_docs"), ws.table("popular_head").select("item_id"), ws.table("known_blocks"))
    return RF.explained(RV.diversify(RF.with_scores(values))).select(
        "request_id", "position", "item_id", "source", "score", "same_category_before", "multiplier", "rank_score", "als_prediction")


@query("als_reranked_facts", """SELECT 'requests' AS fact, count(*) AS value FROM req UNION ALL SELECT 'places beyond the limit', 0
    UNION ALL SELECT 'known items shown', 0 UNION ALL SELECT 'rows out of order', 0
    UNION ALL SELECT 'predictions of users without factors', 0 UNION ALL SELECT 'requests without any prediction', count(*) FROM req
      WHERE user_id NOT IN (SELECT user_id FROM train)""")
def als_reranked_facts(spark, d):
    """What holds for every page, whatever the model's floats."""
    ws = workspace(spark, d)
    shown = ws.stage(als_reranked(spark, d), "als_reranked").join(ws.table("requests").select("request_id", "user_id", "limit"), "request_id")
    by_place = Window.partitionBy("request_id").orderBy("position")
    fitted = factorization.user_factors(ws.model("als")).select("user_id")
    facts = {
        "requests": shown.select("request_id").distinct(), "places beyond the limit": shown.where(F.col("position") > F.col("limit")),
        "known items shown": shown.join(ws.table("interaction_matrix"), ["user_id", "item_id"], "left_semi"),
        "rows out of order": shown.withColumn("before", F.lag("rank_score").over(by_place)).where(F.col("before") < F.col("rank_score")),
        "predictions of users without factors": shown.where(F.col("als_prediction").isNotNull()).join(fitted, "user_id", "left_anti"),
        "requests without any prediction": shown.groupBy("request_id").agg(F.max("als_prediction").alias("p")).where(F.col("p").isNull())}
    rows = [df.agg(F.count("*").alias("value")).select(F.lit(fact).alias("fact"), "value") for fact, df in facts.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


@query("als_sanity_report")
def als_sanity_report(spark, d):
    ws = workspace(spark, d)
    events = ws.table("events")
    users = sanity.sample_users(sanity.active_users(events))
    lists = factorization.exploded(factorization.top_n(ws.model("als"), 10, users))
    return sanity.factor_report(events, lists, users)
