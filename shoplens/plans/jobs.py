"""The batch jobs: what is built from what. Each entry gives the frame its table is written from."""

from pyspark.sql import functions as F

from shoplens import config
from shoplens.operators import (catalog, complements, content, evaluation, factorization, interactions as I,
                                items as IT, listing, profiles, rerank, routing)
from shoplens.operators.ranking import ranked_list
from shoplens.operators.rerank.context import session_docs, session_rows
from shoplens.operators.skew import split_join
from shoplens.sources.tables import behaviour_events, table
from shoplens.streaming.sessions import last_sessions

JOBS, MODELS = {}, {}


def job(build):
    JOBS[build.__name__] = build
    return build


def model(build):
    MODELS[build.__name__] = build
    return build


@job
def events(ws):
    return behaviour_events(ws.spark, ws.source)


def weighted(ws):
    return I.weigh(ws.table("events"))


@job
def interaction_matrix(ws):
    return I.matrix_of(ws.table("events"))


@job
def item_features(ws):
    return I.item_features(weighted(ws))


@job
def item_tfidf(ws):
    return IT.item_tfidf(ws.table("events"))


@job
def content_recommendations(ws):
    history = content.cold_history(ws.table("events"), ws.table("interaction_matrix"))
    return content.recommend(history, ws.table("item_tfidf"), ws.table("item_features"))


@job
def content_lists(ws):
    return content.as_lists(ws.table("content_recommendations"))


@job
def train_pairs(ws):
    return I.split_pairs(ws.table("interaction_matrix"))[0]


@job
def test_pairs(ws):
    return I.split_pairs(ws.table("interaction_matrix"))[1]


def train_test(ws):
    """Both sides as written: every reader would hash all pairs again, and there are up to ten in a plan."""
    return ws.table("train_pairs"), ws.table("test_pairs")


@model
def als(ws, path):
    """Fitted on the train part, saved, and served from the saved copy."""
    factorization.save(factorization.train(train_test(ws)[0]), path)
    return factorization.load(path)


@job
def als_lists(ws):
    return factorization.top_n(ws.model("als"))


@job
def popular_lists(ws):
    """Popularity lists in the factor model's shape: what the A/B control group is shown."""
    train, test = train_test(ws)
    users, _ = evaluation.evaluable(train, test)
    popularity = I.decayed_popularity(train)
    ranked = evaluation.popularity_baseline(popularity, users, train, config.TOP_N)
    # nearly all lists name the same few items
    scored = split_join(ranked, popularity, "item_id", evaluation.head_items(popularity, config.TOP_N))
    return ranked_list(scored, "user_id", [F.col("item_id"), F.col("popularity_score").cast("float").alias("rating")],
                       "recommendations")


@job
def routed_lists(ws):
    return routing.route(ws.table("als_lists"), ws.table("content_lists"))


@job
def control_lists(ws):
    """As routed_lists, with popularity in the place of the factor model: the same on every engine."""
    return routing.route(ws.table("popular_lists"), ws.table("content_lists"))


@job
def category_complements(ws):
    return complements.category_complements(weighted(ws))


def stored_vectors(ws, key):
    """The vectors that come with the data, as factors of the item or user of the same number."""
    return table(ws.spark, ws.source, "embeddings").select(
        F.col("vec_id").cast("int").alias(key), F.col("embedding").alias("factors"))


@job
def item_docs(ws):
    return catalog.item_docs(weighted(ws), ws.table("interaction_matrix"), ws.table("item_tfidf"),
                             stored_vectors(ws, "item_id"), ws.stage)


@job
def user_docs(ws):
    factors = stored_vectors(ws, "user_id").withColumn("factors", F.transform(
        "factors", lambda x: F.round(x.cast("double"), 5)))
    return profiles.user_docs(weighted(ws), ws.table("interaction_matrix"), ws.table("item_tfidf"), factors, ws.stage)


@job
def als_item_docs(ws):
    """As item_docs, with the fitted model's factors and the neighbours in its space."""
    return catalog.item_docs(weighted(ws), ws.table("interaction_matrix"), ws.table("item_tfidf"),
                             factorization.item_factors(ws.model("als")), ws.stage)


@job
def als_user_docs(ws):
    rounded = factorization.user_factors(ws.model("als")).withColumn("factors", F.transform("factors", lambda x: F.round(x.cast("double"), 5)))
    return profiles.user_docs(weighted(ws), ws.table("interaction_matrix"), ws.table("item_tfidf"), rounded, ws.stage)


@job
def als_prepared_requests(ws):
    """As prepared_requests, served by the fitted model: its documents, and its lists where content has none."""
    live = session_docs(session_rows(ws.table("sessions"), ws.table("als_item_docs"), ws.table("popular_head").select("item_id")))
    return rerank.prepared_requests(ws.table("requests"), ws.table("als_item_docs"), ws.table("als_user_docs"), ws.table("routed_lists"),
                                    ws.stage(live, "als_session_features"), ws.table("category_complements"), ws.table("popular_head"))


@job
def sessions(ws):
    return last_sessions(ws.table("events"))


@job
def popular_head(ws):
    return catalog.popular_head(ws.table("item_docs"))


@job
def trigram_postings(ws):
    return listing.trigram_postings(ws.table("item_docs"))


@job
def known_blocks(ws):
    return profiles.known_blocks(ws.table("interaction_matrix"))


@job
def session_items(ws):
    return session_rows(ws.table("sessions"), ws.table("item_docs"), ws.table("popular_head").select("item_id"))


@job
def session_features(ws):
    return session_docs(ws.table("session_items"))


@job
def requests(ws):
    """Every user asks for the home page, and for the page of the item of the newest event."""
    newest = profiles.recent(ws.table("events"), 1).select("user_id", "item_id")
    row = lambda kind, item: newest.select(
        F.concat(F.lit(f"{kind}:"), F.col("user_id").cast("string")).alias("request_id"), "user_id",
        item.cast("int").alias("context_item_id"), F.lit(12).alias("limit"))
    return row("home", F.lit(None)).unionByName(row("product", F.col("item_id")))


@job
def prepared_requests(ws):
    return rerank.prepared_requests(*[ws.table(name) for name in (
        "requests", "item_docs", "user_docs", "control_lists", "session_features", "category_complements", "popular_head")])
