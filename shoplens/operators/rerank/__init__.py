"""Hybrid re-ranking of candidates for many requests at once."""

from pyspark.sql import functions as F

from shoplens import config
from shoplens.operators.catalog import popular_head
from shoplens.operators.ranking import head_list
from shoplens.operators.rerank.candidates import with_candidates
from shoplens.operators.rerank.context import request_rows, session_docs, session_rows
from shoplens.operators.rerank.factors import VIEWER, explained, with_factors, with_scores
from shoplens.operators.rerank.variety import diversify


def prepared_requests(requests, items, users, lists, sessions, complements, head):
    """Requests with what scoring needs of viewer and context, and with candidates, in one row each.

    ``sessions`` are session documents. The lists that candidates come from are not written again with them.
    """
    popular = head_list(head, ["place"], config.POPULAR_CANDIDATES, "item_id")
    rows = with_candidates(request_rows(requests, items, users, lists, sessions, complements), popular)
    shown = F.when(F.col("context").isNotNull(), F.struct("context.tokens")).alias("context")
    return rows.select("user_id", "context_item_id", *VIEWER, "strategy", shown, "context_norm", "seen", "candidates")


def rerank(requests, items, users, lists, sessions, complements, stage=lambda df, name: df, known=None):
    """(request_id, position, item_id, source, score, factors, ...) for every request.

    requests     request_id, user_id, context_item_id (null: home page), limit
    items        item documents            users     user documents
    lists        user_id, recommendations, source
    sessions     user_id, position (0 = newest), item_id, event_type
    complements  category, rank, other, score, users
    known        history blocks (profiles.known_blocks) of users with more items than their document lists
    ``stage`` may write a frame that is read twice to the shared folder and read it back.
    """
    head = stage(popular_head(items), "head")
    hot_items = head.select("item_id")
    live = session_docs(stage(session_rows(sessions, items, hot_items), "session_rows"))
    rows = stage(prepared_requests(requests, items, users, lists, live, complements, head), "requests")
    return explained(diversify(with_scores(with_factors(rows, items, hot_items, known))))
