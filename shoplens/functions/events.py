"""Column expressions over one event or one item."""

from pyspark.sql import functions as F

from shoplens import config


def event_weight(event_type="event_type"):
    """Batch weight: a type outside the contract counts nothing."""
    known = F.create_map(*[F.lit(x) for pair in config.EVENT_WEIGHTS.items() for x in pair])
    return F.coalesce(known[F.col(event_type)], F.lit(0))


def session_weight(event_type):
    """Live-session weight: a type outside the contract still counts as one click."""
    known = F.create_map(*[F.lit(x) for pair in config.EVENT_WEIGHTS.items() for x in pair])
    return F.coalesce(known[event_type], F.lit(1))


def decay_factor(anchor, timestamp="timestamp", half_life=config.DECAY_HALF_LIFE_DAYS):
    return F.pow(F.lit(0.5), F.datediff(anchor, F.col(timestamp)) / F.lit(half_life))


def category_key(code="category_code", category_id="category_id"):
    return F.coalesce(F.col(code), F.concat(F.lit("cid:"), F.col(category_id).cast("string")))


def path_root(path):
    return F.split_part(path, F.lit("."), F.lit(1))


def root_category(code="category_code"):
    return F.coalesce(path_root(F.col(code)), F.lit("other"))


def category_prefixes(code="category_code"):
    """'a.b.c' -> [cat:a, cat:a.b, cat:a.b.c]; null -> []."""
    parts = F.split(F.col(code), "[.]")
    prefix = lambda n: F.concat(F.lit("cat:"), F.array_join(F.slice(parts, F.lit(1), n), "."))
    return F.when(F.col(code).isNotNull(), F.transform(F.sequence(F.lit(1), F.size(parts)), prefix)) \
        .otherwise(F.array().cast("array<string>"))


def item_tokens(code="category_code", category_id="category_id", brand="brand"):
    """Every descriptive token of an item, without repeats and without nulls."""
    tagged = F.array(F.concat(F.lit("cid:"), F.col(category_id).cast("string")),
                     F.concat(F.lit("brand:"), F.col(brand)))
    return F.array_distinct(F.array_compact(F.concat(category_prefixes(code), tagged)))


def minute_text(timestamp):
    return F.date_format(timestamp, "yyyy-MM-dd HH:mm")


def hour_text(timestamp):
    return F.date_format(timestamp, "yyyy-MM-dd HH:00")


def segment(n_events="n_events"):
    return F.when(F.col(n_events) <= config.COLD_START_MAX_EVENTS, "cold_start").otherwise("warm")


def count_type(event_type):
    return F.count_if(F.col("event_type") == event_type)


def hash_percent(text, digest):
    """0..99 from the first 32 bits of a hex digest: the same on any partitioning."""
    return F.conv(F.substring(digest(text), 1, 8), 16, 10).cast("bigint") % 100
