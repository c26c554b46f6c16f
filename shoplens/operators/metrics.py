"""Figures about a run and about the lake."""

from pyspark.sql import functions as F

from shoplens import config
from shoplens.functions import events as E


def _one(df, expression):
    return df.agg(expression).scalar()


def event_mix(events):
    return events.groupBy("event_type").agg(F.count("*").alias("events"))


def events_per_hour(events, timestamp="timestamp"):
    return events.groupBy(E.hour_text(F.col(timestamp)).alias("hour")).agg(F.count("*").alias("events"))


def top_roots(events, k=10):
    return events.groupBy(E.root_category().alias("root")).agg(
        F.count("*").alias("events"), E.count_type("purchase").alias("purchases")) \
        .orderBy(F.desc("events"), "root").limit(k)


def run_summary(events, matrix, recommended=None):
    """One row of totals from one scan of the events.

    An event counts for three keys, its user, item and session, each with a mark of its kind. Grouping by kind and key
    (partly before anything moves) leaves every key once; counting them by kind gives all distinct counts, and the
    users' numbers of events are there for the cold ones.
    """
    key = lambda kind, id_, name: F.struct(F.lit(kind).alias("kind"), id_.cast("long").alias("id"), name.cast("string").alias("name"))
    nothing, (user, item, session) = F.lit(None), range(3)
    marked = events.select("timestamp", F.explode(F.array(
        key(user, F.col("user_id"), nothing), key(item, F.col("item_id"), nothing), key(session, nothing, F.col("session_id")))).alias("k"))
    once = marked.groupBy("k.kind", "k.id", "k.name").agg(F.count("*").alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    kind = lambda which: (F.col("kind") == which) & (F.col("id").isNotNull() | F.col("name").isNotNull())
    base = once.agg(
        F.coalesce(F.sum(F.when(F.col("kind") == user, F.col("n"))), F.lit(0)).alias("events"), E.minute_text(F.min("first")).alias("start"),
        E.minute_text(F.max("last")).alias("end"), F.count_if(kind(user)).alias("users"), F.count_if(kind(item)).alias("items"),
        F.count_if(kind(session)).alias("sessions"),
        F.count_if(kind(user) & (F.col("n") <= config.COLD_START_MAX_EVENTS)).alias("cold_start_users"))
    row = base.select("*", _one(matrix, F.count("*")).alias("interaction_pairs"),
                      F.lit(config.COLD_START_MAX_EVENTS).alias("cold_start_threshold"))
    row = row.withColumn("matrix_density", F.round(
        F.col("interaction_pairs") / F.greatest(F.col("users") * F.col("items"), F.lit(1)), 6))
    if recommended is None:
        return row
    return row.withColumn("recommended_coverage", F.round(
        _one(recommended, F.count("*")) / F.greatest(F.col("items"), F.lit(1)), 4))


def run_settings(run):
    """The summary row with the settings it was made with."""
    shown = {**config.EVENT_WEIGHTS}
    return run.withColumns({
        "event_weights": F.create_map(*[F.lit(x) for pair in shown.items() for x in pair]),
        "half_life_days": F.lit(config.DECAY_HALF_LIFE_DAYS), "top_n": F.lit(config.TOP_N),
        "candidate_pool": F.lit(config.CANDIDATE_POOL),
        "als": F.create_map(*[F.lit(str(x)) for pair in config.ALS_PARAMS.items() for x in pair])})


def lake_summary(events):
    users = _one(events.select("user_id").distinct(), F.count("*"))
    items = _one(events.select("item_id").distinct(), F.count("*"))
    pairs = _one(events.select("user_id", "item_id").distinct(), F.count("*"))
    return events.agg(F.count("*").alias("events")).select(
        "events", users.alias("users"), items.alias("items"), pairs.alias("pairs")) \
        .withColumn("density", F.try_divide("pairs", F.col("users") * F.col("items")))


def null_counts(events):
    """(column, nulls): one pass, one row per column."""
    counted = events.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in events.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in events.columns])
    return counted.select(F.explode(pairs).alias("x")).select("x.*")


# --- exploratory profile -------------------------------------------------------

def volume(events):
    """Rows, repeated rows, distinct users and items, averages and matrix sparsity."""
    distinct_rows = _one(events.distinct(), F.count("*"))
    return lake_summary(events).select(
        "events", (F.col("events") - distinct_rows).alias("duplicate_rows"), "users", "items",
        (F.col("events") / F.col("users")).alias("events_per_user"),
        (F.col("events") / F.col("items")).alias("events_per_item"), (1 - F.col("density")).alias("sparsity"))


def event_shares(events):
    total = _one(events, F.count("*"))
    return event_mix(events).withColumn("pct", F.col("events") * 100 / total)


def activity(events, key):
    """Distribution of the number of events per key."""
    sizes = events.groupBy(key).agg(F.count("*").alias("n"))
    parts = F.percentile("n", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return sizes.agg(F.count("*").alias("keys"), F.avg("n").alias("mean"), F.stddev("n").alias("std"),
                     F.min("n").alias("min"), parts.alias("q"), F.max("n").alias("max")) \
        .select("keys", "mean", "std", "min", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"),
                F.col("q")[2].alias("p75"), "max")


def share_up_to(events, key, thresholds):
    """(threshold, pct): percent of keys with at most that many events."""
    sizes = events.groupBy(key).agg(F.count("*").alias("n"))
    averages = sizes.agg(*[(F.avg((F.col("n") <= t).cast("double")) * 100).alias(f"t{t}") for t in thresholds])
    lines = F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"t{t}").alias("pct")) for t in thresholds])
    return averages.select(F.explode(lines).alias("x")).select("x.*")


def clipped_histogram(events, key, upper):
    """(events, keys): keys by number of events, everything above ``upper`` in the last bin."""
    sizes = events.groupBy(key).agg(F.count("*").alias("n"))
    return sizes.groupBy(F.least("n", F.lit(upper)).alias("events")).agg(F.count("*").alias("keys"))


def busiest(events, key, k=10):
    return events.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("events")) \
        .orderBy(F.desc("events"), key).limit(k)


def completeness(events):
    no_code, no_brand = F.col("category_code").isNull(), F.col("brand").isNull()
    pct = lambda condition: F.avg(condition.cast("double")) * 100
    return events.agg(pct(no_code).alias("no_category_pct"), pct(no_brand).alias("no_brand_pct"),
                      pct(no_code & no_brand).alias("neither_pct"))


def by_hour_of_day(events, timestamp="timestamp"):
    return events.groupBy(F.hour(timestamp).alias("hour")).agg(F.count("*").alias("events"))


def by_weekday(events, timestamp="timestamp"):
    return events.groupBy(F.date_format(timestamp, "EEEE").alias("weekday")).agg(F.count("*").alias("events"))
