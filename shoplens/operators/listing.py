"""Listing and search over the whole catalog: trigram postings, and pages by key."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens.operators.catalog import by_popularity, popularity, public_view

GRAM, BLOCK_ITEMS = 3, 4096
_END = "\x00"


def haystack():
    """What a term is looked for in: name, category and id of a public item row, in lower case."""
    return F.lower(F.concat_ws(" ", "name", F.coalesce("category_code", F.lit("")), F.col("item_id").cast("string")))


def _grams(text):
    """All different runs of three characters; two closing marks make every character the start of one."""
    padded = F.concat(text, F.lit(_END * (GRAM - 1)))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(padded, i, F.lit(GRAM))))


def trigram_postings(items, block_items=BLOCK_ITEMS):
    """(gram, block, items): the ids of the items whose haystack has a trigram, in sorted blocks.

    Items are dealt to blocks by a hash of their id, as many blocks as keep one at about ``block_items``; so the list of
    a trigram that every item has is as many rows, and terms are matched block by block.
    """
    blocks = F.ceil(items.agg(F.count("*") / block_items).scalar())
    rows = public_view(items).where(F.length(haystack()) > 0).select("item_id", F.explode(_grams(haystack())).alias("gram"))
    block = F.pmod(F.xxhash64("item_id"), F.greatest(blocks, F.lit(1)))
    return rows.groupBy("gram", block.alias("block")).agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def terms_of(query):
    return sorted(set((query or "").lower().split()))


def candidates(postings, query):
    """(item_id): items that may hold all terms of ``query``; null if the query has none.

    A term of three and more characters needs all its trigrams, a shorter one any trigram that starts with it. Each is
    one need; a block's items are those in the lists of all needs.
    """
    needs = []
    for term in terms_of(query):
        grams = sorted({term[i:i + GRAM] for i in range(len(term) - GRAM + 1)})
        needs += [F.col("gram") == g for g in grams] or [F.startswith("gram", F.lit(term))]
    if not needs:
        return None
    tagged = postings.select("block", "items", F.explode(F.array_compact(F.array(
        *[F.when(need, F.lit(i)) for i, need in enumerate(needs)]))).alias("need"))
    lists = tagged.groupBy("block", "need").agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    blocks = lists.groupBy("block").agg(F.collect_list("items").alias("lists")).where(F.size("lists") == len(needs))
    both = F.aggregate(F.slice("lists", 2, len(needs)), F.col("lists")[0], F.array_intersect)
    return blocks.select(F.explode(both).alias("item_id"))


def matching(items, postings, category=None, query=None):
    """Public rows of all items of a category (any: None) that hold every blank-separated term in name, category or id."""
    near = candidates(postings, query)
    rows = public_view(items if near is None else items.join(near, "item_id", "left_semi"))
    if category is not None:
        rows = rows.where(F.col("category_root") == category)
    for term in terms_of(query):
        rows = rows.where(F.contains(haystack(), F.lit(term)))
    return rows


def page(rows, limit, after=None):
    """The next ``limit`` rows in popularity order after the key (popularity_score, item_id) of the last row shown.

    However far a reader has come, a page is one filter and one bounded top-k.
    """
    if after is not None:
        score, last = F.lit(float(after[0])), F.lit(str(after[1]))
        own = F.col("item_id").cast("string")
        rows = rows.where((popularity() < score) | ((popularity() == score) & (own < last)))
    return rows.orderBy(*by_popularity()).limit(limit)


def listing(items, postings, category=None, query=None, offset=0, limit=24):
    """One page by number of rows before it, with each row's position and the total of the listing.

    The total is a count over everything that matches. The page is cut from the first offset + limit rows; to go deep,
    use ``page`` with the key of the last row.
    """
    rows = matching(items, postings, category, query)
    head = rows.orderBy(*by_popularity()).limit(offset + limit)
    placed = head.withColumn("position", F.row_number().over(Window.orderBy(*by_popularity())))
    return placed.where(F.col("position") > offset).withColumn("total", rows.agg(F.count("*")).scalar())
