"""Mixing sources to target weights by histograms of a hash, with nested thresholds and no sort of the documents."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens.llm.common import staged
from shoplens.operators.ordered import numbered

WEIGHTS = (5, 2, 1)  # by place of the source in code-point order, repeating
MOST_COPIES = 3
HASH_BITS, LEVEL_BITS = 60, 12
WORD = r"[^\x20\x09-\x0D]+"


def _hash(doc_id, text):
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("long")


def measured(docs, id_col="doc_id", text_col="text", source_col="source"):
    """(doc_id, source, size, hash): what the choice needs of every document, without its text.

    A null text has size 0; a null id or source stays null. The hash is over id and whole text, so rows that repeat
    an id with another text are chosen on their own.
    """
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    size = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")
    return docs.select(doc_id.alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"),
                       _hash(doc_id, text).alias("hash"))


def source_targets(sizes, weights=WEIGHTS, most=MOST_COPIES):
    """(source, source_size, target) for `sizes` (source, source_size); sources in code-point order, null last.

    All sizes together are shared by weight. What a source is given beyond `most` times its size goes to the others by
    weight, until nobody is above: the share of one unit of weight only grows, so each round is one aggregate over
    the table of sources that finds the sources full at the present share. The table has a row per source and stays a
    table; the driver sees three numbers a round.
    """
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = staged(numbered(sizes, [F.asc_nulls_last("source")], name="place")
                    .select("source", "source_size", cycle.cast("long").alias("weight")), "sources")
    cap = F.lit(most) * F.col("source_size")
    total, units = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    if total is None:
        return ranked.select("source", "source_size", F.lit(0.0).alias("target"))
    share, full_before = total / units, 0
    while True:
        full, held, held_units = ranked.where(F.col("weight") * F.lit(share) > cap).agg(
            F.count("*"), F.coalesce(F.sum(cap), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
        if full == full_before or held_units == units:
            break
        share, full_before = (total - held) / (units - held_units), full
    return ranked.select("source", "source_size",
                         F.least(F.col("weight") * F.lit(share), cap.cast("double")).alias("target"))


def _boundary(histogram, left, keys, bucket):
    """The bucket in which a running sum passes `left`, for each of `keys`: (keys, bucket, left within it, its sum).

    A window runs over the buckets of one key, never over documents.
    """
    until = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = histogram.withColumn("_until", F.sum("words").over(until))
    return (running.where((F.col("_until") > F.col(left)) & (F.col("_until") - F.col("words") <= F.col(left)))
            .withColumn(left, F.col(left) - (F.col("_until") - F.col("words"))).drop("_until"))


def thresholds(sized, targets):
    """(source, source_size, target, copies, edge, left, words): how each source is taken; `sized` as from `measured`.

    A document below the hash `edge` is taken once more than `copies` times. Documents at the edge share what is then
    `left` of the budget. Histograms of words by source and the upper bits of the hash give the bucket where the budget
    ends; only that bucket's documents are looked at again, by the next bits, then by whole hash.
    """
    budget = F.floor(F.col("target") + 0.5).cast("long")
    budgets = targets.where(F.col("source_size") > 0).select(
        "source", "source_size", "target", F.expr("floor(target + 0.5) div source_size").cast("int").alias("copies"),
        F.pmod(budget, F.col("source_size")).alias("left"))
    match = lambda a, b: a.join(b.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    upper = lambda bits: F.shiftright("hash", HASH_BITS - bits)

    first = sized.groupBy("source", upper(LEVEL_BITS).alias("bucket")).agg(F.sum("size").alias("words"))
    found = staged(_boundary(match(first, budgets.select("source", "left")), "left", ["source"], "bucket")
                   .select("source", "bucket", "left"), "boundary")
    inside = staged(match(sized, found).where(upper(LEVEL_BITS) == F.col("bucket")).select("source", "size", "hash", "left"), "edge")
    # the same again with twice the bits, over what one bucket in 4096 holds
    second = inside.groupBy("source", "left", upper(2 * LEVEL_BITS).alias("bucket")).agg(F.sum("size").alias("words"))
    found = staged(_boundary(second, "left", ["source"], "bucket").select("source", "bucket", "left"), "boundary")
    third = match(inside.drop("left"), found).where(upper(2 * LEVEL_BITS) == F.col("bucket")).groupBy(
        "source", "left", "hash").agg(F.sum("size").alias("words"))
    edges = _boundary(third, "left", ["source"], "hash").select("source", F.col("hash").alias("edge"), "left", "words")
    return staged(match(budgets.drop("left"), edges), "thresholds")


def mix(docs, weights=WEIGHTS, most=MOST_COPIES, **columns):
    """Per document: doc_id, size, source_size, target (of its source), taken (words the mix takes, repeats counted).

    Every document of a source is taken as often as its budget (the target, rounded to whole words) holds the source;
    of the rest, documents are taken once more in the order of a hash, up to a threshold. Documents whose hash is the
    threshold give their first words, in proportion to their size, so a source meets its budget to a word (to fewer words
    than there are identical rows at the threshold). Budgets are nested: a larger one takes the same documents and more.
    Repeated rows are documents of their own. Documents without words, and sources that have no others, take nothing
    (their target is 0). An empty table gives an empty table. Other columns are ignored.
    """
    sized = staged(measured(docs, **columns), "sizes")
    targets = staged(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "targets")
    plan = thresholds(sized, targets).select(F.col("source").alias("_source"), "copies", "edge", "left", "words")
    extra = F.when(F.col("hash") < F.col("edge"), F.col("size")).when(F.col("hash") == F.col("edge"), F.expr(
        "cast(left as decimal(19, 0)) * cast(size as decimal(19, 0)) div cast(words as decimal(19, 0))")).otherwise(F.lit(0))
    totals = targets.join(plan, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        F.col("source").alias("_source"), "source_size", "target", "copies", "edge", "left", "words")
    return sized.join(totals, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "source_size", "target", "hash",
        F.coalesce(F.col("copies") * F.col("size") + extra, F.lit(0)).cast("long").alias("taken"))


def mixture(docs, weights=WEIGHTS, most=MOST_COPIES, id_col="doc_id", text_col="text", source_col="source"):
    """The mixed corpus: a row (doc_id, source, copy, text) per copy; a document's last copy may end after some words.

    Texts meet the decision by source and the hash of id and text. Rows that are equal in all of these have equal
    decisions, of which one is joined. Documents without words give no row.
    """
    decided = mix(docs, weights, most, id_col=id_col, text_col=text_col, source_col=source_col).where(F.col("taken") > 0)
    decided = decided.select(F.col("hash").alias("_hash"), F.col("source").alias("_source"), "size", "taken").distinct()
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                      F.col(text_col).cast("string").alias("text"))
    rows = own.join(decided, (_hash(F.col("doc_id"), F.col("text")) == F.col("_hash"))
                    & F.col("source").eqNullSafe(F.col("_source")))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))))
    words = F.least(F.col("size"), F.col("taken") - (F.col("copy") - 1) * F.col("size")).cast("int")
    head = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0)), F.lit(1), words), "")
    return rows.select("doc_id", "source", "copy", F.when(words < F.col("size"), head).otherwise(F.col("text")).alias("text"))


ORACLE = r"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h FROM documents),
  s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
      CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS BIGINT) AS w FROM d GROUP BY source),
  o AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS units,
      sum(3 * source_size) OVER before - 3 * source_size AS held, sum(w) OVER before - w AS held_units FROM s
      WINDOW before AS (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
  share AS (SELECT min_by(share, held_units) AS share FROM (SELECT *, CAST(total - held AS DOUBLE) / CAST(units - held_units AS DOUBLE) AS share FROM o)
      WHERE w * share <= 3 * source_size),
  t AS (SELECT source, source_size, least(w * share, CAST(3 * source_size AS DOUBLE)) AS target FROM s, share),
  b AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget FROM t WHERE source_size > 0),
  e AS (SELECT source, h, words, sum(words) OVER (PARTITION BY source ORDER BY h) - words AS ahead FROM
      (SELECT source, h, CAST(sum(size) AS BIGINT) AS words FROM d GROUP BY ALL)),
  p AS (SELECT b.source, budget // source_size AS copies, h AS edge, budget % source_size - ahead AS rest, words FROM b
      JOIN e ON e.source IS NOT DISTINCT FROM b.source AND ahead <= budget % source_size AND ahead + words > budget % source_size)
SELECT doc_id, size, t.source_size, t.target, CAST(coalesce(copies * size + CASE WHEN h < edge THEN size
    WHEN h = edge THEN CAST(rest AS HUGEINT) * size // words ELSE 0 END, 0) AS BIGINT) AS taken
FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source LEFT JOIN p ON p.source IS NOT DISTINCT FROM d.source"""
