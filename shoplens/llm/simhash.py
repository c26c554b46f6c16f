"""SimHash fingerprints and their search, in DataFrame expressions only.

Terms are pairs of neighbouring words (maximal runs of letters and digits, lower case). Every occurrence votes on
64 signed bits with the bits of its hash; its weight is the length of the term in characters, so that long and
therefore telling words count more than short ones. A bit is set where the votes for it are more than half.
"""

from itertools import combinations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens.llm.common import id_and_text, staged, tasks

BITS = 64
LANES = 0x0000000100000001  # two bits of a hash at once: one vote counter in each half of a long
RADIUS, BLOCKS = 3, 6
COARSE = 64  # quantile ranges that ids are cut into before they are cut evenly


def _terms(text):
    """All terms of a text, in order, as an array of (x, y); y is null in the only term of a one-word text."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.when(F.size(words) > 1, F.arrays_zip(F.slice(words, 1, F.size(words) - 1).alias("x"),
                                                  F.slice(words, 2, F.size(words) - 1).alias("y"))).when(
        F.size(words) == 1, F.arrays_zip(words.alias("x"), F.array(F.lit(None).cast("string")).alias("y")))


def fingerprints(docs, key, text="text"):
    """One row per distinct key: (key columns, fp long). Rows of one key must have the same text.

    Votes are summed in the task that reads the text, so what is shuffled is one row of counters per document.
    A null text and a text without words have the fingerprint 0.
    """
    rows = docs.select(*key, F.explode_outer(_terms(F.col(text))).alias("_t")).select(
        *key, F.xxhash64("_t.x", "_t.y").alias("_h"),
        (F.coalesce(F.length("_t.x"), F.lit(0)) + F.coalesce(F.length("_t.y"), F.lit(0))).cast("long").alias("_w"))
    votes = [F.sum(F.shiftrightunsigned("_h", i).bitwiseAND(F.lit(LANES)) * F.col("_w")).alias(f"_v{i}")
             for i in range(BITS // 2)]
    half = F.col("_total") / 2
    low = [F.when(F.col(f"_v{i}").bitwiseAND(F.lit(0xFFFFFFFF)) > half, F.lit(1 << i)).otherwise(F.lit(0))
           for i in range(32)]
    high = [F.when(F.shiftrightunsigned(f"_v{i}", 32) > half,
                   F.lit((1 << (i + 32)) - (1 << 64 if i == 31 else 0))).otherwise(F.lit(0)) for i in range(32)]
    fp = F.lit(0).cast("long")
    for bit in low + high:
        fp = fp.bitwiseOR(bit.cast("long"))
    return rows.groupBy(*key).agg(*votes, F.sum("_w").alias("_total")).select(*key, fp.alias("fp"))


def hexed(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def likeness(a, b):
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def near(fps, targets, radius=RADIUS, blocks=BLOCKS):
    """All (fp, other) with other from `targets`, other != fp, within `radius` bits. Both inputs: distinct column fp.

    The 64 bits are cut into `blocks` blocks. Two fingerprints within the radius agree in at least
    blocks - radius whole blocks, so each choice of that many blocks is one permuted table that is keyed by those
    blocks, and an equality join on each table finds every pair. A pair is given by the first table it meets in.
    """
    width = [BITS * i // blocks for i in range(blocks + 1)]
    kept = list(combinations(range(blocks), blocks - radius))
    masks = [sum(((1 << (width[b + 1] - width[b])) - 1) << width[b] for b in choice) for choice in kept]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]

    def tables(df, name):
        keys = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
                         for i, m in enumerate(signed)])
        return df.select(F.col("fp").alias(name), F.explode(keys).alias("e")).select(name, "e.t", "e.k")

    differs = F.col("fp").bitwiseXOR(F.col("other"))
    first = F.lit(len(signed))
    for i in reversed(range(len(signed))):
        first = F.when(differs.bitwiseAND(F.lit(signed[i])) == 0, F.lit(i)).otherwise(first)
    return (tables(fps, "fp").join(tables(targets, "other"), ["t", "k"])
            .where((F.bit_count(differs) <= radius) & (differs != 0) & (first == F.col("t"))).select("fp", "other"))


def with_next(docs):
    """Each row with the row after it by (doc_id, text), and after the last the first.

    Gives (bucket, place, row, doc_id, text, next_row, next_text); (bucket, place) is unique, `row` is a hash of
    id and text. Rows are cut into buckets of neighbouring ids: coarse bounds are quantiles of the ids, and each
    coarse range is cut evenly, so that a clustered id column spreads as well. Inside a bucket the next row is a
    window. The last row of a bucket takes the first of the next bucket from a table with one row per bucket,
    which is joined in place. Null ids come first.
    """
    rows = id_and_text(docs)
    fine = max(1, tasks(docs.sparkSession) * 4 // COARSE)
    # at most COARSE + 1 numbers come to the driver
    q = rows.agg(F.percentile_approx("doc_id", [i / COARSE for i in range(COARSE + 1)], 10000)).first()[0] or [0]
    bounds = F.array(*[F.lit(x).cast("long") for x in sorted(set(q))])
    at = F.greatest(F.lit(1), F.size(F.filter(bounds, lambda x: x <= F.col("doc_id"))))
    low, high = F.get(bounds, at - 1), F.coalesce(F.get(bounds, at), F.element_at(bounds, -1) + 1)
    inner = F.floor((F.col("doc_id") - low) / (high - low) * fine)
    bucket = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(
        at * fine + F.least(F.greatest(inner, F.lit(0)), F.lit(fine - 1))).cast("long")
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").asc_nulls_first(), "text")
    inside = (rows.withColumn("bucket", bucket).withColumn("row", F.xxhash64("doc_id", "text"))
              .select("*", F.row_number().over(order).alias("place"), F.lead("row").over(order).alias("next_row"),
                      F.lead("text").over(order).alias("next_text")))
    first = rows.select("doc_id").groupBy(bucket.alias("bucket")).agg(F.min("doc_id").alias("first_id"))
    line = Window.orderBy("bucket")  # one short row per bucket
    first = first.select(F.coalesce(F.lag("bucket").over(line), F.last("bucket").over(
        line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("bucket"), "first_id")
    # one short row per bucket, of which there are at most COARSE + 1 times `fine`
    heads = (rows.join(F.broadcast(first), F.col("doc_id").eqNullSafe(F.col("first_id"))).groupBy("bucket")
             .agg(F.min("text").alias("head_text"), F.first("first_id").alias("head_id")))
    is_last = F.col("next_row").isNull()
    return inside.alias("i").join(heads.alias("h"), (F.col("i.bucket") == F.col("h.bucket")) & is_last, "left").select(
        "i.bucket", "place", "row", "doc_id", "text",
        F.when(is_last, F.xxhash64("head_id", "head_text")).otherwise(F.col("next_row")).alias("next_row"),
        F.when(is_last, F.col("head_text")).otherwise(F.col("next_text")).alias("next_text"))


def edited(text="text", following="next_text"):
    """The text whose last floor(n/2) code points are replaced by the first as many (or all) of the following."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substr(F.col(text), F.lit(1), n - half), F.substr(F.col(following), F.lit(1), half))


def edit_report(docs, radius=RADIUS, every=20):
    """Fingerprint of each text, of its edited text and of the next document's, and how alike they are.

    Rows whose id is divisible by `every` also get `n_near`: how many other distinct fingerprints of the table
    lie within `radius` bits. Null texts are empty, texts without words have fingerprint 0, repeated rows stay.
    """
    rows = id_and_text(docs).select(F.xxhash64("doc_id", "text").alias("row"), F.col("text").alias("body"))
    own = staged(fingerprints(rows, ["row"], "body"), "fingerprints")
    line = with_next(docs).select("bucket", "place", "row", "doc_id", "next_row",
                                  F.length("text").cast("long").alias("n_chars"), edited().alias("edited"))
    keys = ["bucket", "place", "row", "doc_id", "next_row", "n_chars", "edited_sha256"]
    after = fingerprints(line.withColumn("edited_sha256", F.sha2("edited", 256)), keys, "edited")
    found = (after.withColumnRenamed("fp", "edited_fp").join(own.withColumnRenamed("fp", "own_fp"), "row")
             .join(own.select(F.col("row").alias("next_row"), F.col("fp").alias("next_fp")), "next_row"))
    found = staged(found.select("doc_id", "n_chars", "edited_sha256", "own_fp", "edited_fp", "next_fp"), "edited")
    asked = F.col("doc_id") % every == 0
    wanted = found.where(asked).select(F.col("own_fp").alias("fp")).distinct()
    counts = (near(wanted, own.select("fp").distinct(), radius).groupBy("fp").agg(F.count("*").alias("n")))
    return found.join(counts.withColumnRenamed("fp", "own_fp"), "own_fp", "left").select(
        "doc_id", "n_chars", "edited_sha256", hexed("own_fp").alias("fingerprint"),
        hexed("edited_fp").alias("edited_fingerprint"), likeness(F.col("own_fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("own_fp"), F.col("next_fp")).alias("near_next"),
        F.when(asked, F.coalesce("n", F.lit(0))).alias("n_near"))
