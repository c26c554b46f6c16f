"""Helpers that several operators share: written intermediates, clean input columns, components of a graph."""

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens.session import shared_dir, shuffles_freed


def fresh_path(spark, name):
    """A new folder in the cluster's shared folder; nothing is ever overwritten."""
    return f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def staged(df, name):
    """Writes a frame to the shared folder and reads it back: short lineage, and what it took is computed once."""
    path = fresh_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs, id_col="doc_id", text_col="text"):
    """The two columns an operator reads. A null text is the empty text; a null id stays null."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def hash_share(share, *columns):
    """Condition that holds for about `share` of all rows, by a hash: the same rows whatever the partitioning."""
    if share >= 1:
        return F.lit(True)
    return F.xxhash64(*columns) < F.lit(int(share * (1 << 64)) - (1 << 63))


def tasks(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _fingerprint(edges):
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges, name="components"):
    """Distributed union-find: (a, b) links -> (node, root), root the smallest node of the component.

    Alternating large-star and small-star rounds. Every round is two aggregations with a map-side part and
    two equi-joins, which adaptive execution splits where a hub is hot; nothing is gathered per component.
    The number of links never grows, and a component of diameter d needs about log(d) rounds.
    """
    links = staged(edges.where(F.col("a") != F.col("b"))
                   .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = _fingerprint(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = staged(both.join(low, "a").where(F.col("b") > F.col("a"))
                       .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), name)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        links = staged(large.join(low, "a").where(F.col("b") != F.col("m"))
                       .select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                           low.select("a", F.col("m").alias("b"))).distinct(), name)
        after = _fingerprint(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


SMALL, ROUNDS, BLOCK = 16, 2, 256


def bucket_pairs(members, centre):
    """Pairs (a, b), a < b, to compare in buckets; `members` has (key, node, n), n the size of the bucket.

    In buckets of up to SMALL members all pairs, in larger ones each member with the bucket's `centre` (an
    aggregate over the bucket that gives a node), so the work stays in proportion to the members.
    """
    few = members.where(F.col("n") <= SMALL)
    own = few.select("key", F.col("node").alias("a")).join(few.select("key", F.col("node").alias("b")), "key").where(
        F.col("a") < F.col("b")).select("a", "b")
    many = members.where(F.col("n") > SMALL)
    stars = many.join(many.groupBy("key").agg(centre.alias("centre")), "key").where(
        F.col("node") != F.col("centre")).select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
    return own.unionByName(stars).distinct()


def _across(placed):
    """All pairs (a, b), a < b, of a bucket's members of different components; `placed` has (key, node, root).

    A bucket is cut into blocks of about BLOCK members, and each pair of blocks is a key of its own.
    """
    sizes = placed.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    cut = placed.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = cut.select("key", "node", "root", "own", other).select(
        "key", "node", "root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    left = dealt.select("key", "low", "high", F.col("node").alias("a"), F.col("root").alias("root_a"))
    right = dealt.select("key", "low", "high", F.col("node").alias("b"), F.col("root").alias("root_b"))
    return left.join(right, ["key", "low", "high"]).where((F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b"))
                                                          ).select("a", "b").distinct()


PARITY = 4  # longs of a parity sketch of a short text
HEADS = 16  # of a text's first tokens, those by which repeated pairs are known


def parities(owner, tokens, count, words=PARITY):
    """(count x words) 64-bit parity sketches of the sets of distinct (owner, token): bit i tells whether an odd number of
    the owner's tokens fall into cell i. Two sketches differ in no more bits than the sets in tokens."""
    bits = words * 64
    cells = owner.astype(np.int64) * bits + (tokens.astype(np.uint64) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(cells, minlength=count * bits) & 1).astype(np.uint8).reshape(count, bits)
    return np.packbits(odd, axis=1).view(np.int64).reshape(count, words)


def may_be_alike(size_a, size_b, differ, least):
    """Whether sets of these sizes that differ in at least `differ` tokens can have a Jaccard similarity of `least`.
    Sets of hashes may be a little smaller than what they stand for, hence the 4."""
    return differ <= F.lit((1 - least) / (1 + least)) * (F.col(size_a) + F.col(size_b) + 4)


def unlike_bits(a, b, words):
    """Number of bits in which the sketches in two array columns differ."""
    return sum(F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(words))


def rare_first_pairs(rows, sets, least, words=PARITY):
    """(a, b), a < b, of different roots: every pair whose token sets have a Jaccard similarity of `least` is among them.

    `rows` has (node, root, ...), `sets` gives the distinct 64-bit tokens of each row of an Arrow batch. If all sets are
    read in one order, two sets alike share one of their first (1 - least) parts, so only these tokens are keys. The order:
    first tokens that only one root has, which no pair can share, then the others from rare to frequent, counted over all
    rows. What many unlike texts have in common comes last, so buckets stay short where buckets of sketches were long, and
    a text with a (1 - least) part of its own gives no key at all. Of pairs that share a key only those leave the join
    whose sets can be that alike: tokens that one root alone has differ for certain, the others by their parity sketches.
    """
    def spread(batches):
        for batch in batches:
            own = sets(batch)
            sizes = np.array([len(s) for s in own], np.int64)
            tokens = np.concatenate(own).view(np.int64) if len(own) else np.empty(0, np.int64)
            node, root = (np.repeat(batch[c].to_numpy(zero_copy_only=False), sizes) for c in ("node", "root"))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (node, root, np.repeat(sizes, sizes), tokens)],
                                             ["node", "root", "size", "token"])

    tokens = staged(rows.mapInArrow(spread, "node long, root long, size long, token long"), "tokens")
    counts = tokens.groupBy("token").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where(
        F.col("low") != F.col("high")).select("token", "n")
    by_node = Window.partitionBy("node")
    # one more than needed, for sets of hashes may be a little smaller than what they stand for
    needed = F.count("*").over(by_node) - F.ceil(F.lit(least) * F.col("size") - 1e-9) + 2
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("token", F.lit(64)).cast("int"))
    part = F.pmod(F.shiftright("token", 6), F.lit(words))
    parity = F.array(*[F.bit_xor(F.when(part == i, bit).otherwise(F.lit(0).cast("long"))).over(by_node) for i in range(words)])
    keyed = tokens.join(counts, "token").withColumns({
        "needed": needed, "own": F.col("size") - F.count("*").over(by_node), "parity": parity}).where(F.col("needed") > 0).withColumn(
        "at", F.row_number().over(by_node.orderBy("n", "token"))).where(F.col("at") <= F.col("needed"))
    # a pair leaves the join at its first common token; of many tokens before only HEADS are looked at, the rest comes twice
    head = F.when(F.col("at") <= HEADS, F.struct("at", "token"))
    keyed = keyed.withColumn("heads", F.collect_list(head).over(by_node)).withColumn(
        "before", F.transform(F.filter("heads", lambda h: h["at"] < F.col("at")), lambda h: h["token"]))
    kept = ("root", "size", "own", "parity", "before")
    keyed = staged(keyed.select("node", "token", *kept), "first-tokens")
    side = lambda name: keyed.select("token", F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in kept])
    near = (F.least("size_a", "size_b") + 1 >= F.lit(least) * F.greatest("size_a", "size_b")) & may_be_alike(
        "size_a", "size_b", F.col("own_a") + F.col("own_b") + unlike_bits("parity_a", "parity_b", words), least)
    return side("a").join(side("b"), "token").where((F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & near
                                                    & ~F.arrays_overlap("before_a", "before_b")).select("a", "b").distinct()


def linked_classes(members, weight, verify, rest=None):
    """(node, root) of all linked nodes. `members`: (key, node, n, ...), `verify`: pairs (a, b) -> links (a, b).

    The classes are those that comparing all pairs of every bucket gives. In buckets of up to SMALL members that is
    done. A larger bucket is mostly a group of copies: its members are compared with a centre, and while that finds
    links, in up to ROUNDS more rounds with a centre out of a component that had none in this bucket. Pairs inside a
    component need no comparison. Of what is left between components, `rest` ((node, root) -> pairs that may be linked, all of
    them) names the pairs to compare; without it all are compared.
    """
    first = F.max_by("node", weight)
    tested = staged(bucket_pairs(members, first), "pairs")
    links = staged(verify(tested), "links")
    many = members.where(F.col("n") > SMALL)
    centres = staged(many.groupBy("key").agg(first.alias("node")), "centres")
    for turn in range(ROUNDS + 1):
        roots = components(links)
        placed = many.select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        several = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(
            F.col("low") != F.col("high")).select("key")
        placed = staged(placed.join(several, "key").select("key", "node", "root"), "open")
        if placed.isEmpty():
            return roots
        if turn == ROUNDS:
            break
        had = placed.join(centres, ["key", "node"], "left_semi").select("key", "root").distinct()
        fresh = placed.join(had, ["key", "root"], "left_anti").groupBy("key").agg(
            F.max_by(F.struct("node", "root"), F.xxhash64("key", "node")).alias("c")).select(
            "key", F.col("c.node").alias("centre"), F.col("c.root").alias("centre_root"))
        fresh = staged(fresh, "centres")
        pairs = (placed.join(fresh, "key").where(F.col("root") != F.col("centre_root"))
                 .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
                 .join(tested, ["a", "b"], "left_anti"))
        pairs = staged(pairs, "pairs")
        found = staged(verify(pairs), "links")
        tested, centres = tested.unionByName(pairs), centres.unionByName(fresh.select("key", F.col("centre").alias("node")))
        if found.isEmpty():
            break
        links = links.unionByName(found)
    left = _across(placed) if rest is None else rest(placed.select("node", "root").distinct())
    pairs = staged(left.join(tested, ["a", "b"], "left_anti"), "pairs")
    found = staged(verify(pairs), "links")
    return roots if found.isEmpty() else components(links.unionByName(found))
