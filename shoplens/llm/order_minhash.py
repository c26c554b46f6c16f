"""Near-duplicate documents by order MinHash, verified by banded alignment.

A text is the sequence of its shingles of five words (lower case, cut at white space). Each shingle is labelled
with how often it came before, so repeats count. For each of SKETCHES hash functions the LENGTH labelled shingles
with the smallest hashes are taken and put back into the order of the text: two texts share such a sketch with
high probability only if they share most shingles in the same order. Texts that share a sketch are candidates;
the similarity that decides is that of an alignment: L / (n + m - L), with L the longest common subsequence of
the two shingle sequences, found in the band that the threshold leaves.

With SKETCHES = 30 and LENGTH = 4, two texts whose similarity is 0.8 share no sketch with probability 2e-7.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from shoplens.llm.common import id_and_text, linked_classes, may_be_alike, parities, rare_first_pairs, staged, unlike_bits

WORDS, SIMILARITY = 5, 0.8
SKETCHES, LENGTH = 30, 4
MEMORY = 500_000
DRAWN = 50_000  # hashes of one text that are in memory at once
PARITY = 16  # longs of a text's parity sketch


class Shingler:
    """Hashes of shingles, with a memory of word hashes."""

    def __init__(self, words=WORDS):
        self.words, self.known = words, {}
        self.powers = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(words)], np.uint64)

    def __call__(self, text):
        """One 64-bit hash per shingle, in order; a text of fewer words is one shingle, one without words none."""
        words, known = text.lower().split(), self.known
        if not words:
            return np.empty(0, np.uint64)
        if len(words) < self.words:
            return np.array([xxhash.xxh3_64_intdigest(" ".join(words))], np.uint64)
        new = set(words).difference(known)
        if new:
            if len(known) + len(new) > MEMORY:
                known.clear()
                new = set(words)
            known.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        count = len(words) - self.words + 1
        total = np.zeros(count, np.uint64)
        for i in range(self.words):
            total += hashes[i:i + count] * self.powers[i]
        return mixed(total)


_SHINGLER = Shingler()  # kept from task to task in a Python worker


def mixed(x):
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def occurrences(values):
    """How many equal values come before each one."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    sizes = np.diff(np.r_[first, len(values)])
    out = np.empty(len(values), np.uint64)
    out[order] = np.arange(len(values)) - np.repeat(first, sizes)
    return out


def sketches(shingles, count=SKETCHES, length=LENGTH):
    """`count` 64-bit keys; texts with fewer than `length` shingles give sketches of all they have."""
    if not len(shingles):
        return np.empty(0, np.int64)
    names = labelled(shingles)
    take = min(length, len(shingles))
    chosen = np.empty((take, count), np.uint64)
    seeds = (np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]
    at_once = max(1, DRAWN // len(names))  # hash functions; one after the other for a very long text
    for i in range(0, count, at_once):
        drawn = mixed((names ^ seeds[i:i + at_once]) * np.uint64(0x94D049BB133111EB))
        chosen[:, i:i + at_once] = shingles[np.sort(np.argpartition(drawn, take - 1, axis=1)[:, :take], axis=1)].T
    keys = np.arange(1, count + 1, dtype=np.uint64)
    for values in chosen:
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + values)
    return keys.view(np.int64)


def common_in_order(a, b, most):
    """Longest common subsequence of two lists if it leaves at most `most` elements of both unmatched, else None.

    Only diagonals within the band of `most` are followed; each step reaches as far as it can.
    """
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return None
    reach = {1: 0}
    for d in range(most + 1):
        for k in range(-d, d + 1, 2):
            if k == -d or (k != d and reach[k - 1] < reach[k + 1]):
                x = reach[k + 1]
            else:
                x = reach[k - 1] + 1
            y = x - k
            while x < n and y < m and a[x] == b[y]:
                x += 1
                y += 1
            reach[k] = x
            if x >= n and y >= m:
                return (n + m - d) // 2
    return None


def shared_count(a, b):
    """Size of the common multiset: no common subsequence is longer."""
    values, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left = np.bincount(at[:len(a)], minlength=len(values))
    right = np.bincount(at[len(a):], minlength=len(values))
    return int(np.minimum(left, right).sum())


def similarity(a, b, least=SIMILARITY):
    """Alignment similarity of two shingle arrays, or None where it is below `least`."""
    total = len(a) + len(b)
    if not len(a) or not len(b):
        return 1.0 if not total else None
    most = int(total * (1 - least) / (1 + least) + 1e-9)
    if total - 2 * shared_count(a, b) > most:
        return None
    found = common_in_order(a.tolist(), b.tolist(), most)
    return None if found is None else found / (total - found)


def _sketched(rows):
    def run(batches):
        shingler = _SHINGLER
        for batch in batches:
            shingles = [shingler(t) for t in batch["text"].to_pylist()]
            keys = [sketches(s).tolist() for s in shingles]
            outlines = [parities(np.zeros(len(s), np.int64), labelled(s), 1, PARITY)[0] for s in shingles]
            yield pa.RecordBatch.from_arrays(
                [batch["node"], pa.array(keys, pa.list_(pa.int64())), pa.array(map(len, shingles), pa.int64()),
                 pa.array(outlines, pa.list_(pa.int64()))], ["node", "keys", "size", "parity"])

    return rows.select("node", "text").mapInArrow(run, "node long, keys array<long>, size long, parity array<long>")


def labelled(shingles):
    """Shingles with their occurrence: a multiset as a set. Texts alike by alignment are alike by these sets."""
    return mixed(shingles + occurrences(shingles) * np.uint64(0xD6E8FEB86659FD93))


def _token_sets(batch):
    return [np.unique(labelled(s)) if len(s) else s for s in map(_SHINGLER, batch["text"].to_pylist())]


def _verified(pairs, texts, least):
    """The pairs (a, b) whose alignment reaches `least`. Sizes and sketches come to pairs by two equality joins, and texts
    to those pairs that these leave."""
    def run(batches):
        shingler = _SHINGLER
        for batch in batches:
            kept = [similarity(shingler(x), shingler(y), least) is not None
                    for x, y in zip(batch["x"].to_pylist(), batch["y"].to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    outline = lambda name: texts.select(F.col("node").alias(name), F.col("size").alias(f"size_{name}"), F.col("parity").alias(f"parity_{name}"))
    likely = pairs.join(outline("a"), "a").join(outline("b"), "b").where(
        (F.least("size_a", "size_b") >= F.lit(least - 1e-9) * F.greatest("size_a", "size_b"))
        & may_be_alike("size_a", "size_b", unlike_bits("parity_a", "parity_b", PARITY), least)).select("a", "b")
    side = lambda name, text: texts.select(F.col("node").alias(name), F.col("text").alias(text))
    both = likely.join(side("a", "x"), "a").join(side("b", "y"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def text_classes(rows, least=SIMILARITY):
    """(node, root) of all texts that are linked to another one; `rows` has (node, text), node a hash of the text.

    Texts of a bucket of equal sketches are compared as `linked_classes` says; what is left open in large buckets (texts
    with a passage in common, mostly) meets by its rarest shingles, which leaves out no pair of that similarity. The first centre is the member that
    shares most sketches with other texts, the original of a group of copies.
    """
    drawn = staged(_sketched(rows).groupBy("node").agg(*[F.first(c).alias(c) for c in ("keys", "size", "parity")]), "sketches")
    members = drawn.select("node", "size", F.explode(F.array_distinct("keys")).alias("key"))
    sizes = members.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    members = members.join(sizes, "key")
    score = members.groupBy("node").agg(F.sum("n").alias("score"))
    members = staged(members.join(score, "node").select("key", "node", "n", "score", "size"), "buckets")
    wanted = drawn.join(members.select("node").distinct(), "node", "left_semi").select("node", "size", "parity")
    texts = staged(rows.select("node", "text").join(wanted, "node").groupBy("node").agg(
        F.first("text").alias("text"), F.first("size").alias("size"), F.first("parity").alias("parity")), "texts")

    def rest(open_):
        return rare_first_pairs(open_.join(texts.select("node", "text"), "node"), _token_sets, least, PARITY // 2)

    tie = F.xxhash64("node").bitwiseAND(F.lit((1 << 20) - 1))
    return linked_classes(members, F.col("score") * (1 << 20) + tie, lambda pairs: _verified(pairs, texts, least), rest)


def _nodes(docs):
    """Rows keyed by a 64-bit hash of the text: equal texts are one node, whatever their number."""
    return id_and_text(docs).withColumn("node", F.xxhash64("text"))


def classes(docs, least=SIMILARITY):
    """One row per document: (doc_id, class_id, kept).

    `class_id` is the smallest id of the class. Equal texts are one class (null and empty texts as well), links
    between different texts join classes. `kept` marks the row that stays of each class: the one with the
    smallest id. Of rows that repeat an id in a class all are marked. A class of null ids has a null class id.
    """
    rows = _nodes(docs)
    roots = text_classes(rows, least)
    owned = rows.select("doc_id", "node").join(roots, "node", "left").select(
        "doc_id", F.coalesce("root", "node").alias("root"))
    first = owned.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return owned.join(first, "root").select("doc_id", "class_id",
                                            F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def keep_one(docs, least=SIMILARITY):
    """The documents without near copies: one row of each class, the one with the smallest id, columns unchanged."""
    roots = text_classes(_nodes(docs), least)
    node = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    ids = docs.select(F.col("doc_id").cast("long").alias("_id"), node.alias("_node")).groupBy("_node").agg(
        F.min("_id").alias("_first")).join(
        roots.select(F.col("node").alias("_node"), F.col("root").alias("_root")), "_node", "left").withColumn(
        "_root", F.coalesce("_root", "_node"))
    best = ids.groupBy("_root").agg(F.min("_first").alias("_best"))
    # the text that holds the smallest id of its class; of several, the one with the smallest hash
    chosen = (ids.join(best, "_root").where(F.col("_first").eqNullSafe(F.col("_best")))
              .groupBy("_root", "_best").agg(F.min("_node").alias("_node"))
              .select(F.coalesce("_best", "_node").alias("_key"), "_node"))
    own = docs.select(F.struct("*").alias("_doc"), F.coalesce(F.col("doc_id").cast("long"), node).alias("_key"),
                      node.alias("_node"))
    return own.join(chosen, ["_key", "_node"]).dropDuplicates(["_key", "_node"]).select("_doc.*")
