"""Ranked lexical search: a K2-treap over each shard's term-document grid, searched best-first for every item.

A shard's grid has a row per term (frequent ones first) and a column per document. A cell of the quadtree is kept
where it holds a posting, with the largest impact in it. For an item, the row paths of all its terms go down together
over document ranges: the sum of their cells' maxima bounds every score in a range, the most promising ranges are opened
first, and ranges below the item's best scores so far are never opened.
"""

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from shoplens.llm.common import id_and_text, staged
from shoplens.operators.ranking import top_k

TOP = 20
SHARD_DOCS = 4096
BLOCK_TERMS = 50_000  # terms of the items searched together, as expected; more items are searched in several passes
OPENED = 256  # ranges opened at once

# Fixed values of the contract: terms are runs of ASCII letters and digits and of everything beyond ASCII
_KEPT = [c for c in range(128) if chr(c).isalnum()]
_LOWER = bytes(ord(chr(c).lower()) if c in _KEPT else 32 if c < 128 else c for c in range(256))


def terms_of(text):
    """The terms of a text as UTF-8 bytes, in order; only A-Z are lower-cased."""
    return text.encode().translate(_LOWER).split()


# --- items ---------------------------------------------------------------------------------------

def item_terms(items, id_col="item_id", text_col="text"):
    """(item_id, terms, counts): an item's different terms in order with their numbers; equal rows are one item."""
    def read(batches):
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                counts = {}
                for w in terms_of(text):
                    counts[w] = counts.get(w, 0) + 1
                out.append(sorted(counts.items()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([[w for w, _ in o] for o in out], pa.list_(pa.binary())),
                 pa.array([[n for _, n in o] for o in out], pa.list_(pa.int64()))], names=["item_id", "terms", "counts"])

    return id_and_text(items, id_col, text_col).distinct().mapInArrow(read, "item_id long, terms array<binary>, counts array<long>")


def item_blocks(items):
    """Lists of items (item_id, {term: count}), about BLOCK_TERMS terms each: what one pass searches for.

    Items are dealt to blocks by hash, and the driver holds one block at a time.
    """
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // BLOCK_TERMS)
    for block in range(blocks):
        rows = items.where(F.size("terms") > 0).where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == block).collect()
        rows.sort(key=lambda r: (r.item_id is None, r.item_id, r.terms))
        yield [(r.item_id, dict(zip(map(bytes, r.terms), r.counts))) for r in rows]


# --- postings and statistics ------------------------------------------------------------------------

SHARD = "doc_ids binary, sizes binary, terms binary, docs binary, counts binary, frequencies array<struct<term:int,docs:long>>"


def shards(docs, vocabulary, shard_docs=SHARD_DOCS):
    """Postings of all documents in shards of up to `shard_docs`, for the terms in `vocabulary` ({term: number}).

    A shard row has the documents' ids (sorted) and sizes in terms, and postings (term, document in the shard, count) as
    little-endian arrays. Terms that no item asks for only count towards the sizes.
    """
    find = vocabulary.get

    def index(batches):
        for batch in batches:
            ids = batch["doc_id"]
            order = np.lexsort((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))  # null ids last
            for start in range(0, len(order), shard_docs):
                yield one(batch.take(pa.array(order[start:start + shard_docs])))

    def one(part):
        sizes, rows, columns, counts = [], [], [], []
        for column, text in enumerate(part["text"]):
            words = terms_of(text.as_py())
            sizes.append(len(words))
            own = {}
            for number in filter(None, map(find, words)):
                own[number] = own.get(number, 0) + 1
            rows += own
            counts += own.values()
            columns += [column] * len(own)
        rows = np.array(rows, "<i4")
        seen, documents = np.unique(rows, return_counts=True)
        ids = part["doc_id"]
        raw = [pa.array([a.tobytes()], pa.binary()) for a in (
            ids.fill_null(0).to_numpy().astype("<i8"), np.array(sizes, "<i8"), rows, np.array(columns, "<i4"), np.array(counts, "<i8"))]
        frequencies = pa.array([[{"term": int(t), "docs": int(n)} for t, n in zip(seen, documents)]],
                               pa.list_(pa.struct([("term", pa.int32()), ("docs", pa.int64())])))
        nulls = pa.array([ids.null_count], pa.int64())
        spoken = pa.array([sum(n > 0 for n in sizes)], pa.int64())
        return pa.RecordBatch.from_arrays([*raw, frequencies, nulls, spoken, pa.array([sum(sizes)], pa.int64())],
                                          names=["doc_ids", "sizes", "terms", "docs", "counts", "frequencies", "no_ids", "spoken", "words"])

    return id_and_text(docs).mapInArrow(index, SHARD + ", no_ids long, spoken long, words long")


def statistics(postings):
    """(N, L, {term number: documents}) over all shards; the map has at most a row per term of the vocabulary."""
    spoken, words = postings.agg(F.sum("spoken"), F.sum("words")).first()
    frequent = postings.select(F.explode("frequencies").alias("f")).groupBy("f.term").agg(F.sum("f.docs").alias("docs")).collect()
    return spoken or 0, words or 0, {r.term: r.docs for r in frequent}


def term_weight(documents, frequency):
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


# --- the treap ------------------------------------------------------------------------------------------

def _interleaved(rows, columns, levels):
    code = np.zeros(len(rows), np.int64)
    for bit in range(levels - 1, -1, -1):
        code = code << 2 | (rows >> bit & 1) << 1 | (columns >> bit & 1)
    return code


class Treap:
    """Cells of a grid of 2^levels x 2^levels with the largest value below each, level by level, the whole grid first.

    A node is known by its place in that order: `mask` says which of its quadrants (row half, column half) hold anything,
    `first` where their nodes start, `largest` the largest value.
    """

    def __init__(self, levels, masks, largest):
        self.levels, self.largest = levels, np.concatenate(largest) if largest else np.empty(0, np.int64)
        self.mask = np.concatenate([*masks, np.zeros(len(self.largest) - sum(map(len, masks)), np.uint8)]) if largest else np.empty(0, np.uint8)
        children = _ONES[self.mask]
        self.first = 1 + np.cumsum(children, dtype=np.int64) - children

    @classmethod
    def of(cls, rows, columns, values, levels):
        """From postings, one value for each (row, column)."""
        code = _interleaved(rows, columns, levels)
        order = np.argsort(code, kind="stable")
        code, value = code[order], values[order]
        largest, masks = [value] if len(value) else [], []
        while len(code) and len(masks) < levels:
            above, starts = np.unique(code >> 2, return_index=True)
            masks.append(np.bitwise_or.reduceat((1 << (code & 3)).astype(np.uint8), starts))
            value = np.maximum.reduceat(value, starts)
            largest.append(value)
            code = above
        return cls(levels, masks[::-1], largest[::-1])

    def child(self, nodes, quadrants):
        """Nodes of the given quadrants, -1 where there is nothing (also below -1)."""
        mask = self.mask[nodes]
        there = (nodes >= 0) & (mask >> quadrants & 1 == 1)
        return np.where(there, self.first[nodes] + _ONES[mask & (1 << quadrants) - 1], -1)

    def pack(self):
        """Quadrant masks, two to a byte, and each value's distance to the node above, compressed."""
        inner = self.mask > 0
        masks = self.mask[:int(inner.sum())] if len(self.mask) else self.mask
        above = np.repeat(np.arange(len(masks)), _ONES[masks])
        gaps = np.concatenate([self.largest[:1], self.largest[above] - self.largest[1:]])
        pairs = np.concatenate([masks, np.zeros(len(masks) % 2, np.uint8)])
        small = (gaps.astype("<u4").view(np.uint8).reshape(-1, 4).T if len(gaps) else np.empty((4, 0), np.uint8)).tobytes()
        head = np.array([self.levels, len(masks), len(gaps)], "<i8").tobytes()
        return zstandard.ZstdCompressor(3).compress(head + (pairs[::2] | pairs[1::2] << 4).tobytes() + small)

    @classmethod
    def unpack(cls, raw):
        raw = zstandard.ZstdDecompressor().decompress(raw)
        levels, n_masks, n = np.frombuffer(raw, "<i8", 3)
        bytes_ = np.frombuffer(raw, np.uint8, -(-n_masks // 2), 24)
        masks = np.stack([bytes_ & 15, bytes_ >> 4], 1).reshape(-1)[:n_masks]
        gaps = np.frombuffer(raw, np.uint8, 4 * n, 24 + len(bytes_)).reshape(4, -1).T.copy().view("<u4").reshape(-1).astype(np.int64)
        if not n:
            return cls(int(levels), [], [])
        self = cls(int(levels), [masks], [gaps])
        at, end = 0, 1  # values from distances, a level at a time
        for _ in range(int(levels)):
            below = np.repeat(self.largest[at:end], _ONES[self.mask[at:end]])
            self.largest[end:end + len(below)] = below - self.largest[end:end + len(below)]
            at, end = end, end + len(below)
        return self


_ONES = np.array([bin(m).count("1") for m in range(16)], np.int64)


def impacts(counts, sizes, documents, words):
    """The part of a score that a term's count in a document gives, before the term's weight."""
    m = 75 + (25 * sizes * documents) // words
    return (1_000_000_000 * counts) // (1000 * counts + 12 * m)


def index(postings, documents, words, rows):
    """A treap per shard; `rows` has the grid's row of every term of the vocabulary (an array by term number)."""
    def build(batches):
        for batch in batches:
            for r in batch.to_pylist():
                sizes, terms, docs, counts = (np.frombuffer(r[c], t) for c, t in (
                    ("sizes", "<i8"), ("terms", "<i4"), ("docs", "<i4"), ("counts", "<i8")))
                levels = max(1, int(len(rows) - 1).bit_length(), int(len(sizes) - 1).bit_length())
                treap = Treap.of(rows[terms], docs.astype(np.int64), impacts(counts, sizes[docs], documents, words), levels)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in (
                    (r["doc_ids"], pa.binary()), (r["no_ids"], pa.int64()), (treap.pack(), pa.binary()))], names=["doc_ids", "no_ids", "treap"])

    return postings.select("doc_ids", "no_ids", "sizes", "terms", "docs", "counts").mapInArrow(
        build, "doc_ids binary, no_ids long, treap binary")


def best_in(treap, rows, weights, columns, k, floor=1):
    """(columns, scores) of the k highest scores of at least `floor`, ties by column; plus all that tie with the last.

    `rows` and `weights`: the item's terms. Ranges of columns wait with their bound and a node per term; the best are
    opened first. A single column's bound is its score.
    """
    levels = treap.levels
    if not len(treap.largest):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    bound = np.array([int((treap.largest[0] * weights).sum())])
    level, place, nodes = np.array([0]), np.array([0]), np.zeros((1, len(rows)), np.int64)
    found, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    while len(bound):
        if len(bound) > OPENED:
            chosen = np.zeros(len(bound), bool)
            chosen[np.argpartition(-bound, OPENED)[:OPENED]] = True
        else:
            chosen = np.ones(len(bound), bool)
        depth, above, own = level[chosen], place[chosen], nodes[chosen]
        half = (rows[None, :] >> (levels - 1 - depth)[:, None]) & 1
        opened = []
        for side in (0, 1):
            below = treap.child(own, 2 * half + side)
            limit = (np.where(below >= 0, treap.largest[below], 0) * weights).sum(1)
            opened.append((limit, depth + 1, 2 * above + side, below))
        new = [np.concatenate(p) for p in zip(*opened)]
        new = [p[new[0] >= floor] for p in new]
        single = new[1] == levels
        if single.any():
            found, scores = np.concatenate([found, new[2][single]]), np.concatenate([scores, new[0][single]])
            if len(scores) >= k:
                floor = max(floor, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                found, scores = found[scores >= floor], scores[scores >= floor]
        bound, level, place, nodes = (np.concatenate([old[~chosen], fresh[~single]]) for old, fresh in zip((bound, level, place, nodes), new))
        stays = bound >= floor
        bound, level, place, nodes = bound[stays], level[stays], place[stays], nodes[stays]
    order = np.lexsort((found, -scores))
    return found[order], scores[order]


def search_shards(treaps, items, rows, weights, vocabulary, k=TOP):
    """(item, doc_id, score) candidates of every shard: at least those of the item's k best documents that lie in it.

    A task that searches several shards keeps each item's k best scores so far: what is below the last of them cannot be
    among the best of all and is not looked at.
    """
    asked = []
    for _, counts in items:
        numbers = np.array([vocabulary[t] for t in counts], np.int64)
        weight = np.array(list(counts.values()), np.int64) * weights[numbers]
        asked.append((rows[numbers][weight > 0], weight[weight > 0]))

    def search(batches):
        best = [np.empty(0, np.int64)] * len(asked)
        for batch in batches:
            for r in batch.to_pylist():
                treap, ids = Treap.unpack(r["treap"]), np.frombuffer(r["doc_ids"], "<i8")
                known = len(ids) - r["no_ids"]
                out = [], [], []
                for item, (own, weight) in enumerate(asked):
                    floor = int(best[item][0]) if len(best[item]) == k else 1
                    found, scores = best_in(treap, own, weight, len(ids), k, floor)
                    found, scores = found[:k], scores[:k]
                    best[item] = np.sort(np.concatenate([best[item], scores]))[-k:]
                    out[0].extend([item] * len(found))
                    out[1].extend(int(ids[c]) if c < known else None for c in found)
                    out[2].extend(scores.tolist())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int32(), pa.int64(), pa.int64()))],
                                                 names=["item", "doc_id", "score"])

    return treaps.mapInArrow(search, "item int, doc_id long, score long")


def rank_documents(docs, items, k=TOP, shard_docs=SHARD_DOCS, item_id="item_id"):
    """(item_id, rank, doc_id, score): each item's k documents of the highest score above 0, ties by ascending id.

    Two passes over compact postings after one over the texts: sizes and frequencies of all documents, then treaps and
    search. Items are equal only if id and text are; those without terms (null, empty) have no rows. Documents without
    terms are never found. Repeated rows of documents are documents of their own; a null id comes after all others of
    its score. Other columns are ignored. Empty tables give an empty table.
    """
    spark, ranked = docs.sparkSession, None
    asked = staged(item_terms(items, item_id), "items")
    for block in item_blocks(asked):
        vocabulary = {t: n for n, t in enumerate(sorted({t for _, counts in block for t in counts}), 1)}
        postings = staged(shards(docs, vocabulary, shard_docs), "postings")
        documents, words, frequency = statistics(postings)
        weights = np.array([term_weight(documents, frequency.get(n, 0)) for n in range(len(vocabulary) + 1)], np.int64)
        rows = np.zeros(len(vocabulary) + 1, np.int64)
        rows[sorted(range(1, len(rows)), key=lambda n: (-frequency.get(n, 0), n))] = np.arange(len(vocabulary))
        treaps = staged(index(postings, documents, words, rows), "treaps")
        found = search_shards(treaps, block, rows, weights, vocabulary, k)
        best = top_k(found, "item", [F.desc("score"), F.asc_nulls_last("doc_id")], k)
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], "item int, item_id long")
        part = best.join(names, "item").select("item_id", "rank", "doc_id", "score")
        ranked = part if ranked is None else ranked.unionByName(part)
    return ranked if ranked is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


ORACLE = r"""WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
  c AS (SELECT count(*) FILTER (len(terms) > 0) AS nd, CAST(sum(len(terms)) AS BIGINT) AS nt FROM t),
  i AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
  p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM t)
      WHERE term IN (SELECT term FROM i) GROUP BY ALL),
  w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(nd) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term),
  s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * nd) // nt)))) AS BIGINT) AS score
      FROM i JOIN p USING (term) JOIN w USING (term), c GROUP BY ALL)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM s WHERE score > 0) WHERE rank <= 20"""
