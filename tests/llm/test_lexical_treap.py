import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from shoplens.llm import lexical_treap as lt
from shoplens.llm.common import read_table

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=20):
    """The contract read literally."""
    read = [(i, words(t)) for i, t in docs]
    spoken = [r for r in read if r[1]]
    n_docs, n_terms = len(spoken), sum(len(w) for _, w in spoken)
    df = Counter(t for _, w in spoken for t in set(w))
    out = []
    for item, text in {(i, t or "") for i, t in items}:
        scores = []
        for doc, own in spoken:
            tf, m = Counter(own), 100 - 25 + ((25 * len(own) * n_docs) // n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 12 * m))
                        for t in words(text) if tf[t])
            if score > 0:
                scores.append((-score, doc is None, doc))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()], key=repr)


@pytest.mark.parametrize("seed,shard", [(1, 5), (2, 64)])
def test_random_tables(spark, seed, shard):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "été", "ÉTÉ", "日本", "a1", "\x80x", "K"]
    text = lambda n: rng.choice([" ", "-", "\n", "_"]).join(vocabulary[min(int(rng.paretovariate(0.5)), 66)] for _ in range(n))
    docs = [(rng.choice([None, rng.randrange(1000), 5, 2 ** 63 - 1, -3]), rng.choice([None, "", "...", text(1), text(30), text(200)])) for _ in range(300)]
    docs += [(900 + i, "twin text w1 w2 w3") for i in range(40)] + [(950, "twin text w1 w2 w3")] * 3
    items = [(i, text(rng.randrange(1, 40))) for i in range(25)] + [(30, None), (31, ""), (32, "unheard"), (33, "TWIN w1"), (33, "TWIN w1"), (None, "w1 w1 w1")]
    ranked = lt.rank_documents(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), shard_docs=shard)
    assert got(ranked) == plain(docs, items)


def test_several_blocks_of_items(spark, monkeypatch):
    docs = [(i, f"alpha{i % 7} beta{i % 5} gamma") for i in range(60)]
    items = [(i, f"alpha{i % 9} beta{i % 3} gamma gamma") for i in range(30)]
    monkeypatch.setattr(lt, "BLOCK_TERMS", 20)
    assert got(lt.rank_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))) == plain(docs, items)


def test_empty_tables_and_clashing(spark, small, small_docs, clashing):
    none, items = spark.createDataFrame([], DOCS), read_table(spark, small, "benchmark")
    assert lt.rank_documents(none, items).count() == 0
    assert lt.rank_documents(small_docs, spark.createDataFrame([], ITEMS)).count() == 0
    assert lt.rank_documents(spark.createDataFrame([(1, None), (2, "  ")], DOCS), items).count() == 0
    want = plain([tuple(r) for r in small_docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert got(lt.rank_documents(clashing.repartition(5), items)) == want


def test_treap_packs_and_finds():
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 500):
        cells = rng.choice(64 * 64, n, replace=False)
        rows, columns, values = cells // 64, cells % 64, rng.integers(1, 10 ** 6, n)
        treap = lt.Treap.unpack(lt.Treap.of(rows, columns, values, 6).pack())
        grid = np.zeros((64, 64), np.int64)
        grid[rows, columns] = values
        if n:
            assert treap.largest[0] == grid.max() and sorted(treap.largest[-n:]) == sorted(values)
        asked, weights = np.array([3, 9, 40, 41]), np.array([5, 1, 2, 9])
        scores = (grid[asked] * weights[:, None]).sum(0)
        for k in (1, 5, 64):
            best = sorted([(-s, c) for c, s in enumerate(scores) if s > 0])[:k]
            found, own = lt.best_in(treap, asked, weights, 64, k)
            assert [(-s, c) for c, s in zip(found, own)][:k] == best


def test_most_ranges_stay_closed(monkeypatch):
    """A document that holds all terms leaves the rest of the grid unopened."""
    rng = np.random.default_rng(4)
    columns = np.concatenate([np.repeat(np.arange(4096), 2), np.full(16, 1234)])
    rows = np.concatenate([rng.integers(100, 200, 8192), np.arange(16)])
    pairs = np.unique(np.stack([rows, columns]), axis=1)
    treap = lt.Treap.of(pairs[0], pairs[1], np.full(pairs.shape[1], 1000), 12)
    opened = []
    child = lt.Treap.child
    monkeypatch.setattr(lt.Treap, "child", lambda self, nodes, q: opened.append(len(nodes)) or child(self, nodes, q))
    found, _ = lt.best_in(treap, np.arange(32), np.ones(32, np.int64), 4096, 1)
    assert found[0] == 1234 and sum(opened) < 400


def test_long_text(spark):
    docs = [(1, "rare " + "filler " * 200_000), (2, "rare"), (3, "x" * 500_000)]
    assert got(lt.rank_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, "rare filler")], ITEMS))) == plain(docs, [(1, "rare filler")])
