import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shoplens.llm import order_minhash as om


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def alike(x, y, least=0.8):
    a, b = (tuple(om.Shingler()(t or "").tolist()) for t in (x, y))
    if (x or "") == (y or ""):
        return True
    common = lcs(a, b)
    return bool(a) and bool(b) and common / (len(a) + len(b) - common) >= least


def brute(rows):
    """Class of each row by all pairs and a plain union-find: the smallest id of the class."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if root(i) != root(j) and alike(rows[i][1], rows[j][1]):
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    smallest = {r: min((x for x in ids if x is not None), default=None) for r, ids in groups.items()}
    return sorted(((rows[i][0], smallest[root(i)]) for i in range(len(rows))), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=30), st.lists(st.integers(0, 3), max_size=30), st.integers(0, 60))
def test_banded_alignment(a, b, most):
    common = lcs(a, b)
    want = common if len(a) + len(b) - 2 * common <= most else None
    assert om.common_in_order(a, b, most) == want


def test_sketches_follow_order():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    same = lambda b: np.mean(om.sketches(a) == om.sketches(b))
    assert same(a) == 1 and same(np.r_[a[:299], a[:1]]) > 0.8
    assert same(rng.permutation(a)) < 0.5  # the same shingles in another order
    assert same(rng.integers(0, 1 << 63, 300).astype(np.uint64)) == 0


def planted():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7)))
    rows, passage = [], " ".join(word() for _ in range(60))
    for g in range(8):
        base = [word() for _ in range(rng.randrange(80, 250))]
        rows.append((len(rows), " ".join(base)))
        for _ in range(rng.randrange(1, 12)):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + i, passage + " " + " ".join(word() for _ in range(100))) for i in range(12)]
    rows += [(500, rows[3][1]), (501, rows[3][1]), (502, None), (503, ""), (504, "one two"), (505, "one  two"), (506, "one"),
             (None, "nothing like it"), (None, rows[0][1]), (500, rows[3][1])]
    return rows


def test_classes_of_planted_copies(make_docs):
    rows = planted()
    found = om.classes(make_docs(rows)).collect()
    assert sorted(((r.doc_id, r.class_id) for r in found), key=str) == brute(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in found)


def test_one_of_each_class_stays(make_docs):
    rows = planted()
    docs = make_docs(rows)
    kept = om.keep_one(docs)
    want = {c for _, c in brute(rows)}
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)


def test_table_empty_clashing(small_docs, clashing, make_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.collect() if len(r.text) < 1500]
    ids = {i for i, _ in rows}
    found = om.classes(small_docs.where("length(text) < 1500")).collect()
    assert sorted(((r.doc_id, r.class_id) for r in found), key=str) == brute(rows) and ids
    assert om.classes(make_docs([])).count() == 0 and om.keep_one(make_docs([])).count() == 0
    assert om.keep_one(clashing).columns == clashing.columns
    assert om.keep_one(clashing).count() == om.keep_one(small_docs).count()


def test_texts_with_a_passage_in_common_in_large_buckets(make_docs, monkeypatch):
    """Hundreds share a passage of most of their words and are unlike; copies among them are found."""
    from shoplens.llm import common
    monkeypatch.setattr(common, "SMALL", 4)
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage, rows = [word() for _ in range(100)], []
    for _ in range(120):
        own = [word() for _ in range(45)]
        rows.append((len(rows), " ".join(passage + own)))
        if rng.random() < 0.3:
            own[rng.randrange(45)] = word()
            rows.append((len(rows), " ".join(passage + own)))
    found = om.classes(make_docs(rows)).collect()
    assert sorted(((r.doc_id, r.class_id) for r in found), key=str) == brute(rows)


def test_rare_first_pairs_leave_out_no_alike_pair(spark):
    from shoplens.llm import common
    rng = np.random.default_rng(12)
    shared = rng.integers(0, 1 << 62, 60)
    sets = [np.unique(np.r_[rng.choice(shared, 40, replace=False), rng.integers(0, 1 << 62, rng.integers(0, 14))]) for _ in range(150)]
    rows = spark.createDataFrame([(i, i, s.tolist()) for i, s in enumerate(sets)], "node long, root long, own array<long>")
    read = lambda batch: [np.array(s, np.int64).astype(np.uint64) for s in batch["own"].to_pylist()]
    got = {(r.a, r.b) for r in common.rare_first_pairs(rows, read, 0.8).collect()}
    alike_ = {(i, j) for j in range(150) for i in range(j) if len(set(sets[i]) & set(sets[j])) >= 0.8 * len(set(sets[i]) | set(sets[j]))}
    assert alike_ <= got


def test_measured_recall_of_the_sketches(make_docs):
    """Pairs at a similarity just above the limit, none of them in the same class by another way."""
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, pairs = [], []
    while len(pairs) < 150:
        base = [word() for _ in range(150)]
        copy = list(base)
        for _ in range(rng.randrange(1, 4)):
            copy[rng.randrange(150)] = word()
        texts = " ".join(base), " ".join(copy)
        if alike(*texts):
            pairs.append((len(rows), len(rows) + 1))
            rows += [(len(rows), texts[0]), (len(rows) + 1, texts[1])]
    found = {r.doc_id: r.class_id for r in om.classes(make_docs(rows)).collect()}
    assert np.mean([found[a] == found[b] for a, b in pairs]) >= 0.99
