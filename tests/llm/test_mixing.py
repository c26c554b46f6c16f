import random
import re
from collections import defaultdict

import pytest

from shoplens.llm import mixing

DOCS = "doc_id long, text string, source string"


def plain_targets(sizes):
    """The contract read literally: give by weight, cut at three times the size, give the excess to the others."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    left = float(total)
    while left > 1e-9 and free:
        units = sum(weight[s] for s in free)
        given = left
        left = 0.0
        for s in sorted(free, key=str):
            target[s] += given * weight[s] / units
        for s in list(free):
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                free.discard(s)
    return target


def check(rows, docs):
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    targets = plain_targets(dict(sizes))
    taken, by_source = defaultdict(int), {}
    for r in rows:
        assert r.source_size == sizes[r.source] and 0 <= r.taken <= 3 * r.size
        assert r.target == pytest.approx(targets[r.source], rel=1e-9, abs=1e-6)
        taken[r.source] += r.taken
        by_source[r.source] = r.target
    for source, target in by_source.items():
        same = max([sum(1 for d in docs if d == e) for e in docs if e[2] == source])
        assert abs(taken[source] - target) <= 0.5 + same
    assert len(rows) == len(docs)


@pytest.mark.parametrize("seed", range(2))
def test_random_sources(spark, seed):
    rng = random.Random(seed)
    names = [None, "", "a", "Z", "é", "z", "\U0001f642", "￿"][:rng.randrange(2, 9)]
    docs = [(rng.choice([None, rng.randrange(40)]), rng.choice([None, "", " \t", " ".join(["w"] * int(rng.paretovariate(0.7)))]),
             rng.choice(names[:2] if rng.random() < 0.7 else names)) for _ in range(200)]
    check(mixing.mix(spark.createDataFrame(docs, DOCS)).collect(), docs)


def test_caps_chain_and_single_source(spark):
    docs = [(i, "x " * n, s) for i, (n, s) in enumerate([(1, "a"), (2, "b"), (400, "c"), (5, "d"), (3000, "e"), (10, "f")])]
    check(mixing.mix(spark.createDataFrame(docs, DOCS)).collect(), docs)
    one = [(1, "a b c", "s"), (2, "d", "s")]
    assert sorted(r.taken for r in mixing.mix(spark.createDataFrame(one, DOCS)).collect()) == [1, 3]


def test_rows_alike_share_the_edge(spark):
    docs = [(7, "one two three four five six", "a")] * 30 + [(8, "x " * 1000, "b"), (9, "y " * 500, "b")]
    rows = mixing.mix(spark.createDataFrame(docs, DOCS)).collect()
    check(rows, docs)
    assert len({r.taken for r in rows if r.doc_id == 7}) == 1


def test_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    rows = mixing.mix(spark.createDataFrame([(1, None, None), (None, "", "a"), (None, "", "a")], DOCS)).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 3


def test_table_clashing_columns_and_reruns(spark, small, small_docs, clashing):
    rows = mixing.mix(small_docs).collect()
    check(rows, [tuple(r) for r in small_docs.select("doc_id", "text", "source").collect()])
    again = mixing.mix(clashing.select("*", *[clashing.n_chars.alias(c) for c in ("size", "place", "weight", "target", "_source", "_at")])
                       .repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_larger_budgets_take_the_same_documents(spark, small_docs):
    sized = mixing.measured(small_docs)
    total = sized.where("source = 'src1'").agg({"size": "sum"}).first()[0]
    kept = set()
    for budget in (0, total // 7, total // 2, total - 1):
        plan = mixing.thresholds(sized, spark.createDataFrame([("src1", total, float(budget))], "source string, source_size long, target double")).first()
        ids = {r.doc_id for r in sized.where(f"source = 'src1' and hash < {plan.edge}").collect()}
        assert kept <= ids
        kept = ids


def test_mixture_has_the_words_that_were_taken(spark, small_docs):
    text = mixing.mixture(small_docs)
    words = defaultdict(int)
    for r in text.collect():
        words[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert words == {r.doc_id: r.taken for r in mixing.mix(small_docs).collect() if r.taken}
