import numpy as np
import pytest

from shoplens.llm import dimension_scan

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, queries, k=5):
    fine = {i: np.array(v, float) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in queries:
        if q in fine:
            a = fine[q]
            scores = [(-(a @ b) / (np.linalg.norm(a) * np.linalg.norm(b)), i) for i, b in fine.items() if i != q]
            out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in scores)[:k]]
    return out


def test_recall_on_the_table(spark, small):
    vectors = spark.read.parquet(f"{small}/embeddings.parquet")
    found = dimension_scan.search(vectors, vectors.where("vec_id % 50 = 0")).collect()
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    want = brute(rows, [i for i, _ in rows if i % 50 == 0])
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.95
    exact = {q: dict(brute(rows, [q], len(rows))[q]) for q in list(want)[:5]}
    assert all(abs(s - exact[q][i]) < 1e-9 for q in exact for i, s in got[q])


def test_large_lists_are_cut(spark, monkeypatch):
    monkeypatch.setattr(dimension_scan, "BLOCK_ROWS", 40)
    monkeypatch.setattr(dimension_scan, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(0)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(600)]
    rows += [(1000 + i, [1.0] * 16) for i in range(300)]  # a third of all rows is one vector
    vectors = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    found = dimension_scan.search(vectors, vectors.where("vec_id % 50 = 0")).collect()
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    want = brute(rows, [i for i, _ in rows if i % 50 == 0])
    hits = sum(r.vec_id in {i for i, _ in want[r.query_id]} for r in found)
    assert len(found) == 5 * len(want) and hits / len(found) >= 0.9
    same = sorted((r.rank, r.vec_id) for r in found if r.query_id == 1100)
    assert same == [(i + 1, 1000 + i) for i in range(5)]  # ties to the smaller id


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.9, 0.1]), (1, [0.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1e30, 1e30]), (100, None), (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0])]
    vectors = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA)
    found = sorted((r.query_id, r.rank, r.vec_id) for r in
                   dimension_scan.search(vectors, vectors.where("vec_id % 50 = 0")).collect())
    assert found == [(0, 1, 50), (0, 2, 8), (0, 3, 1), (50, 1, 0), (50, 2, 8), (50, 3, 1)]


@pytest.mark.parametrize("rows", [[], [(0, None, 1)], [(0, [1.0, 2.0], 1)]])
def test_hardly_any_rows(spark, rows):
    vectors = spark.createDataFrame(rows, SCHEMA)
    assert dimension_scan.search(vectors, vectors).count() == 0
