"""Recall against brute force, exact scores, and the parts the index is made of."""

import numpy as np
import pytest
from churnkit.llm import learned_index as L


def brute(ids, vectors, queries, k):
    out = {}
    for q in queries:
        point = vectors[list(ids).index(q)]
        far = np.sqrt(((vectors - point) ** 2).sum(1))
        out[q] = [(float(far[i]), int(ids[i])) for i in np.lexsort((ids, far)) if ids[i] != q][:k]
    return out


def found_of(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    return {q: [(s, v) for _, s, v in sorted(rows)] for q, rows in out.items() if [r for r, _, _ in sorted(rows)] == list(range(1, len(rows) + 1))}


def frame(spark, ids, vectors):
    rows = [(int(i), None if v is None else [None if x is None else float(x) for x in v], 7) for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")


@pytest.mark.parametrize("kind", ["clusters", "random"])
def test_recall_and_scores(spark, kind, monkeypatch):
    monkeypatch.setattr(L, "CELL_ROWS", 300)
    rng = np.random.default_rng(1)
    n, d = 3000, 12
    vectors = rng.standard_normal((n, d)).astype(np.float32)
    if kind == "clusters":
        vectors = (vectors * 0.2 + rng.standard_normal((20, d))[rng.integers(0, 20, n)] * 2).astype(np.float32)
    vectors[1000:2000] = vectors[7]  # a third of all rows is one vector
    got = found_of(L.nearest_neighbours(frame(spark, np.arange(n), vectors)))
    want = brute(np.arange(n), vectors.astype(np.float64), range(0, n, 100), 10)
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    for q, rows in got.items():
        point = vectors[q].astype(np.float64)
        assert rows == sorted(rows)
        assert all(s == np.sqrt(((vectors[v].astype(np.float64) - point) ** 2).sum()) for s, v in rows)
    hits = sum(len({v for _, v in got[q]} & {v for _, v in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.9
    copies = [q for q in want if 1000 <= q < 2000]
    assert all(got[q] == want[q] for q in copies)


@pytest.mark.parametrize("kind", ["doubled", "one id 20 times", "20 vectors of one id"])
def test_repeated_rows_cost_no_neighbours(spark, kind):
    """A table too small for more than one cell, so the answer is exact."""
    rng = np.random.default_rng(3)
    ids, vectors = np.arange(60), rng.standard_normal((60, 4)).astype(np.float32)
    vectors[1] = vectors[0] + np.float32(0.001)
    want = brute(ids, vectors.astype(np.float64), [0], 10)
    more = {"doubled": (ids, vectors), "one id 20 times": (np.full(20, 1), vectors[[1] * 20]),
            "20 vectors of one id": (np.full(20, 1), vectors[0] + np.float32(0.002) * np.arange(1, 21, dtype=np.float32)[:, None])}[kind]
    got = found_of(L.nearest_neighbours(frame(spark, np.concatenate([ids, more[0]]), np.concatenate([vectors, more[1]]))))
    assert [v for _, v in got[0]] == [v for _, v in want[0]] and len(got[0]) == 10


def test_given_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = df.collect()
    got = found_of(L.nearest_neighbours(df))
    want = brute(np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64), [r.vec_id for r in rows if r.vec_id % 100 == 0], 10)
    assert got.keys() == want.keys()
    hits = sum(len({v for _, v in got[q]} & {v for _, v in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 0], [0, 0], [nan, 1], [inf, 1], None, [None, 1], [2, 0], [1, 1, 1], [3, 0], [], [3, 0]]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 8]
    got = found_of(L.nearest_neighbours(frame(spark, ids, vectors), every=2))
    assert got == {0: [(1.0, 6), (2.0, 8)], 6: [(1.0, 0), (1.0, 8)], 8: [(1.0, 6), (2.0, 0)]}
    df = frame(spark, ids, vectors)
    assert L.nearest_neighbours(df.limit(0)).count() == 0
    assert L.nearest_neighbours(df.where("vec_id in (1, 2, 4)")).count() == 0
    assert L.nearest_neighbours(df.where("vec_id = 0")).count() == 0


def test_cut_is_balanced_and_crosses_few_edges():
    rng = np.random.default_rng(0)
    points = rng.standard_normal((1200, 4)) * 0.3 + 5 * rng.standard_normal((6, 4))[np.repeat(np.arange(6), 200)]
    near = L.nearest_in(points, points, 8, np.arange(1200))
    part = L.cut_graph(near, 6)
    sizes = np.bincount(part, minlength=6)
    assert sizes.max() <= 1.06 * 200 and sizes.min() >= 0.9 * 200
    crossing = (part[near] != part[:, None]).mean()
    shuffled = rng.permutation(part)
    assert crossing < 0.2 < 0.7 < (shuffled[near] != shuffled[:, None]).mean()
