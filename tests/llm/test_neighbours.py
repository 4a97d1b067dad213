"""Nearest neighbours against brute force."""

import numpy as np
from pyspark.sql import functions as F

from creditlens.llm.op4_neighbours import fit, search


def brute(rows, ask, k=5):
    rows = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and len(v) == 4 + 60 * (len(v) > 4) and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    ids, x = [i for i, _ in rows], np.array([v for _, v in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for n, i in enumerate(ids):
        if ask(i):
            s = x @ x[n]
            out[i] = sorted(((-round(float(a), 12), j) for a, j in zip(s, ids) if j != i))[:k]
    return out


def test_recall_and_scores(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in vectors.collect()], lambda i: i % 50 == 0)
    got = {}
    for r in search(vectors, vectors.filter("vec_id % 50 = 0"), leaf=16, calibrate=24).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got.keys() == want.keys()
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert [s for _, _, s in found] == sorted((s for _, _, s in found), reverse=True)
        exact = {j: -s for s, j in want[q]}
        hits += sum(j in exact for _, j, _ in found)
        assert all(abs(exact[j] - s) < 1e-12 for _, j, s in found if j in exact)
    assert hits / (5 * len(want)) >= 0.9


def test_odd_vectors(spark):
    same = [(i, [1.0, 0.0, 0.0, 0.0]) for i in range(0, 40)]
    rows = same + [(100, None), (150, []), (200, [0.0] * 4), (250, [1.0, None, 0.0, 0.0]), (300, [float("nan"), 1.0, 0.0, 0.0]), (350, [float("inf"), 1.0, 0.0, 0.0]),
                   (400, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0]), (450, [0.0, 1.0, 0.0, 0.0]), (500, [-1.0, -0.0, 0.0, 0.0]), (550, [1e200, 1e200, 0.0, 0.0]), (50, [2.0, 0.0, 0.0, 0.0]),
                   (0, [1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as leaf", "'x' as raw", "2 as q")
    got = {}
    for r in search(df, df.filter("vec_id % 50 = 0"), leaf=4).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 12)))
    want = brute(rows, lambda i: i % 50 == 0)
    assert {q: [(n + 1, j, -s) for n, (s, j) in enumerate(v)] for q, v in want.items()} == {q: sorted(v) for q, v in got.items()}
    assert search(df.limit(0), df).count() == 0
    assert search(df, df.limit(0)).count() == 0
    few = df.filter("vec_id in (450, 500, 550)")
    assert search(few, few).count() == 6


def test_blocks(spark, monkeypatch):
    import creditlens.llm.op4_neighbours as m

    monkeypatch.setattr(m, "BLOCK", 16)
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    ask = vectors.filter(F.col("vec_id") % 5 == 0)
    a = search(vectors, ask, leaf=100, recall=1.0).collect()
    monkeypatch.setattr(m, "BLOCK", 1 << 14)
    b = search(vectors, ask, leaf=100, recall=1.0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 12)) for r in a) == sorted((r.query_id, r.rank, r.vec_id, round(r.score, 12)) for r in b)


def test_tree_holds_every_leaf():
    x = np.random.default_rng(0).normal(size=(500, 8))
    t = fit(x, 4, 10)
    assert set(t.assign(x).tolist()) <= set(range(t.leaves()))
    assert sorted(t.visits(x[0], 10**6, np.ones(t.leaves()), 0)) == list(range(t.leaves()))
    assert fit(np.ones((50, 3)), 4, 10).leaves() == 1
