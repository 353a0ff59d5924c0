"""Top-k against brute force, and the bound that prunes."""

import numpy as np

from rookery.llm import vector_topk as v


def brute(rows, queries, k):
    sound = [(i, np.floor(np.array(x, np.float64) * 256).astype(int)) for i, x in rows if i is not None and x and all(c is not None and np.isfinite(c) for c in x)]
    found = []
    for q, x in sound:
        if q in queries:
            scores = sorted((-int(x @ y), i) for i, y in sound if i != q and len(y) == len(x))[:k]
            found += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores)]
    return sorted(found)


def test_whole_table(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    got = v.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, {i for i, _ in rows if i % 50 == 0}, 5)


def test_many_small_blocks_with_ties(spark, monkeypatch):
    monkeypatch.setattr(v, "BLOCK_ROWS", 40)
    monkeypatch.setattr(v, "QUERY_ROWS", 7)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=33).round(1).tolist()) for i in range(300)] + [(1000 + i, [0.5] * 33) for i in range(150)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = v.top_k(vectors, vectors.where("vec_id % 10 = 0"), 5)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, {i for i, _ in rows if i % 10 == 0}, 5)


def test_unsound_rows_take_no_part(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (50, [1.0, 2.0]),
        (4, [1.0, -2.0]), (6, [3.0]), (None, [1.0, 1.0]), (100, []),
    ]
    vectors = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<float>, score int")
    got = v.top_k(vectors, vectors.where("vec_id % 50 = 0"), 2)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, {0, 50, 100}, 2)
    assert v.top_k(vectors.limit(0), vectors.limit(0), 2).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(2)
    a, b = rng.integers(-300, 300, (2, 50, 64)).astype(float)
    for starts in v.levels(64):
        bound = v.statistics(a, starts) @ v.statistics(b, starts).T
        assert (bound + 1e-6 >= a @ b.T).all()


def test_strongly_negative_scores_ties_and_repeated_queries(spark, monkeypatch):
    monkeypatch.setattr(v, "BLOCK_ROWS", 5)
    rng = np.random.default_rng(4)
    rows = [(i, (10 + rng.normal(size=64) * 0.01).tolist()) for i in range(1, 25)] + [(100 + i, [10.0] * 64) for i in range(12)]
    asked = [(0, [-10.0] * 64), (50, [-1000.0] * 64), (0, [-10.0] * 64), (0, [-9.0] * 64)]
    vectors = spark.createDataFrame(rows + asked, "vec_id long, embedding array<double>")
    queries = vectors.where("vec_id % 50 = 0 and vec_id < 100")
    got = sorted(tuple(r) for r in v.top_k(vectors, queries, 5).collect())
    candidates = rows + [(50, asked[1][1]), (0, asked[0][1]), (0, asked[2][1]), (0, asked[3][1])]
    want = []
    for q, x in ((0, asked[0][1]), (50, asked[1][1])):
        a = np.floor(np.array(x) * 256).astype(int)
        scores = sorted((-int(a @ np.floor(np.array(y) * 256).astype(int)), i) for i, y in candidates if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    assert got == want


def test_huge_components_are_exact_or_the_ends_of_a_long(spark):
    rows = [(0, [1e12, 1.0]), (1, [2.0, 3.0]), (2, [1e15, 0.0]), (3, [-1e15, 0.0]), (4, [1e300, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.score for r in v.top_k(vectors, vectors.where("vec_id = 0"), 5).collect()}
    assert got == {1: 256 * 10**12 * 512 + 256 * 768, 2: 2**63 - 1, 3: -(2**63), 4: 2**63 - 1}
