"""Recall against brute force, exact scores, and the error bound of the codes."""

import numpy as np
import pytest

from rookery.llm import bit_codes as b

SCHEMA = "vec_id long, embedding array<double>, rank string, ids string, code int"


def brute(rows, queries, k):
    sound = [(i, np.array(x, np.float64)) for i, x in rows if i is not None and x and all(v is not None and np.isfinite(v) for v in x) and np.any(x)]
    out = {}
    for q in sorted({i for i, _ in sound if i in queries}):
        x = min(tuple(v) for i, v in sound if i == q)
        out[q] = sorted((-float(np.array(x) @ y), i) for i, y in sound if i != q)[:k]
    return out


def recall(got, want, exact):
    by_query = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append(r)
    assert by_query.keys() == {q for q, found in want.items() if found}
    hits = total = 0
    for q, found in by_query.items():
        assert [r.rank for r in found] == list(range(1, len(want[q]) + 1))
        for r in found:
            assert any(r.score == pytest.approx(s, rel=1e-13, abs=1e-13) for s in exact(q, r.vec_id))
        keys = [(-r.score, r.vec_id) for r in found]
        assert keys == sorted(keys)
        hits += len({r.vec_id for r in found} & {i for _, i in want[q]})
        total += len({i for _, i in want[q]})
    return hits / total


def of(rows):
    def exact(q, i):
        mine = [np.array(x) for j, x in rows if j == q and x]
        return [float(m @ np.array(x)) for m in mine for j, x in rows if j == i and x and len(x) == len(m)]

    return exact


def test_whole_table(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    got = b.search(vectors, vectors.where("vec_id % 20 = 0"), 20).collect()
    assert recall(got, brute(rows, {i for i, _ in rows if i % 20 == 0}, 20), of(rows)) > 0.99


@pytest.mark.parametrize("centre,spread", [(0, 1), (50, 0.1)])
def test_many_blocks_copies_and_clusters(spark, monkeypatch, centre, spread):
    monkeypatch.setattr(b, "CODE_ROWS", 60)
    monkeypatch.setattr(b, "QUERY_ROWS", 9)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=24) * spread + centre + (i % 3)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)] + [(20, rows[20][1])] * 2
    vectors = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    got = b.search(vectors, vectors.where("vec_id % 20 = 0"), 20).collect()
    want = brute(rows, {i for i, _ in rows if i % 20 == 0}, 20)
    assert recall(got, want, of(rows)) > 0.95


def test_copies_come_by_smallest_id(spark):
    vectors = spark.createDataFrame([(i, [3.0, 4.0], "", "", 0) for i in range(50)] + [(99, [1.0, 0.0], "", "", 0)], SCHEMA)
    got = b.search(vectors, vectors.where("vec_id = 2 or vec_id = 99"), 4).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [
        (2, 1, 0, 25.0), (2, 2, 1, 25.0), (2, 3, 3, 25.0), (2, 4, 4, 25.0), (99, 1, 0, 3.0), (99, 2, 1, 3.0), (99, 3, 2, 3.0), (99, 4, 3, 3.0),
    ]


def test_unsound_rows_take_no_part(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (20, [1e30, -2e30]),
        (4, [1.0, -2.0]), (6, [3.0]), (None, [1.0, 1.0]), (40, []), (60, [0.0, 0.0]),
    ]
    vectors = spark.createDataFrame([(*r, "", "", 7) for r in rows], SCHEMA)
    got = b.search(vectors, vectors.where("vec_id % 20 = 0"), 3).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(0, 1, 4), (0, 2, 20), (20, 1, 4), (20, 2, 0)]
    assert not b.search(vectors.limit(0), vectors.limit(0), 3).collect()
    assert not b.search(vectors, vectors.limit(0), 3).collect()


def test_error_bound_holds_as_often_as_promised():
    rng = np.random.default_rng(4)
    vectors, queries = rng.normal(size=(800, 32)) + 0.3, rng.normal(size=(40, 32))
    centre = vectors.mean(axis=0)
    codes, length, own = b.encode(vectors, centre, 128)
    estimate, error = b.bounds(queries, centre, codes, length, own, (vectors - centre) @ centre, 1.9)
    missed = np.abs(estimate - queries @ vectors.T) > error
    assert missed.mean() < 0.07
    found, reranked = b.best_of_block(queries, np.full(40, -np.inf), vectors, (codes, length, own, (vectors - centre) @ centre), centre, 5, 1.9)
    assert reranked < vectors.shape[0] * len(queries) / 2  # the codes spare most exact products
    assert len(found) == 200
