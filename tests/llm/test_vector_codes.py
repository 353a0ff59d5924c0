"""Codes against plain rounds in Python integers, and the pruning against full evaluation."""

import hashlib
from math import floor

import numpy as np

from rookery.llm import vector_codes as c

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string, away string, of int"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, [floor(scale * v) for v in x], label) for i, x, label in rows if x and all(v is not None and np.isfinite(v) for v in x)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dims = len(kept[0][1])
    spans = [(dims * p // parts, dims * (p + 1) // parts) for p in range(parts)]
    book = [[x[a:b] for _, x, _ in kept[:entries]] for a, b in spans]

    def best(p, x):
        a, b = spans[p]
        return min((sum((u - v) ** 2 for u, v in zip(x[a:b], entry)), e) for e, entry in enumerate(book[p]))

    for _ in range(rounds):
        new = [list(entry) for entry in book]
        for p, (a, b) in enumerate(spans):
            groups = {}
            for _, x, _ in kept:
                groups.setdefault(best(p, x)[1], []).append(x[a:b])
            for e, members in groups.items():
                new[p][e] = [sum(column) // len(members) for column in zip(*members)]
        book = new
    coded = [(i, label, [best(p, x) for p in range(parts)]) for i, x, label in kept]
    total = {}
    for _, label, found in coded:
        total[label] = total.get(label, 0) + sum(d for d, _ in found)
    sha = hashlib.sha256(",".join(str(v) for b in book for entry in b for v in entry).encode()).hexdigest()
    return sorted(((i, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), total[label], sha) for i, label, f in coded), key=str)


def test_whole_table(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    assert sorted(map(tuple, c.compress(vectors).collect()), key=str) == brute(rows)


def test_ties_odd_rows_and_clashing_columns(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-2, 3, 11).astype(float).tolist(), int(i % 3) or None) for i in range(120)]
    rows += [(7, rows[0][1], 1)] * 40 + [(None, rows[3][1], None)]
    odd = [(1000, None, 1), (1001, [], 1), (1002, [1.0, None] + [0.0] * 9, 2), (1003, [float("-inf")] * 11, 2), (1004, [1.0], 2)]
    frame = spark.createDataFrame([(*r, "a", "b", "c", 4) for r in rows + odd], SCHEMA)
    assert sorted(map(tuple, c.compress(frame, scale=1).collect()), key=str) == brute(rows, scale=1)


def test_few_rows_huge_numbers_and_none(spark):
    frame = spark.createDataFrame([(i, [i * 1e13, 1.0, -2.0, i + 0.5], 1, "", "", "", 0) for i in range(5)], SCHEMA)
    rows = [(r.vec_id, r.embedding, r.label) for r in frame.collect()]
    got = c.compress(frame, parts=2, entries=3).collect()
    want = brute(rows, parts=2, entries=3)
    assert [(r.vec_id, r.code) for r in sorted(got)] == [r[:2] for r in want]
    assert {r.error for r in got if r.error is not None} <= {r[2] for r in want} and any(r.error is None for r in got)
    assert c.compress(frame.limit(0)).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert not c.compress(frame.where("vec_id < 0")).collect()


def test_pruning_changes_nothing_and_saves_evaluations():
    rng = np.random.default_rng(2)
    entries = rng.integers(-4000, 4000, (16, 8))
    for points in (rng.integers(-4000, 4000, (500, 8)), entries[rng.integers(0, 16, 500)] + rng.integers(-200, 200, (500, 8))):
        pivots = c.fixed_pivots(entries, 4)
        code, away, made = c.nearest(points, c.distances(points, pivots), entries, pivots)
        full = ((points[:, None] - entries) ** 2).sum(axis=2)
        assert (code == full.argmin(axis=1)).all() and (away == full.min(axis=1)).all()
        assert made < full.size
    assert made < full.size / 3
