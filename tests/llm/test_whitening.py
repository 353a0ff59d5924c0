"""Whitening against numpy's eigenvectors and exact integers."""

import numpy as np
import pytest

from rookery.llm import whitening as w

SCHEMA = "vec_id long, embedding array<double>, ints string, w string, dims int"


def ints(rows):
    return [(i, np.floor(256 * np.array(x, np.float64)).astype(int)) for i, x in rows if x and all(c is not None and np.isfinite(c) for c in x)]


def brute(rows, k=4):
    kept = ints(rows)
    fit = np.unique([x for _, x in kept], axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    out = {}
    for i, x in kept:
        for c in range(k):
            value = (x - sums / n) @ vectors[:, -1 - c] / np.sqrt(values[-1 - c])
            out.setdefault((i, c + 1), []).append((n, int(((n * x - sums) ** 2).sum()), value, values[-1 - c] / np.trace(v)))
    return out


def held(got, rows, k=4):
    want = brute(rows, k)
    assert len(got) == sum(map(len, want.values()))
    signs = {}
    for r in got:
        n, deviation, value, explained = want[r.vec_id, r.component][0]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(explained, rel=1e-9)
        assert abs(r.whitened) == pytest.approx(abs(value), rel=1e-7, abs=1e-7)
        if abs(value) > 1e-3:
            signs.setdefault(r.component, set()).add(np.sign(r.whitened * value))
    assert all(len(s) == 1 for s in signs.values())
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_whole_table(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    held(w.report(vectors).collect(), rows)


def test_odd_rows_copies_and_clashing_columns(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=7) * [9, 6, 4, 3, 1, 1, 1] + 100).tolist()) for i in range(60)]
    rows += [(200 + i, rows[0][1]) for i in range(90)] + [(5, rows[5][1]), (None, rows[6][1])]
    odd = [(300, None), (301, []), (302, [1.0, None, *[1.0] * 5]), (303, [float("nan")] * 7), (304, [float("inf")] * 7), (305, [1.0, 2.0])]
    frame = spark.createDataFrame([(i, x, "a", "b", 1) for i, x in rows + odd], SCHEMA)
    held(w.report(frame).collect(), rows)


def test_nothing_to_whiten(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0], "", "", 0)] * 3, SCHEMA)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for empty in (frame, frame.limit(0), frame.where("vec_id is null")):
        assert w.report(empty).columns == names and not w.report(empty).collect()
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0], "", "", 0) for i in range(5)], SCHEMA)
    assert {r.component for r in w.report(flat).collect()} == {1}  # rank one


@pytest.mark.parametrize("values", [np.arange(1, 31.0), [5.0] * 10 + [1.0] * 20, [1e9, 1e9 - 1e-3, 1, 1e-3, 1e-6, 0, 0], [3.0]])
def test_components_of_known_spectra(values):
    values = np.array(values)
    q, _ = np.linalg.qr(np.random.default_rng(4).standard_normal((len(values),) * 2))
    v = q * values @ q.T
    v = (v + v.T) / 2
    for k in (1, 4, 12):
        found, rows = w.leading(v, k)
        want = np.sort(values[values > len(v) ** 2 * 3e-16 * np.abs(v).max()])[::-1][:k]
        assert np.allclose(found, want, rtol=0, atol=1e-12 * values.max())
        assert np.allclose(rows @ rows.T, np.eye(len(rows)), atol=1e-13)
        assert np.abs(v @ rows.T - rows.T * found).max() < 1e-12 * values.max() * len(v)


def test_inertia_counts_every_eigenvalue():
    rng = np.random.default_rng(5)
    for size in (1, 2, 3, 8, 40):
        a = rng.integers(-3, 4, (size, size)).astype(float)
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        bands = w.tridiagonal(a)
        for shift in rng.uniform(-10, 10, 30):
            assert w.count_above(bands, shift) == (values > shift).sum()


def test_products_are_exact_for_any_size():
    for top in (10, 2**25, 2**30, 2**45):
        y = np.random.default_rng(6).integers(-top, top, (50, 3))
        assert (w.products(y) == y.astype(object).T @ y.astype(object)).all()
