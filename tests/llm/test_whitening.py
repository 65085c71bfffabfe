import math

import numpy as np
import pytest

from sonomart.llm import bidiagonal, whitening


def brute(rows, components=4):
    """By length: (n, sums, eigenvalues, eigenvectors as columns, trace) of the distinct vectors."""
    ok = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    out = {}
    for dim in {len(x) for _, x in ok}:
        x = np.array(sorted({x for _, x in ok if len(x) == dim}), dtype=np.longdouble)
        centred = (x - x.mean(axis=0)).astype(float)
        values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
        out[dim] = len(x), x.sum(axis=0), values[::-1][:components], vectors[:, ::-1][:, :components], values.sum()
    return ok, out


def check(spark, rows, tolerance=1e-9):
    df = spark.createDataFrame([(i, v, 9, 9) for i, v in rows], "vec_id long, embedding array<double>, x int, dim int")
    got = whitening.apply(df, whitening.fit(df)).collect()
    ok, want = brute(rows)
    assert len(got) == sum(min(4, len(x)) for _, x in ok)
    by_vector = {}
    for r in got:
        by_vector.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    for i, x in ok:
        n, sums, values, vectors, trace = want[len(x)]
        for c, some in by_vector[i].items():
            r = some[0]
            assert r.n == n and int(r.deviation) == sum((n * a - int(s)) ** 2 for a, s in zip(x, sums))
            assert r.explained == pytest.approx(values[c - 1] / trace, rel=1e-9)
            one = abs(float((np.array(x, np.longdouble) - sums / n) @ vectors[:, c - 1]) / math.sqrt(values[c - 1]))
            assert abs(r.whitened) == pytest.approx(one, abs=tolerance)
            assert r.identity_error < 1e-9
    # One sign for all rows.
    for dim, (n, sums, values, vectors, _) in want.items():
        for c in range(len(values)):
            pairs = [(by_vector[i][c + 1][0].whitened, float((np.array(x) - sums / n) @ vectors[:, c])) for i, x in ok if len(x) == dim]
            signs = {np.sign(a * b) for a, b in pairs if abs(b) > 1e-6 * math.sqrt(values[c])}
            assert len(signs) == 1


def test_equals_brute_force_with_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    spread = np.array([5, 3, 2, 1, .5, .25, .2])
    rows = [(i, (rng.normal(size=7) * spread + 40).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]
    rows += [(2000 + i, (rng.normal(size=2) * [3, 1]).tolist()) for i in range(30)]
    rows += [(3000, None), (3001, []), (3002, [1.0, None]), (3003, [float("nan")] * 7), (3004, [float("-inf")] * 7)]
    check(spark, rows)


def test_far_from_the_origin(spark):
    rng = np.random.default_rng(4)
    check(spark, [(i, (rng.normal(size=5) * [9, 7, 5, 3, 1] + 1e9).tolist()) for i in range(200)])


def test_rank_one_single_vector_and_empty_table(spark):
    schema = "vec_id long, embedding array<float>"
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, -float(i)]) for i in range(20)] + [(None, [0.0, 0.0, 0.0])], schema)
    got = whitening.apply(line, whitening.fit(line)).collect()
    assert len(got) == 63
    assert all((r.whitened is None) == (r.component > 1) for r in got)
    assert all(r.explained == pytest.approx(float(r.component == 1)) and r.identity_error < 1e-12 for r in got)
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1e300, 0.0])], "vec_id long, embedding array<double>")
    got = whitening.apply(one, whitening.fit(one)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(1, 0, None, None, None)] * 4
    assert whitening.apply(line.limit(0), whitening.fit(line.limit(0))).count() == 0


def test_huge_entries_stay_exact(spark):
    rows = [(i, [float((-1) ** i * (1 << 54)), float(i * 3), 1.0 * (i % 5)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    xs = [[math.floor(256 * c) for c in v] for _, v in rows]
    sums = [sum(x[j] for x in xs) for j in range(3)]
    got = {r.vec_id: r for r in whitening.apply(df, whitening.fit(df)).collect()}
    exact = [sum((40 * a - s) ** 2 for a, s in zip(x, sums)) for x in xs]
    assert all((got[i].deviation is None) == (e >= 10**38) and (e >= 10**38 or got[i].deviation == e) for i, e in enumerate(exact))


def test_factors_merge_up_the_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * [6, 5, 4, 3, 2, 1]).tolist()) for i in range(400)]
    found = whitening.fit(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))[6]
    _, want = brute(rows)
    assert found.variances == pytest.approx(want[6][2], rel=1e-12)


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1], [1, 1, 1, 1, 1, .5, .1], [1, 1 - 1e-12, 1 - 2e-12, 1 - 3e-12, .4, .3, .2], [3, 1, 0, 0, 0],
                                    [1, 1e-6, 1e-9, 1e-12, 1e-14]])
def test_solver_on_close_equal_and_small_values(values):
    rng = np.random.default_rng(6)
    d = len(values)
    left, right = (np.linalg.qr(rng.normal(size=(d, d)))[0] for _ in range(2))
    m = left @ np.diag(values) @ right
    squares, vectors = bidiagonal.largest(m, 4)
    assert squares == pytest.approx(np.sort(np.linalg.svd(m)[1])[::-1][:4] ** 2, rel=1e-6, abs=1e-28)
    assert np.abs(vectors @ vectors.T - np.eye(4)).max() < 1e-10
    assert np.abs(m.T @ m @ vectors.T - vectors.T * squares).max() < 1e-13


def test_solver_finds_small_values_of_a_graded_bidiagonal_accurately():
    a, b = 10.0 ** -np.arange(12), 10.0 ** -np.arange(11) / 3
    product = 1.0
    for v in bidiagonal.squares(a, b):
        product *= v
    assert product == pytest.approx(float(np.prod((a * a).astype(np.longdouble))), rel=1e-12)
