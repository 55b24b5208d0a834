"""Whitening against exact whole numbers and plain double or rational arithmetic."""

from fractions import Fraction

import numpy as np
import plans
import pytest
import tables

from sparktally.llm import whiten

SCHEMA = "vec_id long, embedding array<float>"


def symmetric(values, seed):
    """A matrix with these eigenvalues, and its eigenvectors, in extended precision."""
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0].astype(np.longdouble)
    for _ in range(3):  # orthogonal to extended precision
        q = q + q @ (np.eye(len(values)) - q.T @ q) / 2
    return (q * np.asarray(values, np.longdouble)) @ q.T, q


def test_products_are_exact_beyond_double():
    rng = np.random.default_rng(0)
    a, b = ((rng.normal(size=(7, 7)) * 10.0 ** rng.integers(-9, 9, (7, 7))).astype(np.longdouble) for _ in range(2))
    got = whiten.product(a, b)
    for i in range(7):
        for j in range(7):
            want = sum(Fraction(float(x)) * Fraction(float(y)) for x, y in zip(a[i].astype(float), b[:, j].astype(float)))
            size = 7 * float(np.abs(a[i]).max() * np.abs(b[:, j]).max())
            assert abs(Fraction(float(got[i, j])) + Fraction(float(got[i, j] - np.longdouble(float(got[i, j])))) - want) <= size * 2.0 ** -62
    assert not whiten.product(np.zeros((2, 3), np.longdouble), np.zeros((3, 2), np.longdouble)).any()


@pytest.mark.parametrize("values", [
    [9.0, 4.0, 2.5, 1.0, 0.3, 0.01],
    [1.0, 1 - 1e-9, 1 - 2e-9, 0.5, 0.5 - 1e-12, 0.2],  # nearer than float32 can tell
    [1e6, 3.0, 2.0, 1e-3, 1e-4, 1e-6],
    list(np.linspace(100, 1, 64)),
])
def test_eigenvectors_to_double_precision(values):
    a, q = symmetric(values, len(values))
    found, x = whiten.eigenvectors(a)
    assert np.abs(found - np.array(values)).max() <= 4e-16 * values[0]
    distances = np.abs(np.subtract.outer(values, values)) + np.diag([np.inf] * len(values))
    allowed = 4e-16 + 1e-18 * values[0] / distances.min(1)
    assert (np.abs(x - q * np.sign((q * x).sum(0))).max(0).astype(float) <= allowed * len(values)).all()


def test_float32_alone_is_not_enough_and_clusters_need_their_own_solution():
    a, q = symmetric([1.0, 1 - 1e-9, 1 - 2e-9, 0.5, 0.2], 4)
    first = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]
    assert np.abs(np.abs((q * first).sum(0)) - 1).max() > 1e-3
    _, x, took = whiten.refined(a, first)
    assert np.abs(np.abs((q * x).sum(0)) - 1).max() < 1e-16 and took < whiten.ROUNDS


def test_multiple_eigenvalues_give_some_orthogonal_vectors():
    a, _ = symmetric([2.0, 2.0, 2.0, 1.0, 0.0, 0.0], 1)
    values, x = whiten.eigenvectors(a)
    assert np.allclose(values, [2, 2, 2, 1, 0, 0], atol=1e-15)
    assert np.abs(x.T @ x - np.eye(6)).max() < 1e-15 and np.abs(a @ x - x * values).max() < 2e-15


def plain(rows, components):
    """n, deviations, whitened and explained, by numpy in double and exact whole numbers."""
    good = [(k, [int(np.floor(64 * float(np.float32(c)))) + 1000000 for c in v]) for k, v in rows
            if v and all(c is not None and np.isfinite(c) for c in v)]
    n = len(good)
    sums = [sum(col) for col in zip(*[x for _, x in good])]
    deviation = {}
    for k, x in good:
        deviation.setdefault(k, []).append(sum((n * a - s) ** 2 for a, s in zip(x, sums)))
    y = np.array([[float(Fraction(a) - Fraction(s, n)) for a, s in zip(x, sums)] for _, x in good])
    v = y.T @ y / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    return n, deviation, [k for k, _ in good], y @ q[:, :components] / np.sqrt(e[:components]), e / np.trace(v)


def vectors(n, width, seed):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=width) * np.linspace(1, 0.1, width)).astype(np.float32).tolist()) for i in range(n)]


def test_equals_plain_arithmetic(spark):
    rows = vectors(400, 12, 3) + [(7, vectors(1, 12, 9)[0][1])] * 3 + [
        (1000, None), (1001, [None] * 12), (1002, [float("nan")] * 12), (1003, [float("inf")] + [0.0] * 11), (1004, []),
        (None, vectors(1, 12, 8)[0][1])]
    got = whiten.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5), components=8).collect()
    n, deviation, keys, whitened, explained = plain(rows, 8)
    assert len(got) == n * 8 and {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, 9))
    found = {}
    for r in got:
        found.setdefault((r.vec_id, int(r.deviation)), {}).setdefault(r.component, set()).add(r.whitened)
    assert {k for k, _ in found} == set(keys) and {d for _, d in found} == {d for ds in deviation.values() for d in ds}
    signs = None
    for k, z in zip(keys, whitened):
        if k in (7, None):
            continue
        mine = np.array([next(iter(found[k, deviation[k][0]][c])) for c in range(1, 9)])
        signs = np.sign(mine * z) if signs is None else signs
        assert np.allclose(mine, z * signs, rtol=0, atol=1e-11)
    assert np.allclose([r.explained for r in got if r.vec_id == 0], explained[:8], rtol=1e-12)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-12


def test_deviations_beyond_a_long_are_exact():
    x = np.array([[2**60, -3], [5, 7]], np.int64)
    centre = whiten.Centre(10**6, [2**60 + 5, 4])
    want = [sum((10**6 * int(a) - s) ** 2 for a, s in zip(row, centre.sums)) for row in x]
    assert centre.deviations(x) == want and want[0] > 1 << 63


def test_extreme_and_unlike_vectors(spark):
    rows = [(1, [1e30, 0.0]), (2, [1.0, 2.0]), (3, [1e15, -1e15]), (4, [1.0, 2.0, 3.0]), (5, [0.5, 1e-38])]
    got = whiten.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted({r.vec_id for r in got}) == [2, 3, 5] and {r.n for r in got} == {3}
    x = {k: [int(np.floor(64 * float(np.float32(c)))) + 1000000 for c in v] for k, v in rows if k in (2, 3, 5)}
    sums = [sum(c) for c in zip(*x.values())]
    want = {k: sum((3 * a - s) ** 2 for a, s in zip(v, sums)) for k, v in x.items()}
    assert {(r.vec_id, int(r.deviation)) for r in got} == set(want.items())


def test_without_variance(spark):
    got = whiten.whiten(spark.createDataFrame([(1, [0.5, 0.25])] * 4, SCHEMA)).collect()
    assert len(got) == 8 and {(int(r.deviation), r.whitened, r.explained, r.identity_error) for r in got} == {(0, None, None, None)}
    got = whiten.whiten(spark.createDataFrame([(i, [float(i), 1.0, 0.0]) for i in range(9)], SCHEMA)).collect()
    assert {r.component for r in got if r.whitened is None} == {2, 3} and {r.explained for r in got} == {1.0, 0.0}


def test_no_rows_and_extra_columns(spark):
    assert whiten.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whiten.whiten(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).count() == 0
    some = spark.createDataFrame(vectors(20, 3, 1), SCHEMA).selectExpr(
        "*", "'own' AS n", "'own' AS key", "'own' AS vector", "'own' AS component", "1 AS row", "2 AS part")
    got = whiten.whiten(some)
    assert got.count() == 60 and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_rows_are_not_shuffled(spark):
    got = whiten.whiten(spark.createDataFrame(vectors(50, 4, 2), SCHEMA).repartition(6))
    got.count()
    assert plans.executed(got)["ShuffleExchangeExec"] <= 1  # the test's own
