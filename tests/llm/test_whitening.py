"""The qd solver against a library's singular values, whitening against plain numpy, odd inputs."""

import numpy as np
import pytest

from homespan.llm import whitening

VECTORS = "vec_id long, embedding array<double>, x long, n string, whitened double"


def matrices():
    draw = np.random.default_rng(5)
    for size in (1, 2, 3, 7, 40):
        plain = draw.standard_normal((size + 9, size))
        yield f"plain {size}", plain
        yield f"graded {size}", plain * 10.0 ** draw.integers(-6, 6, size)
        yield f"equal {size}", 3 * np.linalg.qr(plain)[0]
        yield f"pairs {size}", np.repeat(plain, 2, axis=1)
        yield f"flat {size}", np.round(plain) * (np.arange(size) > 0)
        yield f"close {size}", np.linalg.qr(plain)[0] * (1 + 1e-9 * np.arange(size))


@pytest.mark.parametrize(("name", "rows"), list(matrices()), ids=[n for n, _ in matrices()])
def test_solver(name, rows):
    r = whitening.triangle([rows[:3], rows[3:]])
    values, axes, trace = whitening.principal_axes(r, 16)
    true = np.linalg.svd(rows, compute_uv=False) ** 2
    true = true[true > whitening.RANK * true[0]][:16] if true[0] else true[:0]
    assert len(values) == len(true)
    if len(true):
        np.testing.assert_allclose(values, true, rtol=1e-11)
        assert trace == pytest.approx((rows**2).sum(), rel=1e-12)
        np.testing.assert_allclose(axes.T @ axes, np.eye(len(true)), atol=1e-9)
        white = rows @ axes / np.sqrt(values)
        np.testing.assert_allclose(white.T @ white, np.eye(len(true)), atol=1e-8)


def test_bidiagonal_keeps_the_product():
    rows = np.random.default_rng(6).standard_normal((12, 12))
    diagonal, above, right = whitening.bidiagonal(rows)
    b = np.diag(diagonal) + np.diag(above, 1)
    np.testing.assert_allclose(right @ b.T @ b @ right.T, rows.T @ rows, atol=1e-12)


def test_small_values_to_high_relative_accuracy():
    """A graded bidiagonal, whose least value a method working on the square would lose."""
    diagonal, above = np.array([1e8, 1e4, 1.0, 1e-4]), np.array([1e7, 1e3, 1e-1])
    values = whitening.dqds(diagonal**2, above**2)
    assert np.prod(values) == pytest.approx(np.prod(diagonal**2), rel=1e-12)
    assert values.sum() == pytest.approx((diagonal**2).sum() + (above**2).sum(), rel=1e-12)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in rows], VECTORS)


def plain(rows, most=16):
    x = np.array([np.floor(64 * np.array(v)) + 1_000_000 for _, v in rows], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    return x, n, sums, values, (x - sums / n) @ axes / np.sqrt(values)


@pytest.mark.parametrize("size", [3, 24])
def test_same_as_plain(spark, monkeypatch, size):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "BLOCK", 16)
    draw = np.random.default_rng(7)
    mixing = draw.standard_normal((size, size))
    rows = [(i, (draw.standard_normal(size) @ mixing).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)] + [(None, rows[5][1]), (4, rows[9][1])]
    got = whitening.whiten(frame(spark, rows).repartition(7), 16).collect()
    x, n, sums, values, white = plain(rows)
    wide = min(16, size)
    assert len(got) == len(rows) * wide
    squares = lambda own: int(((n * own - sums) ** 2).sum())
    deviation = {}
    for (vec_id, _), own in zip(rows, x, strict=True):
        deviation.setdefault(vec_id, set()).add(squares(own))
    total = np.trace(np.cov(np.unique(x, axis=0).T, bias=True))
    for k in range(wide):
        of = {}
        for (vec_id, _), y in zip(rows, white[:, k], strict=True):
            of.setdefault(vec_id, []).append(y)
        mine = {}
        for r in got:
            if r["component"] == k + 1:
                assert r["n"] == n and int(r["deviation"]) in deviation[r["vec_id"]]
                assert r["explained"] == pytest.approx(values[k] / total, rel=1e-9) and r["identity_error"] < 1e-9
                mine.setdefault(r["vec_id"], []).append(r["whitened"])
        sign = np.sign(of[0][0] * mine[0][0])
        for vec_id, ys in of.items():
            np.testing.assert_allclose(sorted(ys), sorted(sign * y for y in mine[vec_id]), atol=1e-7)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    dropped = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [1.0, inf]), (6, [1.0]), (7, [1e300, 1.0])]
    kept = [(10, [1.0, 2.0]), (11, [2.0, 4.0]), (12, [3.0, 6.0]), (13, [3.0, 6.0])]
    got = whitening.whiten(frame(spark, dropped + kept)).collect()
    assert sorted((r["vec_id"], r["component"], r["n"]) for r in got) == [(i, 1, 3) for i in (10, 11, 12, 13)]
    assert all(r["explained"] == pytest.approx(1.0) for r in got)


def test_no_spread_no_rows(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0


def test_large_entries_stay_exact(spark):
    rows = [(1, [2.0**40, 0.0]), (2, [-(2.0**40), 1.0]), (3, [5.0, 2.0])]
    got = whitening.whiten(frame(spark, rows)).filter("component = 1").collect()
    x = [[64 * 2**40 + 10**6, 10**6], [-64 * 2**40 + 10**6, 64 + 10**6], [320 + 10**6, 128 + 10**6]]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = {i + 1: sum((3 * a - s) ** 2 for a, s in zip(own, sums, strict=True)) for i, own in enumerate(x)}
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == want
