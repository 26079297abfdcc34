"""Polynomial support vector regression against direct solutions."""

import numpy as np
import pytest

from churnpanel.operators import support


def frame(spark, x, y, names):
    rows = [(k, *map(float, r), None if v is None else float(v)) for k, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "acc_id long, " + ", ".join(f"{c} double" for c in names) + ", amount_spent double")


def test_monomials():
    got = support.monomials(np.array([[2.0, 3.0]]), 3)
    assert got.tolist() == [[1, 2, 3, 4, 6, 9, 8, 12, 18, 27]]


def test_loss_is_flat_then_linear():
    loss, slope = support.insensitive_loss(np.array([0.05, -0.1, 0.6, -1.1]), 0.1)
    assert loss[:2].tolist() == [0, 0] and slope.tolist() == [0, 0, 1, -1]
    assert np.allclose(loss[2:], [0.5 - support.ROUNDING / 2, 1 - support.ROUNDING / 2])


def test_line_against_grid(spark):
    """Degree 1 with one column: no weight of a fine grid has a lower objective."""
    r = np.random.default_rng(3)
    x = r.normal(size=(120, 1))
    y = 3 * x[:, 0] + 1 + r.standard_t(2, size=120)
    model = support.fit_poly_svr(frame(spark, x, y, ["u"]).repartition(5), ["u"], degree=1, reg=0.05, tolerance=1e-7)
    u, v = (x[:, 0] - x.mean()) / x.std(), (y - y.mean()) / y.std()

    def objective(b, w):
        return support.insensitive_loss(b + w * u - v, 0.1)[0].mean() + 0.025 * w * w

    best = min(objective(b, w) for b in np.linspace(-1, 1, 81) for w in np.linspace(-1.5, 1.5, 121))
    assert objective(*model.weights) <= best + 1e-4


def test_held_out_and_outliers(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(400, 3))
    y = x[:, 0] * x[:, 1] + 0.5 * x[:, 2] ** 2
    spoiled = y.copy()
    spoiled[:12] += 60  # a squared loss would follow these
    model = support.fit_poly_svr(frame(spark, x[:300], spoiled[:300], "uvw"), list("uvw"), reg=1e-4, epsilon=0.01)
    got = {p.acc_id: p.p for p in model.predict(frame(spark, x, y, "uvw"), "p").collect()}
    error = np.mean([abs(got[k] - y[k]) for k in range(300, 400)])
    constant = np.mean(np.abs(y[300:] - np.median(y[:300])))
    assert len(got) == 400 and error < 0.35 * constant


def test_awkward_rows(spark):
    rows = frame(spark, [[1, 5], [2, 5], [3, 5]], [1, 2, None], ["u", "same"]).union(
        spark.createDataFrame([(9, None, None, None)], "a long, b double, c double, d double"))
    model = support.fit_poly_svr(rows, ["u", "same"])
    assert all(np.isfinite(p.p) for p in model.predict(rows, "p").collect())
    none = support.fit_poly_svr(rows.limit(0), ["u", "same"])
    assert {p.p for p in none.predict(rows, "p").collect()} == {0.0}
    assert none.predict(rows.limit(0), "p").count() == 0
    with pytest.raises(ValueError):
        support.fit_poly_svr(rows, [f"c{k}" for k in range(100)], degree=4)
