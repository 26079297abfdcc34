"""Network measures and window forecasts against small brute force."""

from itertools import combinations

import numpy as np
import pandas as pd
import pytest

from churnpanel.operators import graph, sequence

TRADE = "source_acc_id long, target_acc_id long"


def brute_network(rows, steps):
    pairs = {(min(a, b), max(a, b)) for a, b in rows if a != b}
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    rank = dict.fromkeys(near, 1 / len(near))
    for _ in range(steps):
        rank = {v: 0.15 / len(near) + 0.85 * sum(rank[u] / len(near[u]) for u in near[v]) for v in near}
    shut = {v: sum((min(x, y), max(x, y)) in pairs for x, y in combinations(near[v], 2)) for v in near}
    return {v: (len(near[v]), shut[v], 2 * shut[v] / max(1, len(near[v]) * (len(near[v]) - 1)), rank[v]) for v in near}


@pytest.mark.parametrize("hub", [False, True])
def test_network_measures(spark, hub):
    rng = np.random.default_rng(4)
    rows = [tuple(map(int, p)) for p in rng.integers(0, 40, (220, 2))] * 2 + [(7, 7), (500, 501)]
    if hub:  # an account in far more than a sixty-fourth of the edges
        rows += [(999, i) for i in range(300)]
    df = spark.createDataFrame(rows, TRADE).repartition(3)
    got = {r.acc_id: (r.partners, r.triangles, r.clustering, r.pagerank) for r in graph.network_measures(df, 7).collect()}
    want = brute_network(rows, 7)
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-9), k
    assert sum(v[3] for v in got.values()) == pytest.approx(1)
    assert sum(v[1] for v in got.values()) % 3 == 0 and got[500][1:3] == (0, 0)


def test_no_trades(spark):
    assert graph.network_measures(spark.createDataFrame([], TRADE), 3).count() == 0
    assert graph.network_measures(spark.createDataFrame([(1, 1)], TRADE), 3).count() == 0


def test_pairs_of_edges_never_become_rows(spark):
    """A complete graph: the plan intersects arrays, one row for each edge, and joins by one account."""
    n = 12
    rows = [(a, b) for a in range(n) for b in range(a)]
    found = graph.triangles(spark.createDataFrame(rows, TRADE))
    assert {(r.partners, r.triangles) for r in found.collect()} == {(n - 1, (n - 1) * (n - 2) // 2)}
    assert "array_intersect" in found._jdf.queryExecution().optimizedPlan().toString()


def test_edges_leave_the_less_connected_account(spark):
    """A star with a closed rim: the centre has no edge going out, so no pairs are formed at it."""
    rim = 60
    rows = [(0, i) for i in range(1, rim + 1)] + [(i, i % rim + 1) for i in range(1, rim + 1)]
    got = {r.acc_id: r.triangles for r in graph.triangles(spark.createDataFrame(rows, TRADE)).collect()}
    assert got[0] == rim and all(got[i] == 2 for i in range(1, rim + 1))


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(9)
    rows = [(a, d, float(rng.exponential())) for a in range(12) for d in range(1, 29)] + [(50, d, 2.0) for d in range(1, 5)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["acc_id", "day", "amount_spent"]).sample(frac=1, random_state=1))


def values_of(series):
    pdf = series.toPandas().sort_values(["acc_id", "day"])
    return {a: g.amount_spent.tolist() for a, g in pdf.groupby("acc_id")}


def roll(y, model, horizon, feed):
    n = len(model.weights)
    ahead = lambda w: model.intercept + sum(c * v for c, v in zip(model.weights, w))
    if feed == "predicted":
        y = [v if i < n else ahead(y[i - n: i]) for i, v in enumerate(y)]
    known = len(y)
    while len(y) < horizon:
        y = [*y, ahead(y[-n:])]
    return known, y[-1], sum(y) / len(y)


@pytest.mark.parametrize("feed", ["known", "predicted"])
@pytest.mark.parametrize("horizon", [64, 29, 28, 10])
def test_window_forecast(series, feed, horizon):
    model = sequence.WindowModel(0.1, (0.5, -0.2, 0.3))
    got = {r.acc_id: tuple(r)[1:] for r in sequence.window_forecast(series, model, horizon=horizon, feed=feed).collect()}
    want = {a: roll(y, model, horizon, feed) for a, y in values_of(series).items()}
    assert got.keys() == want.keys()  # the short account has four days, enough for three
    for a, v in want.items():
        assert got[a] == pytest.approx(v)


def test_fitted_window_equals_least_squares(series):
    model = sequence.fit_window(series, n=7, ridge=0.0)
    xs, ys = [], []
    for y in values_of(series).values():
        for i in range(7, len(y)):
            xs.append([1.0, *y[i - 7: i]])
            ys.append(y[i])
    beta = np.linalg.lstsq(np.array(xs), np.array(ys), rcond=None)[0]
    assert [model.intercept, *model.weights] == pytest.approx(beta.tolist(), rel=1e-6)
    got = sequence.window_forecast(series, model).toPandas()
    assert set(got.acc_id) == set(range(12))  # four days do not fill a window


def test_flat_and_short_series(spark):
    flat = spark.createDataFrame([(1, d, 3.0) for d in range(1, 29)], "acc_id long, day int, amount_spent double")
    row = sequence.window_forecast(flat, sequence.fit_window(flat)).first()
    assert row.last_value == pytest.approx(3, abs=1e-4) and row.mean_value == pytest.approx(3, abs=1e-4)
    with pytest.raises(ValueError):
        sequence.fit_window(flat.where("day < 5"))
    with pytest.raises(ValueError):
        sequence.window_forecast(flat, sequence.WindowModel(0.0, (1.0,)), feed="other")
    assert sequence.window_forecast(flat.limit(0), sequence.WindowModel(0.0, (1.0,))).count() == 0
