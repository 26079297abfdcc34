"""Behaviour on skewed data, and results that must not depend on partitioning."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnpanel.functions.ranks import exact_median, exact_quantiles, value_ranks
from churnpanel.functions.scale import hot_keys, materialize, salted_join, skew_join, with_scalars
from churnpanel.operators import correlation, neighbours, panel, trade
from churnpanel.plans import queries
from churnpanel.plans.build_panel import filled_panel
from churnpanel.schema import RAW_TABLES
from churnpanel.sources.adapters import MONEY


def skewed(spark, n=3000):
    """A third of the rows share one key."""
    return spark.range(n).selectExpr("id", "if(id % 3 = 0, 0L, id % 50) as k", "cast(id % 7 as double) as x")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_plain_join(spark, how):
    big = skewed(spark)
    small = spark.range(40).selectExpr("id as k", "id * 2 as v")
    got = salted_join(big, small, ["k"], how).toPandas().sort_values("id").reset_index(drop=True)
    want = big.join(small, ["k"], how).toPandas().sort_values("id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got[want.columns], want)


def test_scalars_appear_once(spark):
    df = skewed(spark)
    rows, b = with_scalars(df, df, "_b", lo="min(x)", hi="max(x)")
    got = rows.selectExpr(f"{b['lo']} as lo", f"{b['hi']} as hi").distinct().collect()
    assert [(r.lo, r.hi) for r in got] == [(0.0, 6.0)]


@pytest.mark.parametrize("range_rows", [1, 2, 7, 50_000])
def test_value_ranks_equal_average_ranks(spark, range_rows):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.normal(size=400).round(2), "b": np.where(np.arange(400) % 3 == 0, 0, rng.integers(-5, 5, 400))})
    got = value_ranks(spark.createDataFrame(pdf.astype(float)), ["a", "b"], range_rows=range_rows).toPandas()
    for c in ("a", "b"):
        want = dict(zip(pdf[c], pdf[c].rank()))
        mine = got[got.feature == c]
        assert dict(zip(mine.value, mine["rank"])) == want
        assert set(mine.total) == {400}


@pytest.mark.parametrize("range_rows", [1, 3, 1000])
def test_value_ranks_of_awkward_values(spark, range_rows):
    tiny = [5e-324, 1e-310, 2.2e-308, 1.0, 1.0 + 2**-52, 1.5, 1e308, 1.7e308]
    values = sorted([-v for v in tiny]) + [0.0] + tiny
    x = values * 3 + [-0.0, float("inf"), float("-inf"), float("inf"), None]
    df = spark.createDataFrame([(v,) for v in x], "x double").unionByName(spark.sql("select double('nan') as x"))
    got = {str(r.value): r["rank"] for r in value_ranks(df, ["x"], range_rows=range_rows).collect()}
    known = pd.Series([v + 0.0 for v in x if v is not None] + [1.75e308])  # stands for NaN, below inf
    known.iloc[-1] = np.nan
    ranks = known.rank(na_option="bottom")
    assert got == {str(v): r for v, r in zip(known, ranks)}
    assert value_ranks(df.limit(0), ["x"]).count() == 0


def test_zeros_take_one_row_and_the_rest_is_spread(spark):
    """95 % zeros, and all other values within one power of two."""
    df = spark.range(40_000).selectExpr("if(id % 20 = 0, 1.0 + id / 80000.0, 0.0) as x")
    ranked = value_ranks(df, ["x"], range_rows=100)
    assert ranked.count() == 2001 and ranked.where("value = 0").first().n == 38_000
    edges = [r.below for r in ranked.where("value <> 0").orderBy("value").collect()]
    assert edges == list(range(38_000, 40_000))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_skew_join_equals_plain_join(spark, how):
    big = skewed(spark).withColumn("k", F.expr("if(id % 11 = 5, null, k)"))
    small = spark.range(40).selectExpr("id as k", "id * 2 as v")
    order = lambda df: df.toPandas().sort_values("id").reset_index(drop=True)
    got, want = order(skew_join(big, small, ["k"], how)), order(big.join(small, ["k"], how))
    pd.testing.assert_frame_equal(got[want.columns], want)
    assert skew_join(big.limit(0), small, ["k"], how).count() == 0


def test_only_hot_keys_are_copied(spark):
    big = spark.range(60_000).selectExpr("id", "if(id % 3 = 0, 0L, id) as k")
    assert len(hot_keys(big, F.xxhash64("k"))) == 1
    small = spark.range(1000).selectExpr("id as k", "id as v")
    joined = skew_join(big, small, ["k"], salts=16)
    assert joined.count() == 20_000 + sum(1 for i in range(1000) if i % 3)
    # 999 rows as they are and one 16 times
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan
    key = F.xxhash64("k").isin(*hot_keys(big, F.xxhash64("k")))
    copies = small.select(F.explode(F.when(key, F.sequence(F.lit(0), F.lit(15))).otherwise(F.array(F.lit(0))))).count()
    assert copies == 999 + 16
    even = spark.range(5000).selectExpr("id", "id % 500 as k")
    assert hot_keys(even, F.xxhash64("k")) == []


def test_quantiles_are_exact(spark):
    x = np.random.default_rng(2).exponential(size=501)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    row = exact_quantiles(df, ["x"], {"q1": 0.25, "q9": 0.9}, range_rows=8).collect()[0]
    assert row.q1 == pytest.approx(np.quantile(x, 0.25)) and row.q9 == pytest.approx(np.quantile(x, 0.9))
    got = df.select(exact_median(df, "x").alias("m")).first().m
    assert got == pytest.approx(np.median(x))


def test_spearman_equals_pandas(spark):
    rng = np.random.default_rng(3)
    n = 300
    y = np.where(np.arange(n) % 3 == 0, 0.0, rng.exponential(size=n))
    pdf = pd.DataFrame({"acc_id": np.arange(n), "f": (y + rng.normal(size=n)).round(1), "c": 1.0, "y": y})
    got = correlation.corr_spearman(spark.createDataFrame(pdf), ["f", "c"], ["y"], range_rows=7).collect()
    rho = {r.feature: r.rho for r in got}
    assert rho["f"] == pytest.approx(np.corrcoef(pdf.f.rank(), pdf.y.rank())[0, 1])
    assert rho["c"] is None


def brute(train, query, feats, k, include_self):
    out = {}
    for q in query.itertuples():
        d = np.sqrt(sum((train[f] - getattr(q, f)) ** 2 for f in feats)).round(9)
        cand = pd.DataFrame({"d": d, "id": train.acc_id, "label": train.label})
        if not include_self:
            cand = cand[cand.id != q.acc_id]
        top = cand.sort_values(["d", "id"]).head(k)
        counts = top.label.value_counts()
        out[q.acc_id] = int(min(counts[counts == counts.max()].index))
    return out


@pytest.mark.parametrize("include_self, block_rows", [(True, 25), (False, 25), (False, 100000)])
def test_neighbours_equal_brute_force(spark, include_self, block_rows):
    rng = np.random.default_rng(7)
    n = 240
    pdf = pd.DataFrame({"acc_id": np.arange(n), "u": rng.normal(size=n), "v": rng.normal(size=n),
                        "label": rng.integers(0, 3, n)})
    pdf.loc[::3, ["u", "v"]] = 0.5  # a third of the rows are copies of one vector
    df = spark.createDataFrame(pdf)
    got = neighbours.knn_vote(df, df, ["u", "v"], "label", 5, include_self, block_rows)
    mine = {r.acc_id: r.prediction for r in got.collect()}
    assert mine == brute(pdf, pdf, ["u", "v"], 5, include_self)


def test_neighbours_of_far_queries(spark):
    """Queries whose own shell has fewer than k rows reach into the others."""
    train = pd.DataFrame({"acc_id": np.arange(60), "u": np.arange(60) / 10.0, "label": np.arange(60) % 4})
    query = pd.DataFrame({"acc_id": [1000, 1001], "u": [50.0, -3.0]})
    got = neighbours.knn_vote(spark.createDataFrame(train), spark.createDataFrame(query), ["u"], "label", 5, True, 10)
    assert {r.acc_id: r.prediction for r in got.collect()} == brute(train, query, ["u"], 5, True)


def raw_tables(inputs, parts=None):
    raw = {t: inputs.table(f"fx_{t}") for t in RAW_TABLES}
    return {t: df.repartition(parts) if parts else df for t, df in raw.items()}


def test_panel_shape_and_partitioning(spark, inputs):
    first = filled_panel(raw_tables(inputs), MONEY).toPandas()
    accounts = inputs.combat.select("acc_id").distinct().count()
    assert len(first) == 28 * accounts
    assert not first.duplicated(["acc_id", "day"]).any()
    second = filled_panel(raw_tables(inputs, 5), MONEY).toPandas()
    order = ["acc_id", "day"]
    a = first.sort_values(order).reset_index(drop=True).astype(float)
    b = second.sort_values(order).reset_index(drop=True).astype(float)
    pd.testing.assert_frame_equal(a, b, rtol=1e-9)


def test_imputation_is_complete_and_idempotent(spark, inputs):
    done = materialize(panel.panel_impute(panel.rename_prefix(filled_panel(raw_tables(inputs), MONEY))))
    pdf = done.toPandas()
    assert not pdf.isna().any().any()
    again = panel.panel_impute(done).toPandas()
    order = ["acc_id", "day"]
    pd.testing.assert_frame_equal(
        pdf.sort_values(order).reset_index(drop=True).astype(float),
        again.sort_values(order).reset_index(drop=True).astype(float),
    )


def test_ledger_balance(inputs):
    normal = trade.time_bins(trade.trade_normalize(inputs.trade, MONEY))
    ledger = trade.trade_ledger(normal, MONEY)
    assert ledger.count() == 2 * normal.count()
    totals = trade.trade_counts(ledger).agg(F.sum("count_sell").alias("s"), F.sum("count_get").alias("g")).first()
    assert totals.s == totals.g


def test_filter_reaches_the_scans(spark, inputs):
    """A filter on the filled panel is pushed into the raw tables' scans."""
    plan = panel.panel_fill(
        inputs.lineitem.selectExpr("l_suppkey as acc_id", "l_linenumber as day", "l_tax as x"),
        inputs.supplier.selectExpr("s_suppkey as acc_id"),
    ).where("acc_id = 3")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_suppkey,3)" in plan and "EqualTo(s_suppkey,3)" in plan
    assert "CartesianProduct" not in plan


def far_rows(n, dims, seed=11):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims)) * 4
    x = centres[rng.integers(0, 6, n)] + rng.normal(size=(n, dims))
    pdf = pd.DataFrame(x, columns=[f"x{i}" for i in range(dims)])
    return pdf.assign(acc_id=np.arange(n), label=rng.integers(0, 3, n))


@pytest.mark.parametrize("include_self", [True, False])
def test_neighbours_in_64_dimensions(spark, include_self):
    pdf = far_rows(300, 64)
    feats, df = [f"x{i}" for i in range(64)], spark.createDataFrame(pdf)
    found = neighbours.knn_vote(df, df, feats, "label", 5, include_self, 40)
    assert {r.acc_id: r.prediction for r in found.collect()} == brute(pdf, pdf, feats, 5, include_self)
    seen = neighbours.visited_cells(df, df, feats, "label", 5, include_self, cells=12).toPandas()
    # six separate clusters: most cells are never visited
    assert len(seen) == 300 and seen.n_visited.sum() < 0.6 * seen.n_cells.sum() and (seen.n_visited >= 1).all()


def test_neighbours_with_tied_distances(spark):
    """90 % of the rows lie on a circle around the query, at one distance."""
    n = 200
    angle = np.linspace(0, 2 * np.pi, n, endpoint=False)
    pdf = pd.DataFrame({"acc_id": np.arange(n), "u": np.cos(angle).round(3), "v": np.sin(angle).round(3), "label": np.arange(n) % 3})
    pdf.loc[:19, ["u", "v"]] = [[4 + i / 10, 4] for i in range(20)]
    ring = pd.DataFrame({"acc_id": np.arange(n, n + 5), "u": 0.0, "v": 0.0, "label": 0})
    square = pdf.copy()
    square.loc[20:, ["u", "v"]] = [[(1, 0), (0, 1), (-1, 0), (0, -1)][i % 4] for i in range(n - 20)]
    for refs in (pdf, square):
        got = neighbours.knn_vote(spark.createDataFrame(refs), spark.createDataFrame(ring), ["u", "v"], "label", 5, True, 16)
        assert {r.acc_id: r.prediction for r in got.collect()} == brute(refs, ring, ["u", "v"], 5, True)


def test_compared_groups_are_bounded(spark, monkeypatch):
    """One cell holds nearly all rows; no task gets more than its blocks."""
    pdf = far_rows(600, 3)
    pdf.loc[: 500, ["x0", "x1", "x2"]] = np.random.default_rng(2).normal(size=(501, 3)) / 100
    df, feats = spark.createDataFrame(pdf), ["x0", "x1", "x2"]
    search = neighbours.cell_search(df, df, feats, "label", 5, cells=4)
    assert search.cells.rows.max() > 400
    size = 50
    _, block = neighbours._block(search.cells.rows, size, "acc_id")
    most = search.refs.groupBy("cell", block.alias("b")).count().agg({"count": "max"}).first()[0]
    assert most <= 2 * size
    found = neighbours.knn_vote(df, df, feats, "label", 5, True, size)
    assert {r.acc_id: r.prediction for r in found.collect()} == brute(pdf, pdf, feats, 5, True)


def test_neighbour_bounds_hold():
    rng = np.random.default_rng(8)
    refs, asked, pivots = rng.normal(size=(400, 5)), rng.normal(size=(60, 5)) * 2, rng.normal(size=(9, 5))
    bare = neighbours.Cells(pivots, *[np.zeros(9)] * 3)
    d = bare.distances(refs)
    own = d.argmin(axis=1)
    near, far = (np.array([f(d[own == c, c], initial=i) for c in range(9)]) for f, i in ((np.min, np.inf), (np.max, -np.inf)))
    least = neighbours.Cells(pivots, near, far, np.bincount(own, minlength=9)).bounds(asked)
    real = np.sqrt(((asked[:, None] - refs[None]) ** 2).sum(axis=2))
    for c in range(9):
        if (own == c).any():
            assert (least[:, c] <= real[:, own == c].min(axis=1) + 1e-9).all()


def test_wide_trade_rows_do_not_travel(spark, inputs):
    """v1 builds its wide rows where the narrow sums of a day were dealt to."""
    plan = queries.trade_daily_v1(inputs)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [acc_id" in plan


@pytest.mark.parametrize("name", ["trade_daily", "trade_daily_v1", "trade_daily_v0", "trade_type_mean", "panel_join"])
def test_trades_are_joined_once(inputs, name):
    """Global values and rows read a written stage, not the three tables again."""
    assert not [f for f in queries.BUILDERS[name](inputs).inputFiles() if "lineitem" in f]


def test_queries_travel_once_to_each_region(spark):
    """Cells of one region are visited together, however many a query must see."""
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(size=(300, 16)), columns=[f"x{i}" for i in range(16)]).assign(acc_id=np.arange(300), label=0)
    df, feats = spark.createDataFrame(pdf), [f"x{i}" for i in range(16)]
    search = neighbours.cell_search(df, df, feats, "label", 5, cells=12)
    visits = neighbours._nearest_in_cells(search, feats, "label", 5, True, 20_000)[1]
    assert visits.count() <= 300
    seen = neighbours.visited_cells(df, df, feats, "label", 5, cells=12).toPandas()
    assert seen.n_visited.mean() > 6  # without clusters the radius reaches most cells


@pytest.mark.parametrize("include_self", [True, False])
def test_neighbours_far_from_the_origin(spark, include_self):
    """Screened distances lose digits here; the neighbours do not change."""
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"acc_id": np.arange(120), "u": 1e7 + rng.integers(0, 9, 120) / 1e4, "v": rng.integers(0, 9, 120) / 1e4,
                        "label": rng.integers(0, 3, 120)})
    pdf.loc[:30, "u"] = -1e7
    df = spark.createDataFrame(pdf)
    got = neighbours.knn_vote(df, df, ["u", "v"], "label", 5, include_self, 30)
    assert {r.acc_id: r.prediction for r in got.collect()} == brute(pdf, pdf, ["u", "v"], 5, include_self)
