"""Hand-written rows with results fixed by hand."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from churnpanel.functions.exprs import rounded, sum0, week_of
from churnpanel.operators import (
    activity, cohorts, combat, correlation, evaluate, graph, panel, payment, pledge, profile,
    scaling, sequence, trade,
)
from churnpanel.plans import queries
from churnpanel.schema import ACTIVITY_MEASURES, COMBAT_MEASURES, PLEDGE_MEASURES
from churnpanel.session import METHOD_BYTES

TRADE = ("day int, time string, type int, server string, source_acc_id long, source_char_id long, "
         "target_acc_id long, target_char_id long, item_type string, item_amount double, item_price double")


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def by(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def trades(spark, *rows):
    """rows: (day, time, type, source, target, item, amount, price)"""
    full = [(d, t, ty, "s", s, s * 4, b, b * 4, i, a, p) for d, t, ty, s, b, i, a, p in rows]
    return spark.createDataFrame(full, TRADE)


def combats(spark, *rows):
    """rows: (acc, char, day, class, level, seq)"""
    zero = [f"1D as {c}" for c in COMBAT_MEASURES]
    df = spark.createDataFrame(rows, "acc_id long, char_id long, day int, class int, level int, row_seq long")
    return df.selectExpr("*", "'s' as server", *zero)


def test_bin_edges(spark):
    times = ["00:00:00", "00:00:01", "06:00:00", "06:00:01", "23:59:59"]
    df = spark.createDataFrame([(t,) for t in times], "time string")
    zero = [r.time_bin for r in trade.time_bins(df).collect()]
    none = [r.time_bin for r in trade.time_bins(df, 4, "none").collect()]
    hours = [r.time_bin for r in trade.time_bins(df, 24).collect()]
    assert zero == [0, 0, 0, 1, 3]
    assert none == [None, 0, 0, 1, 3]
    assert hours == [0, 0, 5, 6, 23]


def test_all_null_group(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, None)], "acc_id long, day int, isMajorClass double")
    assert one(df.groupBy("acc_id").agg(sum0("isMajorClass").alias("s")))["s"] == 0
    assert {r.isMajorClass for r in panel.panel_impute(df).collect()} == {0.0}


def test_one_sided_trader(spark):
    df = trades(spark, *[(1, "01:00:00", 0, 5, 6, "etc", 1.0, 1.0)] * 3)
    ledger = trade.trade_ledger(trade.time_bins(df))
    assert by(trade.trade_counts(ledger), "acc_id")[(5,)]["total_trade_count"] == 3
    assert by(trade.trade_counts(ledger, legacy_total=True), "acc_id")[(5,)]["total_trade_count"] == 0


def test_money_swap(spark):
    # account 1 pays 100 units of money to account 2; the other row sets both minima to 1
    df = trades(spark, (1, "01:00:00", 0, 1, 2, "adena", 100.0, None),
                (2, "01:00:00", 0, 3, 4, "etc", 1.0, 1.0))
    base = spark.createDataFrame([(1,), (2,)], "acc_id long")
    daily = by(trade.trade_daily(df, base), "acc_id")
    assert daily[(2,)]["sell_item_price"] == 100 and daily[(1,)]["get_item_price"] == 100
    assert daily[(2,)]["tot_get_money"] == 100 and daily[(1,)]["tot_get_money"] == -100
    assert daily[(1,)]["get_item_amount"] == 1


def test_unpriced_rows_are_dropped_but_money_stays(spark):
    df = trades(spark, (1, "01:00:00", 1, 1, 2, "adena", 2.0, None),
                (1, "01:00:00", 1, 1, 2, "etc", 2.0, None), (1, "01:00:00", 0, 1, 2, "etc", 4.0, 8.0))
    kept = by(trade.trade_normalize(df), "item_type", "type")
    assert set(kept) == {("adena", 1), ("etc", 0)}
    assert kept[("etc", 0)]["item_amount"] == 2 and kept[("etc", 0)]["item_price"] == 1


def test_mean_price_of_the_item_type(spark):
    df = trades(spark, (1, "01:00:00", 0, 1, 2, "etc", 1.0, 2.0), (1, "01:00:00", 0, 1, 2, "etc", 1.0, 4.0),
                (1, "01:00:00", 1, 1, 2, "etc", 3.0, None), (1, "01:00:00", 0, 1, 2, "spell", 1.0, 1.0))
    rows = trade.trade_gross(df).where("item_amount = 3").collect()
    assert rows[0].item_price == 3.0 and rows[0].total_item_price == 9.0


def test_net_value_sign(spark):
    df = trades(spark, (1, "01:00:00", 0, 1, 2, "etc", 1.0, 5.0), (1, "01:00:00", 0, 2, 1, "spell", 1.0, 1.0))
    base = spark.createDataFrame([(1,)], "acc_id long")
    sold = one(trade.trade_daily_v1(df, base))
    got = one(trade.trade_daily_v1(df, base, sign="get_minus_sell"))
    assert sold["tot_amount_etc"] == 5 and got["tot_amount_etc"] == -5
    assert sold["tot_count_etc"] == 1 and sold["tot_time_bin_0"] == 2


def test_first_daily_features_leave_midnight_out(spark):
    df = trades(spark, (1, "00:00:00", 0, 1, 2, "etc", 2.0, 5.0), (1, "07:00:00", 0, 1, 2, "etc", 2.0, None))
    base = spark.createDataFrame([(1,)], "acc_id long")
    row = one(trade.trade_daily_v0(df, base))
    assert [row[f"time_bin_{b}"] for b in range(4)] == [0, 1, 0, 0]
    assert row["total_item_price"] == 20.0  # the median, 5, fills the missing price


def test_zero_playtime(spark):
    zeros = [f"0D as {c}" for c in ACTIVITY_MEASURES]
    df = spark.range(1).selectExpr("1L as acc_id", "1 as day", *zeros)
    row = one(activity.activity_daily(df))
    assert row["fishing_prop"] is None
    assert one(panel.panel_impute(activity.activity_daily(df)))["fishing_prop"] == 0


def test_tied_classes(spark):
    classes = [0] * 3 + [1] * 3 + [2] * 2 + [3] * 2
    df = combats(spark, *[(1, 1, 1, c, 1, n) for n, c in enumerate(classes)])
    got = {r["class"]: r.is_major for r in combat.major_class(df).collect()}
    assert got == {0: 1, 1: 1, 2: 0, 3: 0}
    assert one(combat.combat_daily(df))["isMajorClass"] == pytest.approx(0.6)


def test_level_history(spark):
    df = combats(spark, (1, 1, 5, 0, 12, 3), (1, 1, 1, 0, 10, 1), (1, 2, 2, 0, 20, 2))
    row = one(combat.level_progress(df))
    assert (row["tot_start_lv"], row["tot_end_lv"], row["changed_lv"]) == (30, 32, 2)
    assert (row["avg_start_lv"], row["avg_end_lv"]) == (15, 16)


def test_same_day_levels_follow_row_order(spark):
    df = combats(spark, (1, 1, 1, 0, 9, 2), (1, 1, 1, 0, 7, 1))
    row = one(combat.level_progress(df))
    assert (row["tot_start_lv"], row["tot_end_lv"]) == (7, 9)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 5.0)], "acc_id long, x double")
    assert {r.x for r in scaling.minmax_scale(df, ["x"]).collect()} == {0.0}
    assert {r.x for r in scaling.standard_minmax(df, ["x"]).collect()} == {0.0}


def test_scale_is_fitted_on_training_rows(spark):
    train = spark.createDataFrame([(1, 0.0), (2, 10.0)], "acc_id long, x double")
    test = spark.createDataFrame([(3, 20.0)], "acc_id long, x double")
    assert one(scaling.minmax_scale(test, ["x"], train))["x"] == 2.0


def test_calendar(spark):
    df = spark.createDataFrame([(1, 3, 7.0)], "acc_id long, day int, x double")
    rows = panel.panel_fill(df).collect()
    assert len(rows) == 28 and sum(r.x is None for r in rows) == 27
    assert sorted(r.day for r in rows) == list(range(1, 29))


def test_weeks(spark):
    got = [r.w for r in spark.range(1, 29).select(week_of("id").alias("w")).collect()]
    assert got == [1] * 7 + [2] * 7 + [3] * 7 + [4] * 7


def test_duplicate_payment_day(spark):
    df = spark.createDataFrame([(4, 1, 2.0), (4, 1, 3.0), (5, 1, 1.0)], "day int, acc_id long, amount_spent double")
    days = by(payment.payment_transform(df), "day")
    assert days[(4,)]["amount_spent"] == 5 and len(days) == 2
    assert days[(4,)]["median_spent"] == 3 and days[(4,)]["tot_spent"] == 6


def test_combat_is_the_spine(spark):
    keys = "acc_id long, day int"
    fights = spark.createDataFrame([(1, 1)], keys).withColumn("combat_logged_in", F.lit(1))
    plays = spark.createDataFrame([(1, 1), (1, 2)], keys).withColumn("activity_logged_in", F.lit(1))
    none = spark.createDataFrame([], keys)
    parts = (fights, none.withColumn("p", F.lit(1)), none.withColumn("t", F.lit(1)), plays,
             none.withColumn("m", F.lit(1)))
    assert panel.panel_join(*parts).count() == 1
    assert panel.panel_join(*parts, spine="union").count() == 2


def test_account_mean_fills_before_zero(spark):
    df = spark.createDataFrame([(1, 1, 2.0, None), (1, 2, 4.0, 1.0), (1, 3, None, None)],
                               "acc_id long, day int, p_c_cnt double, other double")
    got = {r.day: (r.p_c_cnt, r.other) for r in panel.panel_impute(df).collect()}
    assert got == {1: (2.0, 0.0), 2: (4.0, 1.0), 3: (3.0, 0.0)}


def test_group_scores_put_the_best_at_one(spark):
    rows = [(1, 10, 1, 4.0, 2.0), (2, 10, 1, 2.0, 2.0), (3, 11, 1, 6.0, 1.0)]
    df = spark.createDataFrame(rows, "acc_id long, pledge_id long, day int, play_char_cnt double, pledge_combat_cnt double")
    rest = [c for c in PLEDGE_MEASURES if c not in df.columns]
    df = df.selectExpr("*", *[f"0D as {c}" for c in rest])
    s = by(pledge.pledge_scores(df), "pledge_id")
    assert s[(11,)]["avg_play_rate_per_pledge"] == 1 and s[(10,)]["avg_play_rate_per_pledge"] == 0.5
    assert s[(10,)]["total_combat_cnt_per_pledge"] == 1 and s[(11,)]["total_combat_cnt_per_pledge"] == 0.25
    daily = by(pledge.pledge_daily(df), "acc_id")
    assert daily[(1,)]["pledge_num_people"] == 2 and daily[(3,)]["pledge_num_people"] == 1


LABEL = "acc_id long, survival_time int, amount_spent double"


@pytest.mark.parametrize("pred, actual, gamma, profit", [
    ((64, 1.0), (10, 1.0), 0.0, 0.0),
    ((10, 1.0), (64, 1.0), 1.0, -0.3),
    ((10, 1.0), (10, 1.0), 1.0, 29.7),
    ((10, 0.05), (10, 1.0), 0.0, -0.015),
    ((10, 0.5), (10, 1.0), 0.5 / 0.9 - 1 / 9, 13.183333333),
    ((10, 1.0), (10, 0.0), 0.0, -0.3),
    ((10, 1.0), (25, 1.0), 1.0, 30 * math.exp(-0.5) - 0.3),
])
def test_score_branches(spark, pred, actual, gamma, profit):
    p = spark.createDataFrame([(1, *pred)], LABEL)
    a = spark.createDataFrame([(1, *actual)], LABEL)
    row = one(evaluate.score_per_account(p, a))
    assert row["gamma"] == pytest.approx(gamma) and row["profit"] == pytest.approx(profit)
    assert one(evaluate.score_profit(p, a))["score"] == pytest.approx(profit)


def test_score_key_mismatch(spark):
    p = spark.createDataFrame([(1, 10, 1.0), (2, 10, 1.0)], LABEL)
    a = spark.createDataFrame([(1, 10, 1.0)], LABEL)
    assert [r.acc_id for r in evaluate.score_keycheck(p, a).collect()] == [2]
    with pytest.raises(PySparkException):
        evaluate.score_profit(p, a).collect()


def test_groups(spark):
    df = spark.createDataFrame([(1, 64, 0.0), (2, 5, 0.1), (3, 5, 0.27)], LABEL)
    got = {r.acc_id: (r.amo_group, r.sur_group) for r in evaluate.label_groups(df).collect()}
    assert got == {1: (0, 1), 2: (1, 0), 3: (2, 0)}


def test_sliding(spark):
    df = spark.range(1, 29).selectExpr("1L as acc_id", "cast(id as int) as day", "cast(id as double) as x")
    runs = sequence.sliding(df, ["x"]).collect()
    assert len(runs) == 22 and max(r.start for r in runs) == 22
    pairs = {r.start: r for r in sequence.sliding_target(df, ["x"], "x").collect()}
    assert len(pairs) == 21
    assert [s.x for s in pairs[3].window] == [3, 4, 5, 6, 7, 8, 9] and pairs[3].y == 10


def test_forecast(spark):
    flat = spark.range(1, 29).selectExpr("1L as acc_id", "cast(id as int) as day", "2D as amount_spent")
    row = one(sequence.ar_forecast(flat))
    assert (row["slope"], row["intercept"], row["mean_spend"]) == (0.0, 2.0, 2.0)
    # y(t) = 1 + 0.5 y(t-1) exactly
    ys = [10.0]
    for _ in range(27):
        ys.append(1 + 0.5 * ys[-1])
    rows = [(2, d + 1, y) for d, y in enumerate(ys)]
    got = one(sequence.ar_forecast(spark.createDataFrame(rows, "acc_id long, day int, amount_spent double")))
    for _ in range(36):
        ys.append(1 + 0.5 * ys[-1])
    assert got["slope"] == pytest.approx(0.5) and got["mean_spend"] == pytest.approx(sum(ys) / 64)


def test_hubs_join_on_the_account(spark):
    df = trades(spark, *[(1, "01:00:00", 0, 1, t, "etc", 1.0, 1.0) for t in (2, 2, 3)])
    assert {(r.src, r.dst) for r in graph.hub_edges(df, 2).collect()} == {(1, 2), (1, 3)}
    assert {r.acc_id: r.partners for r in graph.trade_partners(df).collect()} == {1: 2, 2: 1, 3: 1}


def test_concentration_is_strict(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (2, 1, 3.0)], LABEL)
    row = by(profile.spend_concentration(df, [1, 2]), "threshold")[(1.0,)]
    assert (row["upper"], row["down"], row["count"], row["ratio"]) == (3.0, 0.0, 1, 0.75)


def test_histogram_keeps_the_maximum_in_the_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)], "x double")
    got = {r.bin: r.n for r in profile.histogram(df, ["x"], 5).collect()}
    assert got == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}


def test_feature_selection_drops_weak_columns(spark):
    corr = spark.createDataFrame([("a", "y", 0.5), ("b", "y", -0.31), ("c", "y", 0.1), ("d", "y", None)],
                                 "feature string, label string, rho double")
    assert {r.feature for r in correlation.feature_select(corr, {"y": 0.3}).collect()} == {"a", "b"}
    df = spark.createDataFrame([(1, 1, 1, 1, 1)], "acc_id int, a int, b int, c int, d int")
    assert correlation.drop_weak(df, corr, "y", 0.3).columns == ["acc_id", "a", "b", "d"]


def test_co_trade_needs_two_members(spark):
    members = spark.createDataFrame([(9, 1, 1), (9, 2, 1), (9, 3, 1)], "pledge_id long, acc_id long, day int")
    ledger = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 1)], "acc_id long, day int, time_bin int")
    got = {r.acc_id: r.co_trade for r in cohorts.pledge_co_trade(members, ledger).collect()}
    assert got == {1: 1, 2: 1, 3: 0}


def test_rounded_equals_round(spark):
    """Ties, values near them, large ones, NaN, infinities and NULL give what Spark's round gives."""
    given = [0.0000005, 1.0000015, 2.5e-6, -2.5e-6, 1.0049999999999, 0.1 + 0.2, 1e300, float("nan"), float("inf"), None,
             123456789.1234565, 9007199254740993.0, 8.6e9 + 0.3333333, -1e-9, 2.675, 1.005]
    given += [k / 7919 * 10 ** (k % 13 - 4) * (-1) ** k for k in range(3000)] + [k / 2e6 for k in range(1, 2000, 2)]
    rows = spark.createDataFrame([(v,) for v in given], "x double")
    for n in (3, 6, 10):
        both = rows.selectExpr(f"{rounded('x', n)} + 0D as mine", f"round(x, {n}) + 0D as theirs")
        assert both.where("not (mine <=> theirs)").count() == 0


def test_queries_keep_generated_methods_compiled(spark, sf_dir):
    """Also in a session that was built elsewhere; a limit of the caller's own stays."""
    key, n = METHOD_BYTES
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        queries.registry()["sliding7"](spark, sf_dir)
        assert spark.conf.get(key) == n
        spark.conf.set(key, "9000")
        queries.registry()["label_totals"](spark, sf_dir)
        assert spark.conf.get(key) == "9000"
    finally:
        spark.conf.set(key, before)
