"""The panel chain moves an account's rows once, whatever follows."""

import pytest

from churnpanel.operators import panel
from churnpanel.schema import MEAN_FILL, PAYMENT_STATS


def parts(spark, combat, pledge, payment):
    def daily(rows, *columns):
        return spark.createDataFrame(rows, "acc_id long, day int, " + ", ".join(f"{c} double" for c in columns))

    return [daily(combat, "c_x"), daily(pledge, "p_x"), daily([], "t_x"), daily([], "a_x"),
            daily([(a, d, *[v] * len(PAYMENT_STATS)) for a, d, v in payment], *PAYMENT_STATS)]


COMBAT = [(1, 1, 1.0), (1, 3, 3.0), (2, 2, 2.0)]
PLEDGE = [(1, 1, 5.0), (1, 2, 6.0), (3, 1, 7.0)]
PAYMENT = [(1, 3, 9.0), (3, 1, 8.0)]


def filled(spark, **options):
    given = parts(spark, COMBAT, PLEDGE, PAYMENT)
    days = panel.account_calendar(panel.base_accounts(given[0]), 3)
    return panel.panel_join(*given, calendar=days, **options)


@pytest.mark.parametrize("scope", ["payment_days", "all_days"])
def test_calendar_equals_filled_join(spark, scope):
    given = parts(spark, COMBAT, PLEDGE, PAYMENT)
    want = panel.panel_fill(panel.panel_join(*given, stats_scope=scope), panel.base_accounts(given[0]), 3)
    got = filled(spark, stats_scope=scope)
    assert got.dtypes == want.dtypes
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert got.count() == 6


def test_spines(spark):
    given = parts(spark, COMBAT, PLEDGE, PAYMENT)
    rows = {(r.acc_id, r.day): (r.c_x, r.p_x) for r in panel.panel_join(*given).collect()}
    assert rows == {(1, 1): (1.0, 5.0), (1, 3): (3.0, None), (2, 2): (2.0, None)}
    assert panel.panel_join(*given, spine="union").count() == 5
    with pytest.raises(ValueError):
        panel.panel_join(*given, spine="inner")


def test_empty_parts(spark):
    given = parts(spark, [], [], [])
    assert panel.panel_join(*given).count() == 0
    assert panel.panel_join(*given, spine="union").count() == 0


def test_one_exchange_by_account(spark):
    """From the daily rows to the account summary the only exchange is the one by account
    (the calendar's own accounts apart)."""
    given = parts(spark, COMBAT, PLEDGE, PAYMENT)
    accounts = spark.createDataFrame([(1,), (2,)], "acc_id long")
    rows = panel.panel_join(*given, calendar=panel.account_calendar(accounts))
    out = panel.account_squeeze(panel.panel_impute(rows, [c for c in MEAN_FILL if c in rows.columns] or ["c_x"]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(acc_id" in plan
    assert "Window" in plan and "Join" not in plan
