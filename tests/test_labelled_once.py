"""Both sides of the trades are measured and joined from one stored copy."""

from churnpanel.operators import profile


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sides_are_measured_on_stored_trades(spark):
    trade = spark.createDataFrame([(k % 7, k % 5, k) for k in range(200)] + [(1, None, 999)],
                                  "source_acc_id long, target_acc_id long, n long")
    other = spark.createDataFrame([(k,) for k in range(150)], "n long")
    label = spark.createDataFrame([(1,), (2,), (3,), (None,)], "acc_id long")
    got = profile.labelled_only(trade.join(other, "n"), label)
    assert plan(got).count("Join") == 2
    want = sorted(k for k in range(150) if 1 <= k % 7 <= 3 and 1 <= k % 5 <= 3)
    assert sorted(r.n for r in got.collect()) == want
