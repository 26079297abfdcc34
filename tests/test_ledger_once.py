"""The tables of the trades are joined once, although global values are read before the rows."""

import pytest

from churnpanel.plans.queries import registry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["trade_ledger", "trade_item_pivot"])
def test_rows_are_stored(spark, sf_dir, name):
    assert "Join" not in plan(registry()[name](spark, sf_dir))
