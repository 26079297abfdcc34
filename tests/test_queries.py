"""Every registered query with SQL against DuckDB, on the smallest tables."""

from concurrent.futures import ThreadPoolExecutor

import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract
from churnpanel.plans.oracles import oracle_sql
from churnpanel.plans.queries import registry
from churnpanel.plans.specs import SPECS
from churnpanel.sources.adapters import Inputs

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def results(spark, sf_dir):
    """All queries, a few at a time: small inputs leave most cores idle."""
    queries = registry()
    pool = ThreadPoolExecutor(6)
    found = {
        name: pool.submit(lambda n=name: queries[n](spark, sf_dir).toPandas())
        for name in sorted(oracle_sql())
    }
    yield found
    pool.shutdown(cancel_futures=True)


def ordered(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return pdf.sort_values(list(pdf.columns)).reset_index(drop=True)


def test_registry_is_complete():
    assert set(registry()) == set(SPECS)
    assert set(registry()) <= set(contract.queries())
    assert set(oracle_sql()) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_no_event_is_lost(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    days = inputs.activity.agg({"day": "min"}).first()[0], inputs.activity.agg({"day": "max"}).first()[0]
    assert inputs.activity.count() == inputs.events.count() and days[0] >= 1 and days[1] <= 28


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(results, duck, name):
    mine = ordered(results[name].result())
    want = ordered(duck.execute(oracle_sql()[name]).df())
    assert list(mine.columns) == list(want.columns)
    assert len(mine) == len(want)
    for c in mine.columns:
        if want[c].dtype.kind in "fiu":
            np.testing.assert_allclose(
                mine[c].astype(float), want[c].astype(float), rtol=0, atol=2e-6, err_msg=c
            )
        else:
            assert mine[c].fillna("").tolist() == want[c].fillna("").tolist(), c


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
