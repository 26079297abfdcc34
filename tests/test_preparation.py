"""The stored feature preparation, and jobs that need nothing but what is stored."""

import math
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from churnpanel.functions.scale import materialize, stage_path
from churnpanel.operators.panel import account_squeeze
from churnpanel.operators.preparation import FeaturePreparation, FeaturePreparationModel
from churnpanel.plans.build_panel import imputed_panel
from churnpanel.plans.specs import IMPUTED
from churnpanel.plans.train_predict import fit_saved_forests, predict_and_score, predict_saved
from churnpanel.schema import RAW_TABLES
from churnpanel.sources import tables
from churnpanel.sources.adapters import MONEY, Inputs


@pytest.fixture(scope="module")
def accounts(spark):
    rng = np.random.default_rng(1)
    n = 200
    y = rng.exponential(size=n)
    pdf = pd.DataFrame({"acc_id": np.arange(n), "good": y + 0.1 * rng.normal(size=n), "noise": rng.normal(size=n),
                        "flat": 7.0, "falls": -y, "features": "old", "label": y})
    return spark.createDataFrame(pdf)


def fitted(accounts, **more):
    return FeaturePreparation(inputCols=["good", "noise", "flat", "falls"], labelCol="label", **more).fit(accounts)


def test_selects_and_scales(spark, accounts):
    model = fitted(accounts, minimum=0.5)
    assert model.columns() == ["good", "falls"]
    pdf = accounts.toPandas()
    got = model.transform(accounts).orderBy("acc_id").toPandas()
    assert list(got.columns) == ["acc_id", "good", "falls", "label", "features"]
    want = (pdf.good - pdf.good.min()) / (pdf.good.max() - pdf.good.min())
    assert np.allclose(got.good, want) and np.allclose(got.features.map(lambda v: v[0]), want)
    table = {r.feature: r for r in model.table(spark).collect()}
    assert table["falls"].rho == pytest.approx(-1) and table["flat"].rho == 0 and table["noise"].kept == 0
    assert table["noise"].low is None and table["good"].low == pdf.good.min()


def test_all_columns_and_standard_scale(accounts):
    got = fitted(accounts, scale="standard").transform(accounts).toPandas()
    pdf = accounts.toPandas()
    assert np.allclose(got.noise, (pdf.noise - pdf.noise.mean()) / pdf.noise.std(ddof=0)) and (got.flat == 0).all()
    assert len(got.features[0]) == 4


def test_missing_and_outside_values(spark, accounts):
    model = fitted(accounts)
    low, high = (model.getOrDefault(p)[0] for p in (model.lows, model.highs))
    asked = spark.createDataFrame([(1, None, 0.0, 9.0, 0.0), (1, high * 2, None, None, None)], "acc_id long, good double, noise double, flat double, falls double")
    rows = model.transform(asked).collect()
    assert sorted(r.good for r in rows) == pytest.approx(sorted([(0 - low) / (high - low), (2 * high - low) / (high - low)]))
    assert len(rows) == 2 and all(r.flat == 0 for r in rows)
    assert model.transform(asked.limit(0)).count() == 0


def test_refuses_what_it_cannot_learn(accounts):
    with pytest.raises(ValueError, match="no column"):
        FeaturePreparation(inputCols=["flat"], labelCol="label", minimum=0.1).fit(accounts)
    with pytest.raises(ValueError, match="no rows"):
        fitted(accounts.limit(0))
    with pytest.raises(ValueError, match="scale"):
        FeaturePreparation(inputCols=["flat"], scale="other")


def test_no_correlated_column_is_a_result_where_allowed(spark, accounts):
    model = fitted(accounts.withColumn("label", F.lit(1.0)), minimum=0.5, allowNone=True)
    path = stage_path(spark, "none-kept")
    model.write().save(path)
    model = FeaturePreparationModel.load(path)
    assert model.columns() == []
    table = model.table(spark).collect()
    assert len(table) == 4 and all(r.kept == 0 and r.low is None for r in table)
    rows = model.transform(accounts).collect()
    assert len(rows) == 200 and all(len(r.features) == 0 for r in rows) and "good" not in rows[0]
    with pytest.raises(ValueError, match="no rows"):
        fitted(accounts.limit(0), minimum=0.5, allowNone=True)


def test_prepared_queries_keep_nothing(spark, monkeypatch):
    """Many accounts whose labels do not depend on the panel: no column reaches the limit."""
    from churnpanel.plans import queries

    monkeypatch.setattr(queries, "PREPARED_MIN_CORR", 1.0)
    found = queries.registry()
    ranges = found["prepared_ranges"](spark, "/root/testdata/sf0.001").collect()
    assert len(ranges) == len(IMPUTED) - 1 and all(r.kept == 0 and r.rho is not None for r in ranges)
    features = found["prepared_features"](spark, "/root/testdata/sf0.001")
    assert features.columns == ["acc_id", "feature", "value"] and features.count() == 0


def test_stored_pipeline_in_a_new_session(spark, accounts):
    """Another process, with no training row at hand, predicts the same."""
    line = Pipeline(stages=[FeaturePreparation(inputCols=["good", "noise", "falls"], labelCol="label", minimum=0.5),
                            LinearRegression(labelCol="label", regParam=0.1)]).fit(accounts)
    root = stage_path(spark, "stored")
    line.write().save(f"{root}/model")
    asked = accounts.where("acc_id < 20").drop("label")
    asked.write.parquet(f"{root}/asked")
    here = [(r.acc_id, r.prediction) for r in line.transform(asked).orderBy("acc_id").collect()]
    code = f"""
from churnpanel.session import build_session
from pyspark.ml import PipelineModel
spark = build_session("local[2]", "again", **{{"spark.sql.shuffle.partitions": "2"}})
model = PipelineModel.load({root + "/model"!r})
rows = model.transform(spark.read.parquet({root + "/asked"!r})).orderBy("acc_id").collect()
print("ROWS", [(r.acc_id, r.prediction) for r in rows])
print("KEPT", model.stages[0].columns())
"""
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert f"ROWS {here}" in said.stdout, said.stderr[-2000:]
    assert "KEPT ['good', 'falls']" in said.stdout
    model = PipelineModel.load(f"{root}/model").stages[0]
    assert isinstance(model, FeaturePreparationModel) and model.getOrDefault(model.highs) == line.stages[0].getOrDefault(model.highs)


def test_saved_forests_predict_without_the_training_panel(spark):
    inputs = Inputs(spark, "/root/testdata/sf0.01")
    panel = materialize(imputed_panel({t: inputs.table(f"fx_{t}") for t in RAW_TABLES}, MONEY), "panel")
    root = stage_path(spark, "forests")
    least = {"survival_time": 0.05, "amount_spent": 0.05}
    scores = fit_saved_forests(panel, inputs.label, root, trees=3, depth=3, minimum=least)
    assert set(scores) == set(least) and scores["survival_time"].first().n > 0
    kept = PipelineModel.load(f"{root}/amount_spent").stages[0].columns()
    assert 0 < len(kept) < len(account_squeeze(panel).columns) - 2  # the reduced panel
    some = panel.where("acc_id % 3 = 0")
    all_, part = predict_saved(spark, root, panel), predict_saved(spark, root, some)
    # an account's answer does not depend on who else is asked
    assert part.exceptAll(all_.where("acc_id % 3 = 0")).count() == 0 and part.count() == some.select("acc_id").distinct().count()
    score = predict_and_score(spark, root, some, inputs.label, stage_path(spark, "predictions")).first().score
    assert math.isfinite(score)


def test_prediction_table_has_one_row_per_account(spark):
    rows = spark.createDataFrame([(1, 5, 0.5), (2, 64, 0.0), (2, 3, 1.0)], "acc_id long, survival_time int, amount_spent double")
    path = tables.write_predictions(rows.where("amount_spent < 1").withColumn("extra", F.lit(1)), stage_path(spark, "p"))
    got = tables.read_predictions(spark, path)
    assert got.columns == ["acc_id", "survival_time", "amount_spent"] and got.count() == 2
    path = tables.write_predictions(rows, stage_path(spark, "p"))
    with pytest.raises(Exception, match="more than one prediction for account 2"):
        tables.read_predictions(spark, path).collect()
