"""Whole jobs: raw files → panel → models → predictions → score."""

import math

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from churnpanel.functions.scale import materialize, shared_dir, stage_path
from churnpanel.operators import evaluate, models, routing
from churnpanel.operators.panel import feature_columns
from churnpanel.plans.build_panel import preprocess
from churnpanel.plans.queries import SEQUENCE, _model_rows, _sequence_rows
from churnpanel.plans.train_predict import (
    account_features, predict_accounts, score_submission, train_forests,
)
from churnpanel.schema import RAW_TABLES, SCHEMAS, SPEND_SPLIT
from churnpanel.sources import tables
from churnpanel.sources.adapters import MONEY, Inputs


def raw_like(df, table):
    schema = SCHEMAS[table]
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit("s")).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


@pytest.fixture(scope="module")
def job(spark, inputs):
    root = stage_path(spark, "raw")
    out = stage_path(spark, "out")
    for dataset in ("train", "test1"):
        for t in RAW_TABLES:
            tables.write_raw(raw_like(inputs.table(f"fx_{t}"), t), root, dataset, t, "csv")
    label = raw_like(inputs.label, "label")
    tables.write_labels(label, f"{root}/train_label.csv", "csv")
    for dataset in ("train", "test1"):
        preprocess(spark, root, out, dataset, "csv", MONEY)
    return root, out, label


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_dir(spark) == named


def test_csv_tables_keep_their_schema(spark, job, inputs):
    root, _, _ = job
    raw = tables.load_tables(spark, root, "train", "csv")
    assert raw["trade"].schema == SCHEMAS["trade"]
    assert raw["trade"].where("item_price is null").count() == inputs.trade.where("item_price is null").count()


def test_datasets_are_partitions(spark, job):
    _, out, _ = job
    schema = spark.read.option("header", True).csv(f"{out}/panel_imputed").drop("dataset").schema
    train = tables.read_panel(spark, out, "train", "imputed", schema, "csv")
    test = tables.read_panel(spark, out, "test1", "imputed", schema, "csv")
    assert train.count() == test.count() > 0
    raw = tables.read_panel(spark, out, "train", "raw")
    assert raw.count() == train.count()


def test_label_files(spark, job):
    _, out, label = job
    hot = spark.read.option("header", True).csv(f"{out}/train_label_ohe")
    assert hot.count() == label.count() and "st_64" in hot.columns


def test_train_predict_score(spark, inputs):
    from churnpanel.plans.build_panel import imputed_panel

    raw = {t: inputs.table(f"fx_{t}") for t in RAW_TABLES}
    panel = materialize(imputed_panel(raw, MONEY), "panel")
    root = stage_path(spark, "models")
    label = inputs.label
    fitted = train_forests(panel, label, root, trees=3, depth=3)
    assert "amount_spent" not in fitted["columns"]
    found = predict_accounts(fitted, panel, panel)
    assert found.count() == panel.select("acc_id").distinct().count()
    known = label.join(found.select("acc_id"), "acc_id", "left_semi")
    score = score_submission(found.join(known.select("acc_id"), "acc_id", "left_semi"), known).first().score
    assert math.isfinite(score)
    features, _ = account_features(panel)
    again = models.load_model(f"{root}/survival")
    first = models.predict(fitted["survival"], features, "p").orderBy("acc_id").collect()
    assert first == models.predict(again, features, "p").orderBy("acc_id").collect()


def test_routed_predictions_stay_in_range(spark):
    rows = _sequence_rows(Inputs(spark, "/root/testdata/sf0.01"))
    fitted = routing.fit_routed(rows, 28 * len(SEQUENCE), trees=5, depth=3, hidden=4, iterations=5)
    stored = routing.load_routed(routing.save_routed(fitted, stage_path(spark, "routed")))
    found = routing.routed_predict(rows, stored)
    got = found.toPandas()
    assert got.acc_id.is_unique and len(got) == rows.count()
    assert got.survival_time.between(1, 64).all() and (got.amount_spent >= 0).all()
    again = routing.routed_predict(rows, fitted).toPandas()
    assert got.sort_values("acc_id").values.tolist() == again.sort_values("acc_id").values.tolist()
    # each route reads its own group
    assert "EqualTo(p_amo_group,2)" in found._jdf.queryExecution().toString()
    # better than one constant for everybody, on its own training rows
    rows, cols = _model_rows(Inputs(spark, "/root/testdata/sf0.01"))
    model = models.fit_rf_spend(rows, cols, trees=10, depth=5)
    mse = evaluate.metric_regression(models.predict(model, rows, "amount_spent"), rows).first()
    assert mse.r2 > 0
    assert set(feature_columns(rows)) >= set(cols)


def test_routes_of_empty_groups(spark):
    """No light spender, one heavy value, survivors only: every answer is defined."""
    base = [(i, [float(i % 5), 1.0]) for i in range(40)]
    frame = spark.createDataFrame(base, "acc_id long, x array<double>").select("acc_id", array_to_vector("x").alias("features"))
    lived = frame.withColumns({"survival_time": F.lit(64), "amount_spent": F.when(F.col("acc_id") % 2 == 0, 0.0).otherwise(3.0)})
    fitted = routing.fit_routed(lived, 2, trees=2, depth=2, hidden=2, iterations=3)
    assert {n for n, m in fitted.items() if isinstance(m, routing.ConstantModel)} == {"sur_group", "survival", "light", "heavy"}
    got = routing.routed_predict(frame, fitted).toPandas()
    assert len(got) == 40 and set(got.survival_time) == {64} and set(got.amount_spent) <= {0.0, 3.0}
    # accounts that are sent to a group nobody trained on
    fitted["sur_group"], fitted["amo_group"] = routing.ConstantModel(value=0.0), routing.ConstantModel(value=1.0)
    got = routing.routed_predict(frame, fitted).toPandas()
    assert set(got.survival_time) == {32} and set(got.amount_spent) == {SPEND_SPLIT / 2}
    assert routing.routed_predict(frame.limit(0), fitted).count() == 0
    with pytest.raises(ValueError):
        routing.fit_routed(lived.limit(0), 2)


def test_every_model_predicts_in_its_domain(spark):
    rows, cols = _model_rows(Inputs(spark, "/root/testdata/sf0.01"))
    known = {r.acc_id for r in rows.select("acc_id").collect()}

    def checked(found, name, allowed=None):
        got = found.toPandas()
        assert got.acc_id.is_unique and set(got.acc_id) == known
        assert got[name].map(math.isfinite).all()
        if allowed is not None:
            assert set(got[name]) <= set(allowed)

    grid = models.fit_rf_grid(rows, cols[:5], "sur_group", trees=(2,), depths=(2, 3), leaf_rows=(1,), folds=2)
    checked(models.predict(grid, rows, "p"), "p", (0, 1))
    checked(models.predict(models.fit_svm(rows, cols[:5], "amo_group", iterations=5), rows, "p"), "p", (0, 1, 2))
    checked(models.predict(models.fit_poly_spend(rows, cols[:3]), rows, "p"), "p")
    codes = models.pca_codes(rows, rows, cols, 3)
    assert codes.columns == ["acc_id", "code_0", "code_1", "code_2"]
    checked(codes, "code_0")
    steps = _sequence_rows(Inputs(spark, "/root/testdata/sf0.01"))
    known = {r.acc_id for r in steps.select("acc_id").collect()}
    boosted = models.predict(models.fit_gbt(steps, rounds=3), steps, "p")
    checked(boosted, "p")
    # boosting beats the constant on its own rows
    error = boosted.join(steps, "acc_id").agg(
        F.avg(F.pow(F.col("p") - F.col("survival_time"), 2)).alias("mine"), F.var_pop("survival_time").alias("constant")).first()
    assert error.mine < error.constant
    group = models.fit_group(steps, 28 * len(SEQUENCE), "amo_group", 3, hidden=4, iterations=5)
    checked(models.predict(group, steps, "p"), "p", (0, 1, 2))
