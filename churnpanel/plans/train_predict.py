"""Panel + labels → models → predictions → score."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession

from churnpanel.functions.scale import materialize
from churnpanel.operators.evaluate import metric_accuracy, metric_regression, score_profit
from churnpanel.operators.models import (
    fit_rf_spend, fit_rf_survival, predict, save_model,
)
from churnpanel.operators.panel import account_squeeze, feature_columns
from churnpanel.operators.preparation import FeaturePreparation
from churnpanel.operators.scaling import minmax_scale, split_by_key
from churnpanel.schema import SPEND_MIN_CORR, SURVIVAL_MIN_CORR
from churnpanel.sources.tables import read_predictions, write_predictions


def account_features(panel: DataFrame, fit_on: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """Squeezed and scaled account features.  The day's own spend is left out: it is
    what the models predict."""
    # read twice (for the range, then for the rows): stored once, one row per account
    squeezed = materialize(account_squeeze(panel.drop("amount_spent")), "squeezed")
    columns = feature_columns(squeezed)
    fit = account_squeeze(fit_on.drop("amount_spent")) if fit_on is not None else None
    return minmax_scale(squeezed, columns, fit), columns


def train_forests(panel: DataFrame, label: DataFrame, model_root: str | None = None,
                  trees: int = 50, depth: int = 10) -> dict:
    """Fit both forests on 80 % of the accounts and judge them on the rest."""
    features, columns = account_features(panel)
    rows = materialize(split_by_key(features.join(label, "acc_id")), "account-features")
    train, held = rows.where("part = 'train'"), rows.where("part = 'test'")
    survival = fit_rf_survival(train, columns, trees, depth)
    spend = fit_rf_spend(train, columns, trees, depth)
    if model_root:
        save_model(survival, f"{model_root}/survival")
        save_model(spend, f"{model_root}/spend")
    return {
        "columns": columns, "survival": survival, "spend": spend,
        "accuracy": metric_accuracy(predict(survival, held, "survival_time"), held),
        "regression": metric_regression(predict(spend, held, "amount_spent"), held),
    }


def predict_accounts(models: dict, panel: DataFrame, train_panel: DataFrame) -> DataFrame:
    """acc_id, survival_time, amount_spent for a test panel on the training scale."""
    features, _ = account_features(panel, fit_on=train_panel)
    first = models["survival"].transform(features).select(
        "acc_id", *models["columns"], "prediction"
    ).withColumnRenamed("prediction", "survival_time")
    return models["spend"].transform(first).select(
        "acc_id", "survival_time", "prediction"
    ).withColumnRenamed("prediction", "amount_spent")


def fit_saved_forests(panel: DataFrame, label: DataFrame, root: str, trees: int = 50, depth: int = 10,
                      seed: int = 42, minimum: dict | None = None) -> dict:
    """Fit both forests, each on the columns correlated with its label and on its own
    stored scale, and store them below ``root``: all that ``predict_saved`` needs.

    Returns the scores on the fifth of the accounts held out."""
    least = minimum or {"survival_time": SURVIVAL_MIN_CORR, "amount_spent": SPEND_MIN_CORR}
    squeezed = account_squeeze(panel.drop("amount_spent"))
    columns = feature_columns(squeezed)
    rows = materialize(split_by_key(squeezed.join(label, "acc_id")), "training-accounts")
    train, held = rows.where("part = 'train'"), rows.where("part = 'test'")
    out = {}
    for name, forest in (("survival_time", RandomForestClassifier), ("amount_spent", RandomForestRegressor)):
        ready = FeaturePreparation(inputCols=columns, labelCol=name, minimum=least[name])
        model = Pipeline(stages=[ready, forest(labelCol=name, numTrees=trees, maxDepth=depth, seed=seed)]).fit(train)
        save_model(model, f"{root}/{name}")
        judge = metric_accuracy if name == "survival_time" else metric_regression
        out[name] = judge(predict(model, held, name), held)
    return out


def predict_saved(spark: SparkSession, root: str, panel: DataFrame) -> DataFrame:
    """acc_id, survival_time, amount_spent of a panel, by the stored models alone."""
    rows = materialize(account_squeeze(panel.drop("amount_spent")), "asked-accounts")
    parts = {name: predict(PipelineModel.load(f"{root}/{name}"), rows, name) for name in ("survival_time", "amount_spent")}
    return parts["survival_time"].join(parts["amount_spent"], "acc_id")


def predict_and_score(spark: SparkSession, root: str, panel: DataFrame, actual: DataFrame, out: str, **parameters) -> DataFrame:
    """Write the prediction table, and score what is read back from it."""
    write_predictions(predict_saved(spark, root, panel), out)
    stored = read_predictions(spark, out)
    return score_submission(stored, actual.join(stored.select("acc_id"), "acc_id", "left_semi"), **parameters)


def score_submission(predicted: DataFrame, actual: DataFrame, **parameters) -> DataFrame:
    return score_profit(predicted, actual, **parameters)
