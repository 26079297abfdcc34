"""Labels, expected profit and quality metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnpanel.functions.exprs import count_if, log_or_zero, spend_group, survival_group
from churnpanel.schema import SURVIVED


def label_totals(label: DataFrame) -> DataFrame:
    return label.withColumn("total_spent", F.col("survival_time") * F.col("amount_spent"))


def label_groups(label: DataFrame) -> DataFrame:
    return label.withColumns({"amo_group": spend_group(), "sur_group": survival_group()})


def group_sizes(label: DataFrame) -> DataFrame:
    return label_groups(label).groupBy("amo_group", "sur_group").agg(F.count(F.lit(1)).alias("n"))


def label_onehot(label: DataFrame, last: int = SURVIVED) -> DataFrame:
    """acc_id, one 0/1 column per survival time, amount_spent."""
    return label.select(
        "acc_id",
        *[F.when(F.col("survival_time") == t, 1).otherwise(0).alias(f"st_{t}")
          for t in range(1, last + 1)],
        "amount_spent",
    )


def log_spend(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(f"log_{column}", log_or_zero(column))


def nonzero_spend(df: DataFrame, column: str = "amount_spent") -> DataFrame:
    return df.where(F.col(column) != 0)


def route_by_group(features: DataFrame, groups: DataFrame, group: str, value: int) -> DataFrame:
    """Feature rows of the accounts in one group.  The filter comes first, so only
    that group's accounts enter the join."""
    chosen = groups.where(F.col(group) == value).select("acc_id", group)
    return features.join(chosen, "acc_id")


def _paired(pred: DataFrame, actual: DataFrame) -> DataFrame:
    p = pred.select(
        "acc_id", F.col("survival_time").alias("p_surv"), F.col("amount_spent").alias("p_spent"),
        F.lit(1).alias("in_pred"),
    )
    a = actual.select(
        "acc_id", F.col("survival_time").alias("a_surv"), F.col("amount_spent").alias("a_spent"),
        F.lit(1).alias("in_actual"),
    )
    return p.join(a, "acc_id", "full")


def score_keycheck(pred: DataFrame, actual: DataFrame) -> DataFrame:
    """Accounts that only one of the two tables has; empty when they can be scored."""
    pairs = _paired(pred, actual)
    return pairs.where("in_pred is null or in_actual is null").select(
        "acc_id", F.coalesce("in_pred", F.lit(0)).alias("in_pred"),
        F.coalesce("in_actual", F.lit(0)).alias("in_actual"),
    )


def _profit_terms(S: float, alpha: float, L: float, sigma: float) -> dict[str, Column]:
    gives_up = F.col("p_surv") == SURVIVED
    cost = F.when(gives_up, 0.0).otherwise(F.lit(alpha * S) * F.col("p_spent"))
    best = F.when(gives_up, 0.0).otherwise(F.lit(alpha * S) * F.col("a_spent"))
    reached = cost / F.nullif(best, F.lit(0.0))
    gamma = (
        F.when(reached.isNull() | (reached < L), 0.0)
        .when(reached >= 1, 1.0)
        .otherwise(reached / (1 - L) - L / (1 - L))
    )
    gap = F.col("p_surv") - F.col("a_surv")
    added = F.when(gives_up | (F.col("a_surv") == SURVIVED), 0.0).otherwise(
        S * F.exp(-(gap * gap) / (2.0 * sigma * sigma))
    )
    return {"cost": cost, "gamma": gamma, "t_k": added}


def score_per_account(
    pred: DataFrame, actual: DataFrame, S: float = 30, alpha: float = 0.01,
    L: float = 0.1, sigma: float = 15,
) -> DataFrame:
    """Cost, response rate, added days and profit of every account both tables have."""
    pairs = _paired(pred, actual).where("in_pred = 1 and in_actual = 1")
    terms = pairs.select(
        "acc_id", "p_surv", "p_spent", "a_surv", "a_spent",
        *[c.alias(n) for n, c in _profit_terms(S, alpha, L, sigma).items()],
    )
    return terms.withColumn("profit", F.col("gamma") * F.col("t_k") * F.col("a_spent") - F.col("cost"))


def score_profit(
    pred: DataFrame, actual: DataFrame, S: float = 30, alpha: float = 0.01,
    L: float = 0.1, sigma: float = 15,
) -> DataFrame:
    """Total expected profit.  Fails when the two account sets differ; check and sum
    share one join and one aggregation."""
    pairs = _paired(pred, actual)
    t = _profit_terms(S, alpha, L, sigma)
    profit = t["gamma"] * t["t_k"] * F.col("a_spent") - t["cost"]
    total = pairs.agg(
        F.sum(profit).alias("score"),
        count_if("in_pred is null or in_actual is null").alias("unmatched"),
    )
    failed = F.raise_error(F.lit("account ids of prediction and actual label do not match"))
    return total.select(
        F.when(F.col("unmatched") > 0, failed.cast("double")).otherwise(F.col("score")).alias("score")
    )


def score_by_group(pred: DataFrame, actual: DataFrame, **parameters) -> DataFrame:
    """Profit by predicted spend and survival group."""
    scored = score_per_account(pred, actual, **parameters)
    return scored.groupBy(
        spend_group("p_spent").alias("amo_group"), survival_group("p_surv").alias("sur_group")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("profit").alias("profit"))


def metric_accuracy(pred: DataFrame, actual: DataFrame, column: str = "survival_time") -> DataFrame:
    """Share of equal values and number of distinct predicted values."""
    pairs = pred.select("acc_id", F.col(column).alias("p")).join(
        actual.select("acc_id", F.col(column).alias("a")), "acc_id"
    )
    # first per predicted value, so the distinct count needs no second shuffle of rows
    per_value = pairs.groupBy("p").agg(
        F.count(F.lit(1)).alias("n"), count_if("p = a").alias("hits")
    )
    return per_value.agg(
        (F.sum("hits") / F.sum("n")).alias("accuracy"),
        F.count("p").alias("n_predicted_labels"), F.sum("n").alias("n"),
    )


def metric_regression(pred: DataFrame, actual: DataFrame, column: str = "amount_spent") -> DataFrame:
    """Mean squared error and R²."""
    pairs = pred.select("acc_id", F.col(column).cast("double").alias("p")).join(
        actual.select("acc_id", F.col(column).cast("double").alias("a")), "acc_id"
    )
    err = F.col("p") - F.col("a")
    return pairs.agg(
        F.avg(err * err).alias("mse"),
        (1 - F.sum(err * err) / F.nullif(F.var_pop("a") * F.count("a"), F.lit(0.0))).alias("r2"),
    )
