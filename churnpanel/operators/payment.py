"""Daily payments and account payment statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnpanel.functions.exprs import sum0
from churnpanel.schema import KEYS


def payment_daily(payment: DataFrame) -> DataFrame:
    """One row per (acc_id, day), so a second payment cannot duplicate a panel day."""
    return payment.groupBy(*KEYS).agg(sum0("amount_spent").alias("amount_spent"))


def _stats(over=None) -> list:
    spent = {
        "max_spent": F.max("amount_spent"),
        "min_spent": F.min("amount_spent"),
        "mean_spent": F.avg("amount_spent"),
        "tot_spent": F.sum("amount_spent"),
        "median_spent": F.median("amount_spent"),
    }
    return [(c.over(over) if over is not None else c).alias(n) for n, c in spent.items()]


def payment_stats(payment: DataFrame) -> DataFrame:
    """Per account, over its payment days (at most one calendar of values, so the
    exact median holds a bounded number of them)."""
    return payment_daily(payment).groupBy("acc_id").agg(*_stats())


def payment_transform(payment: DataFrame) -> DataFrame:
    """Payment days, each carrying the account's statistics."""
    account = Window.partitionBy("acc_id")
    return payment_daily(payment).select(
        *KEYS, "amount_spent", *_stats(account), F.lit(1).alias("payment_logged_in")
    )


def payment_total(payment: DataFrame) -> DataFrame:
    return payment.groupBy("acc_id").agg(sum0("amount_spent").alias("total_payment"))
