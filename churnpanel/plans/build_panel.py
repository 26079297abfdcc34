"""Raw tables → complete account-day panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnpanel.operators.activity import activity_daily
from churnpanel.operators.combat import combat_daily
from churnpanel.operators.evaluate import label_onehot
from churnpanel.operators.panel import (
    account_calendar, base_accounts, panel_fill, panel_impute, panel_join, rename_prefix,
)
from churnpanel.operators.payment import payment_transform
from churnpanel.operators.pledge import pledge_daily
from churnpanel.operators.trade import trade_daily
from churnpanel.schema import MONEY_ITEM
from churnpanel.sources.tables import load_label, load_tables, write_labels, write_panel


def joined_panel(raw: dict[str, DataFrame], money: str = MONEY_ITEM, spine: str = "combat",
                 stats_scope: str = "payment_days", on_calendar: bool = False) -> DataFrame:
    """Roll up the five raw tables and join them, one row per active day, or per day of
    the calendar of every combat account."""
    base = base_accounts(raw["combat"])
    return panel_join(
        combat_daily(raw["combat"]),
        pledge_daily(raw["pledge"]),
        trade_daily(raw["trade"], base, money),
        activity_daily(raw["activity"]),
        payment_transform(raw["payment"]),
        spine, stats_scope, account_calendar(base) if on_calendar else None,
    )


def filled_panel(raw: dict[str, DataFrame], money: str = MONEY_ITEM, **options) -> DataFrame:
    """The joined panel on the full calendar, NULL where nothing is known."""
    if options.get("spine", "combat") == "combat":
        return joined_panel(raw, money, on_calendar=True, **options)
    return panel_fill(joined_panel(raw, money, **options))


def imputed_panel(raw: dict[str, DataFrame], money: str = MONEY_ITEM, **options) -> DataFrame:
    return panel_impute(rename_prefix(filled_panel(raw, money, **options)))


def preprocess(
    spark: SparkSession, raw_root: str, out_root: str, dataset: str, fmt: str = "parquet",
    money: str = MONEY_ITEM, **options,
) -> DataFrame:
    """The whole job for one dataset: load, build, store the raw and the imputed
    panel, and (for training data) the label tables.

    The imputed panel is computed from the stored raw panel, so the five rollups
    run once although two variants are written."""
    if dataset == "train":
        label = load_label(spark, f"{raw_root}/train_label.{fmt}", fmt)
        write_labels(label, f"{out_root}/train_label", fmt)
        write_labels(label_onehot(label), f"{out_root}/train_label_ohe", fmt)
    raw = load_tables(spark, raw_root, dataset, fmt)
    panel = filled_panel(raw, money, **options)
    path = write_panel(panel, out_root, dataset, "raw")
    stored = spark.read.schema(panel.schema).parquet(f"{path}/dataset={dataset}")
    imputed = panel_impute(rename_prefix(stored))
    write_panel(imputed, out_root, dataset, "imputed", fmt)
    return imputed
