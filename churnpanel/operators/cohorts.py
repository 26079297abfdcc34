"""Documented cohort features that combine several tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnpanel.functions.exprs import count_if, fixed_bin, sum0
from churnpanel.functions.scale import salted_join, with_scalars
from churnpanel.schema import KEYS


def server_rank(activity: DataFrame, label: DataFrame) -> DataFrame:
    """Servers by mean survival and mean spend of the accounts that play there.
    The rank windows see one row per server."""
    members = activity.select("server", "acc_id").distinct().join(label, "acc_id")
    servers = members.groupBy("server").agg(
        F.count(F.lit(1)).alias("n_accounts"),
        F.avg("survival_time").alias("mean_survival"),
        F.avg("amount_spent").alias("mean_spent"),
    )
    return servers.select(
        "*",
        F.rank().over(Window.orderBy(F.desc(F.round("mean_survival", 9)))).alias("survival_rank"),
        F.rank().over(Window.orderBy(F.desc(F.round("mean_spent", 9)))).alias("spend_rank"),
    )


def attack_top_server(combat: DataFrame, activity: DataFrame, label: DataFrame) -> DataFrame:
    """Attacks started per account on the server with the highest mean spend."""
    top = server_rank(activity, label).where("spend_rank = 1").agg(F.min("server")).scalar()
    return combat.where(F.col("server") == top).groupBy("acc_id").agg(
        sum0("random_attacker_cnt").alias("top_server_attacks")
    )


def class_cohort(
    combat: DataFrame, label: DataFrame, classes: tuple[int, ...] = (1, 2, 3, 7), max_level: int = 50
) -> DataFrame:
    """Mean spend by class, for all of its accounts and for those still at or below
    ``max_level``, with the days each cohort fought."""
    days = combat.where(F.col("class").isin(list(classes))).groupBy("class", *KEYS).agg(
        F.max("level").alias("level")
    )
    accounts = days.groupBy("class", "acc_id").agg(
        F.max("level").alias("level"), F.count(F.lit(1)).alias("days")
    )
    low = F.col("level") <= max_level
    return accounts.join(label, "acc_id").groupBy("class").agg(
        F.count(F.lit(1)).alias("n_accounts"),
        F.avg("amount_spent").alias("mean_spent"),
        count_if(f"level <= {max_level}").alias("n_low"),
        F.avg(F.when(low, F.col("amount_spent"))).alias("mean_spent_low"),
        F.avg(F.when(low, F.col("days"))).alias("mean_days_low"),
    )


def _top_bin(df: DataFrame, columns: list[str], bins: int) -> DataFrame:
    df, b = with_scalars(
        df, df, "_b", **{f"lo_{c}": f"min({c})" for c in columns},
        **{f"hi_{c}": f"max({c})" for c in columns},
    )
    for c in columns:
        df = df.where(f"{fixed_bin(c, b[f'lo_{c}'], b[f'hi_{c}'], bins)} = {bins - 1}")
    return df.drop("_b")


def top_bin_cohort(activity: DataFrame, label: DataFrame, bins: int = 3) -> DataFrame:
    """Accounts in the top equal-width bin of both money change and enchant count,
    with their labels."""
    totals = activity.groupBy("acc_id").agg(
        sum0("game_money_change").alias("money"), sum0("enchant_count").alias("enchant")
    )
    return _top_bin(totals, ["money", "enchant"], bins).join(label, "acc_id", "left")


def heavy_traders(activity: DataFrame, trade: DataFrame, bins: int = 3) -> DataFrame:
    """Accounts in the top playtime bin that trade on either side."""
    totals = activity.groupBy("acc_id").agg(sum0("playtime").alias("playtime"))
    traders = trade.select(
        F.explode(F.array("source_acc_id", "target_acc_id")).alias("acc_id")
    ).distinct()
    return _top_bin(totals, ["playtime"], bins).join(traders, "acc_id", "left_semi")


def pledge_co_trade(pledge: DataFrame, ledger: DataFrame) -> DataFrame:
    """(acc_id, day): 1 if another member of the account's group traded in the same
    time bin of that day.

    Members are counted per (group, day, bin); no pair of members is formed.  Only
    the count travels back, through a salted join, so a huge group is spread."""
    members = pledge.select("pledge_id", *KEYS).distinct()
    trades = ledger.select(*KEYS, "time_bin").distinct()
    # both sides: at most a few rows per (account, day)
    present = trades.join(members, KEYS)
    slot = ["pledge_id", "day", "time_bin"]
    sizes = present.groupBy(*slot).agg(F.count(F.lit(1)).alias("traders"))
    flagged = salted_join(present, sizes, slot, "inner", spread=["acc_id"])
    return flagged.groupBy(*KEYS).agg(
        F.max(F.when(F.col("traders") > 1, 1).otherwise(0)).alias("co_trade")
    )


def combat_trade_day(combat: DataFrame, ledger: DataFrame, payment_day: DataFrame) -> DataFrame:
    """Spend on combat days, split by whether the account also traded that day."""
    fights = combat.select(*KEYS).distinct()
    trades = ledger.select(*KEYS).distinct().withColumn("_traded", F.lit(1))
    days = fights.join(trades, KEYS, "left").join(
        payment_day.select(*KEYS, "amount_spent"), KEYS, "left"
    )
    return days.groupBy(F.coalesce("_traded", F.lit(0)).alias("traded")).agg(
        F.count(F.lit(1)).alias("n_days"),
        sum0("amount_spent").alias("tot_spent"),
        F.avg(F.coalesce("amount_spent", F.lit(0.0))).alias("mean_spent"),
        count_if("amount_spent > 0").alias("n_paid_days"),
    )
