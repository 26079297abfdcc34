"""Daily activity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnpanel.functions.exprs import ratio, sum0, unit_scale
from churnpanel.functions.scale import with_scalars
from churnpanel.schema import ACTIVITY_MEASURES, KEYS


def activity_daily(activity: DataFrame) -> DataFrame:
    """(acc_id, day): summed measures, total experience, per-playtime ratios."""
    daily = activity.groupBy(*KEYS).agg(*[sum0(c).alias(c) for c in ACTIVITY_MEASURES])
    return daily.select(
        "*",
        (F.col("solo_exp") + F.col("party_exp") + F.col("quest_exp")).alias("total_exp"),
        ratio("fishing", "playtime").alias("fishing_prop"),
        ratio("quest_exp", "playtime").alias("qexp_per_playtime"),
        ratio("solo_exp", "playtime").alias("sexp_per_playtime"),
        ratio("party_exp", "playtime").alias("pexp_per_playtime"),
        F.lit(1).alias("activity_logged_in"),
    )


def total_playtime(activity: DataFrame) -> DataFrame:
    return activity.groupBy("acc_id").agg(sum0("playtime").alias("total_play_time"))


def playtime_cumulative(activity: DataFrame) -> DataFrame:
    """Running playtime of an account; at most one row per day enters the window."""
    daily = activity.groupBy(*KEYS).agg(sum0("playtime").alias("playtime"))
    upto = Window.partitionBy("acc_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("cum_play_time", F.sum("playtime").over(upto))


def server_rollup(activity: DataFrame) -> DataFrame:
    return activity.groupBy("server", *KEYS).agg(*[sum0(c).alias(c) for c in ACTIVITY_MEASURES])


def server_code_mean(activity: DataFrame, codes) -> DataFrame:
    """(acc_id, day): mean of the encoded server beside the summed playtime.
    ``codes`` maps the server column to its alphabetical code."""
    return activity.groupBy(*KEYS).agg(
        F.avg(codes(F.col("server"))).alias("server_code"), sum0("playtime").alias("playtime")
    )


def activity_index(daily: DataFrame) -> DataFrame:
    """Sum of five activity measures, each scaled to [0, 1] over all account-days."""
    parts = ["game_money_change", "private_shop", "fishing", "enchant_count", "playtime"]
    rows, bounds = with_scalars(
        daily, daily, "_bounds",
        **{f"lo_{c}": f"min({c})" for c in parts},
        **{f"hi_{c}": f"max({c})" for c in parts},
    )
    scaled = [unit_scale(c, bounds[f"lo_{c}"], bounds[f"hi_{c}"]) for c in parts]
    return rows.select(*KEYS, F.expr(" + ".join(scaled)).alias("activity_index"))


def death_rate(daily: DataFrame) -> DataFrame:
    return daily.select(*KEYS, ratio("death", "playtime").alias("death_per_playtime"))


def boss_hits(activity: DataFrame) -> DataFrame:
    return activity.groupBy("acc_id").agg(sum0("rich_monster").alias("boss_hits"))
