"""Group (pledge) scores and rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnpanel.functions.exprs import ratio, sum0
from churnpanel.functions.scale import salted_join, with_scalars
from churnpanel.schema import KEYS, PLEDGE_MEASURES, PLEDGE_RENAME, PLEDGE_SCORES


def pledge_scores(pledge: DataFrame, size: str = "rows") -> DataFrame:
    """Per group: mean player count and total combats, each relative to the best
    group (1.0), and the group's size in rows or in distinct accounts."""
    n = F.count(F.lit(1)) if size == "rows" else F.count_distinct("acc_id")
    groups = pledge.groupBy("pledge_id").agg(
        F.avg("play_char_cnt").alias("play_rate"),
        sum0("pledge_combat_cnt").alias("combats"),
        n.alias("pledge_num_people"),
    )
    # ``people`` is asked for only so that both uses of ``groups`` read the same
    # columns: Spark then runs the group aggregation once and reuses its shuffle
    rows, top = with_scalars(
        groups, groups, "_top", play="max(play_rate)", combats="max(combats)",
        people="max(pledge_num_people)",
    )
    return rows.select(
        "pledge_id",
        ratio("play_rate", top["play"]).alias("avg_play_rate_per_pledge"),
        ratio("combats", top["combats"]).alias("total_combat_cnt_per_pledge"),
        "pledge_num_people",
    )


def pledge_daily(pledge: DataFrame, size: str = "rows") -> DataFrame:
    """(acc_id, day): summed measures, summed group scores, mean group size.

    Rows are summed per (account, day, group) before the scores join them, and
    the join is salted: one huge group neither moves its raw rows nor lands in
    one task."""
    local = pledge.groupBy(*KEYS, "pledge_id").agg(
        *[sum0(c).alias(c) for c in PLEDGE_MEASURES], F.count(F.lit(1)).alias("_n")
    )
    scored = salted_join(local, pledge_scores(pledge, size), ["pledge_id"], "left", spread=KEYS)
    daily = scored.groupBy(*KEYS).agg(
        *[sum0(c).alias(c) for c in PLEDGE_MEASURES],
        *[sum0(F.col(c) * F.col("_n")).alias(c) for c in PLEDGE_SCORES],
        (F.sum(F.col("pledge_num_people") * F.col("_n")) / F.sum("_n")).alias("pledge_num_people"),
    )
    return daily.withColumn("pledge_logged_in", F.lit(1)).withColumnsRenamed(PLEDGE_RENAME)


def pledge_strength(pledge: DataFrame) -> DataFrame:
    """Combat characters per group and the documented ratios of group totals."""
    totals = pledge.groupBy("pledge_id").agg(
        *[sum0(c).alias(c) for c in
          ("combat_char_cnt", "pledge_combat_cnt", "same_pledge_cnt", "combat_play_time")]
    )
    return totals.select(
        "pledge_id", "combat_char_cnt",
        ratio("combat_char_cnt", "pledge_combat_cnt").alias("char_per_combat"),
        ratio("same_pledge_cnt", "combat_char_cnt").alias("same_pledge_per_char"),
        ratio("combat_play_time", "combat_char_cnt").alias("combat_time_per_char"),
    )
