"""Combat rollups, majority classes and level history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnpanel.functions.exprs import count_if, sum0
from churnpanel.schema import CLASSES, COMBAT_MEASURES, KEYS, LEVEL_COLUMNS, MAJOR_SHARE


def major_class(combat: DataFrame, share: float = MAJOR_SHARE) -> DataFrame:
    """Classes in descending frequency whose cumulative share is within ``share``.

    Ties go to the smaller class.  The window sees one row per class (eight at
    most); integer counts are compared, so no rounding decides membership."""
    counts = combat.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(F.desc("n"), "class").rowsBetween(Window.unboundedPreceding, 0)
    limit = round(share * 1000)
    return counts.select(
        "class", "n",
        F.sum("n").over(order).alias("cum_n"),
        F.sum("n").over(Window.partitionBy()).alias("total_n"),
    ).select(
        "class", "n", "cum_n",
        (F.col("cum_n") * 1000 <= F.col("total_n") * limit).cast("int").alias("is_major"),
    )


def _is_major(combat: DataFrame, share: float):
    majors = major_class(combat, share).where("is_major = 1").agg(F.collect_list("class")).scalar()
    return F.array_contains(majors, F.col("class")).cast("int")


def level_progress(combat: DataFrame) -> DataFrame:
    """First and last level per character by day, summed and averaged per account.

    Rows of one day are ordered by ``row_seq`` where the table has it, else by
    level, so the result never depends on the layout of the files."""
    tie = "row_seq" if "row_seq" in combat.columns else "level"
    moment = F.struct("day", tie)
    per_char = combat.groupBy("acc_id", "char_id").agg(
        F.min_by("level", moment).alias("first_lv"), F.max_by("level", moment).alias("last_lv")
    )
    return per_char.groupBy("acc_id").agg(
        F.sum("first_lv").alias("tot_start_lv"),
        F.sum("last_lv").alias("tot_end_lv"),
        F.sum(F.col("last_lv") - F.col("first_lv")).alias("changed_lv"),
        F.avg("first_lv").alias("avg_start_lv"),
        F.avg("last_lv").alias("avg_end_lv"),
    )


def combat_daily(combat: DataFrame, share: float = MAJOR_SHARE, levels: bool = True) -> DataFrame:
    """(acc_id, day): summed counts, number of rows, share of majority-class rows,
    and the account's level history on each of its days."""
    daily = (
        combat.withColumn("_major", _is_major(combat, share))
        .groupBy(*KEYS)
        .agg(
            *[sum0(c).alias(c) for c in COMBAT_MEASURES],
            F.count(F.lit(1)).alias("combat_count"),
            F.avg("_major").alias("isMajorClass"),
        )
        .withColumn("combat_logged_in", F.lit(1))
    )
    if not levels:
        return daily
    # both sides hold at most a calendar of rows per account: no hot key is left
    return daily.join(level_progress(combat), "acc_id", "left").select(*daily.columns, *LEVEL_COLUMNS)


def level_stats(combat: DataFrame) -> DataFrame:
    return combat.groupBy("acc_id").agg(
        F.max("level").alias("maxlevel"),
        F.avg("level").alias("meanlevel"),
        F.min("level").alias("minlevel"),
        F.sum("level").alias("totlevel"),
    )


def server_levels(combat: DataFrame) -> DataFrame:
    return combat.groupBy("server", "acc_id").agg(
        F.max("level").alias("maxlevel"), F.avg("level").alias("meanlevel")
    )


def combat_class_pivot(combat: DataFrame, classes: list[int] = CLASSES) -> DataFrame:
    return combat.groupBy(*KEYS).agg(
        *[count_if(f"class = {c}").alias(f"class_{c}") for c in classes]
    )


def nontemp_combat(combat: DataFrame) -> DataFrame:
    """Combat that is not incidental: all opponents' counts but ``temp_cnt``."""
    kept = [c for c in COMBAT_MEASURES if c not in ("temp_cnt", "num_opponent")]
    daily = combat.groupBy(*KEYS).agg(*[sum0(c).alias(c) for c in kept])
    total = F.col(kept[0])
    for c in kept[1:]:
        total = total + F.col(c)
    return daily.select(*KEYS, total.alias("non_temp_cnt"))


def attack_kill(combat_day: DataFrame, activity_day: DataFrame) -> DataFrame:
    """Attacks started times monsters killed, on days with both records."""
    return combat_day.join(activity_day.select(*KEYS, "npc_kill"), KEYS).select(
        *KEYS, (F.col("random_attacker_cnt") * F.col("npc_kill")).alias("attack_kill")
    )
