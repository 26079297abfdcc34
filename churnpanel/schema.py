"""Declared schemas, closed vocabularies and column lists.

Nothing in the engine infers a schema or discovers a vocabulary from data:
pivots, one-hot blocks and renames are all known when the plan is built.
"""

from __future__ import annotations

from pyspark.sql import types as T

KEYS = ["acc_id", "day"]

# ---------------------------------------------------------------------------
# They must equal the source data's own names and limits.
# ---------------------------------------------------------------------------
DAYS = 28
SURVIVED = 64
CLASSES = list(range(8))
ITEM_TYPES = ["accessory", "adena", "armor", "enchant_scroll", "etc", "spell", "weapon"]
MONEY_ITEM = "adena"
MAJOR_SHARE = 0.6
SPEND_SPLIT = 0.27
SPEND_MIN_CORR = 0.3
SURVIVAL_MIN_CORR = 0.1

ACTIVITY_MEASURES = [
    "playtime", "npc_kill", "solo_exp", "party_exp", "quest_exp", "rich_monster",
    "death", "revive", "exp_recovery", "fishing", "private_shop",
    "game_money_change", "enchant_count",
]
COMBAT_MEASURES = [
    "pledge_cnt", "random_attacker_cnt", "random_defender_cnt", "temp_cnt",
    "same_pledge_cnt", "etc_cnt", "num_opponent",
]
PLEDGE_MEASURES = [
    "play_char_cnt", "combat_char_cnt", "pledge_combat_cnt", "random_attacker_cnt",
    "random_defender_cnt", "same_pledge_cnt", "temp_cnt", "etc_cnt",
    "combat_play_time", "non_combat_play_time",
]
# Pledge columns whose names also occur in the combat table.
PLEDGE_RENAME = {
    "etc_cnt": "p_etc_cnt",
    "random_attacker_cnt": "p_random_attacker_cnt",
    "random_defender_cnt": "p_random_defender_cnt",
    "same_pledge_cnt": "p_same_pledge_cnt",
    "temp_cnt": "p_temp_cnt",
}
# Final panel names, by the table a column came from.
PANEL_RENAME = {
    "etc_cnt": "c_etc_cnt",
    "num_opponent": "c_num_opponent",
    "pledge_cnt": "c_pledge_cnt",
    "random_attacker_cnt": "c_random_attacker_cnt",
    "random_defender_cnt": "c_random_defender_cnt",
    "same_pledge_cnt": "c_same_pledge_cnt",
    "temp_cnt": "c_temp_cnt",
    "avg_play_rate_per_pledge": "avg_play_rate_rank_per_p",
    "combat_char_cnt": "p_c_char_cnt",
    "combat_play_time": "p_c_sum_play_time",
    "non_combat_play_time": "p_non_c_sum_play_time",
    "play_char_cnt": "p_play_char_cnt",
    "pledge_combat_cnt": "p_c_cnt",
    "total_combat_cnt_per_pledge": "tot_c_rank_per_p",
    "total_item_price": "tot_item_price",
    "death": "a_death_cnt",
    "enchant_count": "a_enchant_count",
    "exp_recovery": "a_exp_recovery_cnt",
    "fishing": "a_fish",
    "game_money_change": "a_money_change",
    "npc_kill": "a_npc_kill",
    "party_exp": "a_party_exp",
    "playtime": "a_playtime",
    "private_shop": "a_private_shop",
    "quest_exp": "a_quest_exp",
    "revive": "a_revive_cnt",
    "rich_monster": "a_boss_monster",
    "solo_exp": "a_solo_exp",
    "total_exp": "tot_exp",
}
# Panel columns filled with the account's own mean; every other one gets zero.
MEAN_FILL = [
    "p_c_char_cnt", "p_c_sum_play_time", "p_non_c_sum_play_time", "p_etc_cnt",
    "p_play_char_cnt", "p_c_cnt", "p_random_attacker_cnt", "p_random_defender_cnt",
    "p_same_pledge_cnt", "p_temp_cnt", "tot_c_rank_per_p", "isMajorClass",
    "avg_play_rate_rank_per_p",
]
# Panel columns averaged, not summed, when an account is squeezed to one row.
SQUEEZE_MEAN = ["isMajorClass", "avg_play_rate_rank_per_p", "tot_c_rank_per_p"]
# ---------------------------------------------------------------------------

LEVEL_COLUMNS = ["tot_start_lv", "tot_end_lv", "changed_lv", "avg_start_lv", "avg_end_lv"]
PLEDGE_SCORES = ["avg_play_rate_per_pledge", "total_combat_cnt_per_pledge"]
TRADE_DAILY_COLUMNS = [
    "sell_item_amount", "sell_item_price", "get_item_amount", "get_item_price",
    *[f"trade_time_bin_{b}" for b in range(4)],
    "trade_type_0", "trade_type_1", "tot_trade_amount", "tot_get_money",
    "trade_logged_in", "count_sell", "count_get", "total_trade_count",
]
PAYMENT_STATS = ["max_spent", "min_spent", "mean_spent", "tot_spent", "median_spent"]


def _struct(ints="", longs="", strings="", doubles=()):
    fields = [T.StructField(c, T.IntegerType()) for c in ints.split()]
    fields += [T.StructField(c, T.LongType()) for c in longs.split()]
    fields += [T.StructField(c, T.StringType()) for c in strings.split()]
    fields += [T.StructField(c, T.DoubleType()) for c in doubles]
    return {f.name: f for f in fields}


def _ordered(fields, names):
    return T.StructType([fields[n] for n in names])


_activity = _struct("day", "acc_id char_id", "server", ACTIVITY_MEASURES)
_combat = _struct("day class level", "acc_id char_id", "server", COMBAT_MEASURES)
_pledge = _struct("day", "acc_id char_id pledge_id", "server", PLEDGE_MEASURES)
_trade = _struct(
    "day type",
    "source_acc_id source_char_id target_acc_id target_char_id",
    "time server item_type",
    ["item_amount", "item_price"],
)

SCHEMAS: dict[str, T.StructType] = {
    "activity": _ordered(_activity, ["day", "acc_id", "char_id", "server", *ACTIVITY_MEASURES]),
    "combat": _ordered(
        _combat, ["day", "acc_id", "char_id", "server", "class", "level", *COMBAT_MEASURES]
    ),
    "pledge": _ordered(
        _pledge, ["day", "acc_id", "char_id", "server", "pledge_id", *PLEDGE_MEASURES]
    ),
    "trade": _ordered(
        _trade,
        ["day", "time", "type", "server", "source_acc_id", "source_char_id",
         "target_acc_id", "target_char_id", "item_type", "item_amount", "item_price"],
    ),
    "payment": _ordered(_struct("day", "acc_id", "", ["amount_spent"]),
                        ["day", "acc_id", "amount_spent"]),
    "label": _ordered(_struct("survival_time", "acc_id", "", ["amount_spent"]),
                      ["acc_id", "survival_time", "amount_spent"]),
}
RAW_TABLES = ["activity", "combat", "pledge", "trade", "payment"]
