"""Columns of every registered query (l = integer, d/m/e = double, s = string)."""

from __future__ import annotations

from churnpanel.schema import (
    ACTIVITY_MEASURES, CLASSES, COMBAT_MEASURES, LEVEL_COLUMNS, PANEL_RENAME,
    PAYMENT_STATS, PLEDGE_MEASURES, PLEDGE_RENAME, PLEDGE_SCORES, TRADE_DAILY_COLUMNS,
)
from churnpanel.sources.adapters import ITEMS

ITEM_NAMES = [t.lower() for t in ITEMS]


_MONEY = ("item_price", "item_amount", "_amount_", "_count_", "tot_get_money", "tot_trade_amount")


def _d(*names) -> str:
    """Doubles; sums of price ratios keep fewer decimals."""
    return "; ".join(f"{'m' if any(m in n for m in _MONEY) else 'd'} {n}" for n in names)


ACTIVITY = [*ACTIVITY_MEASURES, "total_exp", "fishing_prop", "qexp_per_playtime",
            "sexp_per_playtime", "pexp_per_playtime", "activity_logged_in"]
COMBAT = [*COMBAT_MEASURES, "combat_count", "isMajorClass", "combat_logged_in", *LEVEL_COLUMNS]
PLEDGE = [*[PLEDGE_RENAME.get(c, c) for c in PLEDGE_MEASURES], *PLEDGE_SCORES,
          "pledge_num_people", "pledge_logged_in"]
PAYMENT = ["amount_spent", *PAYMENT_STATS, "payment_logged_in"]
PANEL = [*COMBAT, *PLEDGE, *TRADE_DAILY_COLUMNS, *ACTIVITY, *PAYMENT]
IMPUTED = [PANEL_RENAME.get(c, c) for c in PANEL]
ITEM_PIVOT = [f"{s}_{m}_{t}" for s in ("sell", "get") for t in ITEM_NAMES for m in ("count", "amount")]

_v1_side = [
    name
    for s in ("sell", "get")
    for name in [
        f"{s}_item_amount", f"{s}_item_price", f"total_{s}_item_price",
        *[f"{s}_{m}_{t}" for t in ITEM_NAMES for m in ("count", "amount")],
        *[f"{s}_item_type_{i}" for i in range(len(ITEMS))],
        *[f"{s}_time_bin_{b}" for b in range(24)],
        f"{s}_type_0", f"{s}_type_1",
    ]
]
V1 = [*_v1_side, *[f"tot_amount_{t}" for t in ITEM_NAMES], "tot_item_amount",
      *[f"tot_count_{t}" for t in ITEM_NAMES], *[f"tot_item_type_{i}" for i in range(len(ITEMS))],
      *[f"tot_time_bin_{b}" for b in range(24)], "trade_logged_in"]

# inputs of the nearest-neighbour queries: all but what they predict
KNN_FEATURES = [c for c in IMPUTED if c != "amount_spent"]
CORR_LABELS = ["label_amount_spent", "label_isSurvival"]
TRADE_CORR = ["type", "item_amount", "item_price", "time_bin"]

DAY = "l acc_id day; "
PANEL_SPEC = DAY + _d(*PANEL)
IMPUTED_SPEC = DAY + _d(*IMPUTED)

SPECS: dict[str, str] = {
    # sources and sinks
    "scan_profile": "s table_name; l n_rows n_columns",
    "sink_roundtrip": DAY + _d(*ACTIVITY),
    # rollups
    "activity_daily": DAY + _d(*ACTIVITY),
    "combat_daily": DAY + _d(*COMBAT),
    "major_class": "l class n cum_n is_major",
    "level_progress": "l acc_id tot_start_lv tot_end_lv changed_lv; d avg_start_lv avg_end_lv",
    "level_stats": "l acc_id maxlevel minlevel totlevel; d meanlevel",
    "combat_class_pivot": DAY + "l " + " ".join(f"class_{c}" for c in CLASSES),
    "pledge_scores": "l pledge_id pledge_num_people; " + _d(*PLEDGE_SCORES),
    "pledge_scores_accounts": "l pledge_id pledge_num_people; " + _d(*PLEDGE_SCORES),
    "pledge_daily": DAY + _d(*PLEDGE),
    "payment_stats": "l acc_id; " + _d(*PAYMENT_STATS),
    "payment_transform": DAY + _d(*PAYMENT),
    "payment_total": "l acc_id; d total_payment",
    "total_playtime": "l acc_id; d total_play_time",
    "playtime_cumulative": DAY + "d playtime cum_play_time",
    "server_rollup": "s server; " + DAY + _d(*ACTIVITY_MEASURES),
    "server_levels": "s server; l acc_id maxlevel; d meanlevel",
    "server_code_mean": DAY + "d server_code playtime",
    # trades
    "time_bins": "s time; l bin4 bin4_none bin24 n",
    "evening_flag": "s time; l evening n",
    "trade_normalize": "l day type source_acc_id target_acc_id; s item_type; d item_amount item_price",
    "trade_gross": "l day type source_acc_id target_acc_id; s item_type; m item_amount item_price total_item_price",
    "trade_ledger": DAY + "l type time_bin; s side item_type; d item_amount item_price",
    "trade_counts": "l acc_id count_sell count_get total_trade_count",
    "trade_counts_legacy": "l acc_id count_sell count_get total_trade_count",
    "trade_item_pivot": DAY + _d(*ITEM_PIVOT),
    "trade_daily": DAY + _d(*TRADE_DAILY_COLUMNS),
    "trade_daily_v1": DAY + _d(*V1),
    "trade_daily_v0": DAY + "m total_item_price; l time_bin_0 time_bin_1 time_bin_2 time_bin_3 type_0 type_1",
    "trade_type_mean": DAY + "d type time_bin; m total_item_price",
    "both_sided_days": DAY + "l n_sell n_get",
    "item_price_mean": "s item_type; d mean_price",
    "account_trade_value": "l acc_id; m money_amount all_amount all_price",
    # panel
    "panel_join": PANEL_SPEC,
    "panel_join_union": PANEL_SPEC,
    "panel_fill28": PANEL_SPEC,
    "rename_prefix": IMPUTED_SPEC,
    "panel_impute": IMPUTED_SPEC,
    "presence_flags": DAY + "l combat_logged_in pledge_logged_in trade_logged_in activity_logged_in payment_logged_in",
    "panel_slice": IMPUTED_SPEC,
    "played_flag": IMPUTED_SPEC + "; d isplayed",
    "account_squeeze": "l acc_id; " + _d(*IMPUTED),
    "account_mean": "l acc_id; " + _d(*IMPUTED),
    "week_mean": "l acc_id week; " + _d(*IMPUTED),
    "daily_target": DAY + "d amount_spent",
    "daily_target_mean": DAY + "d amount_spent",
    # sequences
    "account_sequence": IMPUTED_SPEC,
    "sliding7": "l acc_id start day; " + _d(*IMPUTED),
    "sliding7_target": "l acc_id start day; " + _d(*IMPUTED) + "; d y",
    "window_forecast": "l acc_id n_known; d last_value mean_value fed_last fed_mean",
    "window_forecast_fitted": "l acc_id n_known; d last_value mean_value",
    "ar_forecast": "l acc_id; d slope intercept mean_spend",
    # labels and scores
    "label_totals": "l acc_id survival_time; d amount_spent total_spent",
    "label_groups": "l acc_id survival_time amo_group sur_group; d amount_spent",
    "group_sizes": "l amo_group sur_group n",
    "label_onehot": "l acc_id " + " ".join(f"st_{t}" for t in range(1, 65)) + "; d amount_spent",
    "log_spend": IMPUTED_SPEC + "; d log_max_spent",
    "nonzero_spend": "l acc_id survival_time; d amount_spent",
    "route_by_group": IMPUTED_SPEC + "; l sur_group",
    "score_keycheck": "l acc_id in_pred in_actual",
    "score_profit": "d score",
    "score_per_account": "l acc_id; e cost gamma t_k profit",
    "score_by_group": "l amo_group sur_group n; d profit",
    "metric_accuracy": "l n n_predicted_labels; d accuracy",
    "metric_regression": "d mse r2",
    # profiling
    "labelled_only": "l day type source_acc_id target_acc_id; s time item_type; d item_amount item_price",
    "point_lookup": "l day acc_id char_id class level row_seq; s server",
    "char_count": "l acc_id char_count",
    "char_count_sketch": "l acc_id char_count",
    "char_rows": "l char_id n_rows",
    "char_totals": "l n_accounts n_chars",
    "server_list": "s server",
    "value_counts": "l class n",
    "label_encode": "s value; l code; s source",
    "null_profile": "s scope name; l nulls non_nulls",
    "describe_label": "s feature; l n; d mean std min max q25 q50 q75",
    "spend_concentration": "d threshold ratio down upper cratio; l count",
    "histogram": "s feature; l bin n; d lower",
    "feature_histogram": "s feature; l bin n; d lower",
    "spend_by_survival": "l survival_time n; d mean_spent",
    "records_per_spend": "d amount_spent; l n",
    "zero_share": "l n_zero n; d zero_share",
    # correlation, scaling, splits
    "corr_pearson": "s left_column right_column; d corr",
    "corr_spearman": "s feature label; d rho",
    "feature_select": "s feature label; d rho",
    "minmax_scale": "l acc_id; " + _d(*IMPUTED),
    "standard_minmax": "l acc_id; " + _d(*IMPUTED),
    "prepared_ranges": "s feature; l kept; d rho; m low high",
    "prepared_features": "l acc_id; s feature; d value",
    "prediction_table": "l acc_id; e cost gamma t_k profit",
    "split_by_key": "l acc_id; s part",
    "sample_accounts": "l acc_id",
    # graph
    "trade_edges": "l src dst",
    "trade_degree": "l acc_id degree",
    "hub_edges": "l src dst",
    "trader_labels": "l acc_id survival_time; d amount_spent",
    "subset_accounts": "l acc_id survival_time; d amount_spent",
    "top_features": "s label; l place; s feature; d rho",
    "trader_id_sets": "l acc_id is_seller is_buyer",
    "network_measures": "l acc_id partners triangles; e clustering pagerank",
    "network_label_corr": "s feature label; d rho",
    "degree_label_corr": "s feature label; d rho",
    # models
    "knn_vote": "l acc_id prediction",
    "knn_weekly": "l acc_id prediction; d mean_vote",
    "knn_embedding": "l acc_id prediction",
    "rf_survival": "l acc_id; d survival_time",
    "rf_spend": "l acc_id; d amount_spent",
    "rf_grid": "l acc_id; d sur_group",
    "svm_linear": "l acc_id; d amo_group",
    "poly_spend": "l acc_id; d amount_spent",
    "poly_svr": "l acc_id; d amount_spent",
    "gbt_survival": "l acc_id; d survival_time",
    "group_classifier": "l acc_id; d sur_group amo_group",
    "pca_codes": "l acc_id; " + _d(*[f"code_{n}" for n in range(20)]),
    "routed_predict": "l acc_id survival_time; d amount_spent",
    # documented features
    "server_rank": "s server; l n_accounts survival_rank spend_rank; d mean_survival mean_spent",
    "activity_index": DAY + "d activity_index",
    "attack_kill": DAY + "d attack_kill",
    "attack_top_server": "l acc_id; d top_server_attacks",
    "class_cohort": "l class n_accounts n_low; d mean_spent mean_spent_low mean_days_low",
    "death_rate": DAY + "d death_per_playtime",
    "boss_hits": "l acc_id; d boss_hits",
    "top_bin_cohort": "l acc_id survival_time; d money enchant amount_spent",
    "heavy_traders": "l acc_id; d playtime",
    "pledge_co_trade": DAY + "l co_trade",
    "combat_trade_day": "l traded n_days n_paid_days; d tot_spent mean_spent",
    "pledge_strength": "l pledge_id; d combat_char_cnt char_per_combat same_pledge_per_char combat_time_per_char",
    "nontemp_combat": DAY + "d non_temp_cnt",
}
