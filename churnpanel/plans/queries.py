"""Registered queries: every operator over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnpanel.functions.exprs import evening_flag, time_bin
from churnpanel.functions.scale import materialize, stage_path
from churnpanel.operators import (
    activity, cohorts, combat, correlation, distinct, evaluate, graph, models, neighbours, panel,
    payment, pledge, preparation, profile, routing, scaling, sequence,
    support, trade,
)
from churnpanel.plans.build_panel import filled_panel, imputed_panel, joined_panel
from churnpanel.plans.contract import shape_frame
from churnpanel.plans.specs import (
    CORR_LABELS, IMPUTED, KNN_FEATURES, SPECS, TRADE_CORR,
)
from churnpanel.plans.train_predict import account_features
from churnpanel.schema import RAW_TABLES, SPEND_MIN_CORR, SURVIVAL_MIN_CORR
from churnpanel.session import prefer_compiled
from churnpanel.sources import tables
from churnpanel.sources.adapters import ITEMS, MONEY, Inputs

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
# parameters of the registered queries over the driver's tables
LOOKUP_ACCOUNT = 7
HUB_DEGREE = 620
SLICE = (100, 50)
# intercept and weights of a window model, the oldest day first
WINDOW_WEIGHTS = (0.02, (0.05, 0.05, 0.1, 0.1, 0.15, 0.2, 0.25))
# least |rho| of a prepared column; low, as the driver's labels hardly depend on the panel
PREPARED_MIN_CORR = 0.05

# columns of the sequence models: what they predict is left out
SEQUENCE = [c for c in IMPUTED if c != "amount_spent"]

BUILDERS: dict[str, Callable[[Inputs], DataFrame]] = {}


def query(fn):
    BUILDERS[fn.__name__] = fn
    return fn


def _trades(i: Inputs) -> DataFrame:
    """The trades as a written stage: the three tables they come from are joined once, although
    global values (least amount, mean or median price) are read before the rows."""
    return materialize(i.trade.drop("source_char_id", "target_char_id"), "trades")


def _raw(i: Inputs) -> dict[str, DataFrame]:
    return {name: i.table(f"fx_{name}") for name in RAW_TABLES if name != "trade"} | {"trade": _trades(i)}


def _joined(i: Inputs, **options) -> DataFrame:
    return joined_panel(_raw(i), MONEY, **options)


def _filled(i: Inputs) -> DataFrame:
    return filled_panel(_raw(i), MONEY)


def _imputed(i: Inputs) -> DataFrame:
    return imputed_panel(_raw(i), MONEY)


def _stored(i: Inputs) -> DataFrame:
    """The imputed panel as a written stage, for work that reads it more than once."""
    return materialize(_imputed(i), "panel")


def _base(i: Inputs) -> DataFrame:
    return panel.base_accounts(i.combat)


def _normal(i: Inputs) -> DataFrame:
    return trade.trade_normalize(i.trade, MONEY)


def _ledger(i: Inputs) -> DataFrame:
    return trade.trade_ledger(trade.time_bins(_normal(i)), MONEY)


def _priced_ledger(i: Inputs) -> DataFrame:
    """The ledger for queries that read amounts and prices: their least values come before the rows."""
    rows = materialize(i.trade.drop("server", "source_char_id", "target_char_id"), "trades")
    return trade.trade_ledger(trade.time_bins(trade.trade_normalize(rows, MONEY)), MONEY)


# --- sources and sinks -----------------------------------------------------

@query
def scan_profile(i):
    return tables.table_counts({t: i.table(t) for t in BASE_TABLES})


@query
def sink_roundtrip(i):
    daily = activity.activity_daily(i.activity)
    root = stage_path(i.spark, "roundtrip")
    tables.write_panel(daily, root, "train", "raw")
    return tables.read_panel(i.spark, root, "train", "raw", daily.schema)


# --- rollups ---------------------------------------------------------------

@query
def activity_daily(i):
    return activity.activity_daily(i.activity)


@query
def combat_daily(i):
    return combat.combat_daily(i.combat)


@query
def major_class(i):
    return combat.major_class(i.combat)


@query
def level_progress(i):
    return combat.level_progress(i.combat)


@query
def level_stats(i):
    return combat.level_stats(i.combat)


@query
def combat_class_pivot(i):
    return combat.combat_class_pivot(i.combat)


@query
def pledge_scores(i):
    return pledge.pledge_scores(i.pledge)


@query
def pledge_scores_accounts(i):
    return pledge.pledge_scores(i.pledge, size="accounts")


@query
def pledge_daily(i):
    return pledge.pledge_daily(i.pledge)


@query
def payment_stats(i):
    return payment.payment_stats(i.payment)


@query
def payment_transform(i):
    return payment.payment_transform(i.payment)


@query
def payment_total(i):
    return payment.payment_total(i.payment)


@query
def total_playtime(i):
    return activity.total_playtime(i.activity)


@query
def playtime_cumulative(i):
    return activity.playtime_cumulative(i.activity)


@query
def server_rollup(i):
    return activity.server_rollup(i.activity)


@query
def server_levels(i):
    return combat.server_levels(i.combat)


@query
def server_code_mean(i):
    return activity.server_code_mean(i.activity, profile.alphabet_codes(i.activity, "server"))


# --- trades ----------------------------------------------------------------

@query
def time_bins(i):
    times = i.trade.groupBy("time").agg(F.count(F.lit(1)).alias("n"))
    return times.select("time", "n", time_bin("time").alias("bin4"),
                        time_bin("time", 4, "none").alias("bin4_none"),
                        time_bin("time", 24).alias("bin24"))


@query
def evening_flag_by_time(i):
    times = i.trade.groupBy("time").agg(F.count(F.lit(1)).alias("n"))
    return times.select("time", "n", evening_flag(time_bin("time", 4, "none")).alias("evening"))


BUILDERS["evening_flag"] = BUILDERS.pop("evening_flag_by_time")


@query
def trade_normalize(i):
    return _normal(i)


@query
def trade_gross(i):
    return trade.trade_gross(i.trade, MONEY, ITEMS)


@query
def trade_ledger(i):
    return _priced_ledger(i)


@query
def trade_counts(i):
    return trade.trade_counts(_ledger(i))


@query
def trade_counts_legacy(i):
    return trade.trade_counts(_ledger(i), legacy_total=True)


@query
def trade_item_pivot(i):
    return trade.trade_item_pivot(_priced_ledger(i), ITEMS)


@query
def trade_daily(i):
    return trade.trade_daily(_trades(i), _base(i), MONEY)


@query
def trade_daily_v1(i):
    return trade.trade_daily_v1(_trades(i), _base(i), MONEY, ITEMS)


@query
def trade_daily_v0(i):
    return trade.trade_daily_v0(_trades(i), _base(i))


@query
def trade_type_mean(i):
    return trade.trade_type_mean(_trades(i))


@query
def both_sided_days(i):
    plain = trade.trade_ledger(
        i.trade, swap_money=False, carry=("type", "item_type", "item_amount", "item_price")
    )
    return trade.both_sided_days(plain)


@query
def item_price_mean(i):
    return trade.item_price_mean(trade.trade_normalize(i.trade, MONEY, drop_unpriced=False))


@query
def account_trade_value(i):
    return trade.account_trade_value(i.trade, MONEY)


# --- panel -----------------------------------------------------------------

@query
def panel_join(i):
    return _joined(i)


@query
def panel_join_union(i):
    return _joined(i, spine="union", stats_scope="all_days")


@query
def panel_fill28(i):
    return _filled(i)


@query
def rename_prefix(i):
    return panel.rename_prefix(_joined(i))


@query
def panel_impute(i):
    return _imputed(i)


@query
def presence_flags(i):
    return panel.presence_flags(_filled(i))


@query
def panel_slice(i):
    return panel.panel_slice(_imputed(i), *SLICE)


@query
def played_flag(i):
    return panel.played_flag(_imputed(i))


@query
def account_squeeze(i):
    return panel.account_squeeze(_imputed(i))


@query
def account_mean(i):
    return panel.account_mean(_imputed(i))


@query
def week_mean(i):
    return panel.week_mean(_imputed(i))


@query
def daily_target(i):
    return panel.daily_target(_filled(i), payment.payment_daily(i.payment))


@query
def daily_target_mean(i):
    return panel.daily_target(_filled(i), payment.payment_daily(i.payment), fill="mean")


# --- sequences -------------------------------------------------------------

@query
def account_sequence(i):
    steps = sequence.account_sequence(_imputed(i), IMPUTED)
    one = steps.select("acc_id", F.explode("steps").alias("s"))
    return one.select("acc_id", "s.day", *[F.col("s.x")[n].alias(c) for n, c in enumerate(IMPUTED)])


@query
def sliding7(i):
    runs = sequence.sliding(_imputed(i), IMPUTED)
    return runs.select("acc_id", "start", F.inline("window"))


@query
def sliding7_target(i):
    runs = sequence.sliding_target(_imputed(i), IMPUTED, "amount_spent")
    return runs.select("acc_id", "start", "y", F.inline("window"))


@query
def window_forecast(i):
    """Seven-day windows with given weights, rolled on from known and from predicted days."""
    series = panel.daily_target(_filled(i), payment.payment_daily(i.payment))
    model = sequence.WindowModel(*WINDOW_WEIGHTS)
    series = materialize(series, "daily-spend")
    known = sequence.window_forecast(series, model)
    fed = sequence.window_forecast(series, model, feed="predicted")
    return known.join(fed.select("acc_id", F.col("last_value").alias("fed_last"), F.col("mean_value").alias("fed_mean")), "acc_id")


@query
def window_forecast_fitted(i):
    """The same with weights fitted on the windows of all accounts."""
    series = materialize(panel.daily_target(_filled(i), payment.payment_daily(i.payment)), "daily-spend")
    return sequence.window_forecast(series, sequence.fit_window(series), feed="predicted")


@query
def ar_forecast(i):
    return sequence.ar_forecast(panel.daily_target(_filled(i), payment.payment_daily(i.payment)))


# --- labels and scores -----------------------------------------------------

@query
def label_totals(i):
    return evaluate.label_totals(i.label)


@query
def label_groups(i):
    return evaluate.label_groups(i.label)


@query
def group_sizes(i):
    return evaluate.group_sizes(i.label)


@query
def label_onehot(i):
    return evaluate.label_onehot(i.label)


@query
def log_spend(i):
    return evaluate.log_spend(_imputed(i), "max_spent")


@query
def nonzero_spend(i):
    return evaluate.nonzero_spend(i.label)


@query
def route_by_group(i):
    return evaluate.route_by_group(_imputed(i), evaluate.label_groups(i.label), "sur_group", 1)


@query
def score_keycheck(i):
    # combat accounts against labelled accounts: the two sets differ
    fighters = i.combat.groupBy("acc_id").agg(
        F.lit(1).alias("survival_time"), F.lit(0.0).alias("amount_spent")
    )
    return evaluate.score_keycheck(fighters, i.label)


@query
def score_profit(i):
    return evaluate.score_profit(i.pred, i.label)


@query
def score_per_account(i):
    return evaluate.score_per_account(i.pred, i.label)


@query
def score_by_group(i):
    return evaluate.score_by_group(i.pred, i.label)


@query
def metric_accuracy(i):
    return evaluate.metric_accuracy(i.pred, i.label)


@query
def metric_regression(i):
    return evaluate.metric_regression(i.pred, i.label)


# --- profiling -------------------------------------------------------------

@query
def labelled_only(i):
    return profile.labelled_only(i.trade, i.label)


@query
def point_lookup(i):
    return profile.point_lookup(i.combat, "acc_id", LOOKUP_ACCOUNT)


@query
def char_count(i):
    return profile.char_count(i.combat, i.pledge, i.activity)


@query
def char_count_sketch(i):
    """The same counts from stored sketches by day."""
    days = distinct.daily_sketches(i.combat, i.pledge, i.activity)
    return distinct.merged_counts(distinct.read_days(i.spark, distinct.write_days(days, stage_path(i.spark, "sketches"))))


@query
def char_rows(i):
    return profile.char_rows(i.combat, i.pledge, i.activity)


@query
def char_totals(i):
    return profile.char_totals(i.combat, i.pledge, i.activity)


@query
def server_list(i):
    return profile.server_list(i.combat, i.trade, i.activity, i.pledge)


@query
def value_counts(i):
    return profile.value_counts(i.combat, "class")


@query
def label_encode(i):
    parts = [
        profile.label_encode(df, c).select(F.col(c).alias("value"), "code", F.lit(c).alias("source"))
        for df, c in ((i.trade, "item_type"), (i.trade, "server"))
    ]
    return parts[0].unionByName(parts[1])


@query
def null_profile(i):
    return profile.null_profile(i.trade)


@query
def describe_label(i):
    return profile.describe(i.label, ["survival_time", "amount_spent"])


@query
def spend_concentration(i):
    # thresholds on the scale of the driver's amounts (below 1)
    return profile.spend_concentration(i.label, [t / 20 for t in range(1, 20)])


@query
def histogram(i):
    return profile.histogram(i.label, ["survival_time", "amount_spent"], 40)


@query
def feature_histogram(i):
    rows = _stored(i)
    cols = panel.feature_columns(rows)
    rounded = rows.select(*[F.round(F.col(c).cast("double"), 6).alias(c) for c in cols])
    return profile.histogram(rounded, cols, 20)


@query
def spend_by_survival(i):
    return profile.spend_by_survival(i.label)


@query
def records_per_spend(i):
    return profile.value_counts(i.label, "amount_spent")


@query
def zero_share(i):
    return profile.zero_share(panel.daily_target(_filled(i), payment.payment_daily(i.payment)))


# --- correlation, scaling, splits ------------------------------------------

def _account_labels(i: Inputs) -> DataFrame:
    label = i.label.select(
        "acc_id", F.col("amount_spent").alias("label_amount_spent"),
        F.when(F.col("survival_time") == 64, 1).otherwise(0).alias("label_isSurvival"),
    )
    means = panel.account_mean(_imputed(i))
    cols = panel.feature_columns(means)
    # equal means can differ in the last bit; ranks must not
    means = means.select("acc_id", *[F.round(c, 9).alias(c) for c in cols])
    return means.join(label, "acc_id")


def _spearman(i: Inputs) -> DataFrame:
    rows = materialize(_account_labels(i), "account-means")
    features = [c for c in rows.columns if c not in ("acc_id", *CORR_LABELS)]
    return correlation.corr_spearman(rows, features, CORR_LABELS)


@query
def corr_pearson(i):
    return correlation.corr_pearson(trade.time_bins(_normal(i)), TRADE_CORR)


@query
def corr_spearman(i):
    return _spearman(i)


@query
def feature_select(i):
    return correlation.feature_select(
        _spearman(i),
        {"label_amount_spent": SPEND_MIN_CORR, "label_isSurvival": SURVIVAL_MIN_CORR},
    )


def _split_squeeze(i: Inputs) -> DataFrame:
    rows = panel.account_squeeze(_imputed(i))
    return scaling.split_by_key(materialize(rows, "squeezed"))


@query
def minmax_scale(i):
    rows = _split_squeeze(i)
    return scaling.minmax_scale(rows, IMPUTED, rows.where("part = 'train'"))


@query
def standard_minmax(i):
    return scaling.standard_minmax(_split_squeeze(i).drop("part"), IMPUTED)


def _prepared(i: Inputs) -> tuple[preparation.FeaturePreparationModel, DataFrame]:
    """The preparation for spend, fitted on the training accounts, stored and read again,
    and the accounts of the other part."""
    rows = panel.account_squeeze(_imputed(i).drop("amount_spent"))
    columns = panel.feature_columns(rows)
    # equal sums can differ in the last bit; ranks and limits must not
    rows = rows.select("acc_id", *[F.round(c, 6).alias(c) for c in columns]).join(i.label, "acc_id")
    rows = materialize(scaling.split_by_key(rows), "prepared")
    ready = preparation.FeaturePreparation(inputCols=columns, labelCol="amount_spent", minimum=PREPARED_MIN_CORR,
                                           allowNone=True)
    path = stage_path(i.spark, "preparation")
    ready.fit(rows.where("part = 'train'")).write().save(path)
    return preparation.FeaturePreparationModel.load(path), rows.where("part = 'test'")


@query
def prepared_ranges(i):
    """Columns, correlations and ranges of a stored preparation, as a new session reads them."""
    return _prepared(i)[0].table(i.spark)


@query
def prepared_features(i):
    """Test accounts on the stored training scale: one row per account and kept column."""
    model, asked = _prepared(i)
    rows = model.transform(asked)
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in model.columns()])
    return rows.select("acc_id", F.inline(cells.cast("array<struct<feature:string,value:double>>")))


@query
def prediction_table(i):
    """Predictions written as a table, read back, and scored per account."""
    path = stage_path(i.spark, "predictions")
    tables.write_predictions(i.pred, path)
    return evaluate.score_per_account(tables.read_predictions(i.spark, path), i.label)


@query
def split_by_key(i):
    return scaling.split_by_key(i.label)


@query
def sample_accounts(i):
    return scaling.sample_accounts(i.combat)


# --- graph -----------------------------------------------------------------

@query
def trade_edges(i):
    return graph.trade_edges(i.trade)


@query
def trade_degree(i):
    return graph.trade_degree(i.trade)


@query
def hub_edges(i):
    return graph.hub_edges(i.trade, HUB_DEGREE)


@query
def top_features(i):
    """The ten strongest correlations of each label, strongest first."""
    return correlation.top_features(_spearman(i), 10)


@query
def subset_accounts(i):
    """A reproducible quarter of the labelled accounts."""
    return scaling.subset_by_key(i.label, 0.25)


@query
def trader_id_sets(i):
    return graph.trader_id_sets(i.trade, _base(i))


@query
def trader_labels(i):
    """Labels of the accounts that both sold and bought, greatest spend first."""
    both = graph.trader_id_sets(i.trade, _base(i)).where("is_seller = 1 and is_buyer = 1")
    return graph.rows_of(i.label, both, F.desc("amount_spent"), "acc_id")


@query
def degree_label_corr(i):
    label = i.label.select(
        "acc_id", F.col("amount_spent").alias("label_amount_spent"),
        F.when(F.col("survival_time") == 64, 1).otherwise(0).alias("label_isSurvival"),
    )
    rows = materialize(graph.degree_features(i.trade).join(label, "acc_id"), "degrees")
    return correlation.corr_spearman(rows, ["degree", "partners"], CORR_LABELS)


@query
def network_measures(i):
    return graph.network_measures(i.trade)


@query
def network_label_corr(i):
    """Rank correlation of the network measures with both labels."""
    label = i.label.select(
        "acc_id", F.col("amount_spent").alias("label_amount_spent"),
        F.when(F.col("survival_time") == 64, 1).otherwise(0).alias("label_isSurvival"),
    )
    measures = graph.network_measures(i.trade)
    # equal ranks can differ in the last bit
    rounded = measures.withColumns({c: F.round(c, 9) for c in ("clustering", "pagerank")})
    rows = materialize(rounded.join(label, "acc_id"), "network")
    return correlation.corr_spearman(rows, ["partners", "triangles", "clustering", "pagerank"], CORR_LABELS)


# --- models ----------------------------------------------------------------

def _neighbour_rows(i: Inputs) -> DataFrame:
    """Account means of scaled features, with groups and the split."""
    scaled = scaling.minmax_scale(_stored(i).select("acc_id", "day", *KNN_FEATURES), KNN_FEATURES)
    means = panel.account_mean(scaled, KNN_FEATURES)
    rounded = means.select("acc_id", *[F.round(c, 9).alias(c) for c in KNN_FEATURES])
    rows = rounded.join(evaluate.label_groups(i.label).select("acc_id", "amo_group"), "acc_id")
    return materialize(scaling.split_by_key(rows, train_share=0.75), "neighbour-rows")


@query
def knn_vote(i):
    rows = _neighbour_rows(i)
    return neighbours.knn_vote(
        rows.where("part = 'train'"), rows.where("part = 'test'"), KNN_FEATURES, "amo_group"
    )


@query
def knn_weekly(i):
    scaled = scaling.minmax_scale(_stored(i).select("acc_id", "day", *KNN_FEATURES), KNN_FEATURES)
    weeks = panel.week_mean(scaled, KNN_FEATURES)
    weeks = materialize(
        weeks.select("acc_id", "week", *[F.round(c, 9).alias(c) for c in KNN_FEATURES]), "weeks"
    )
    return neighbours.knn_weekly(weeks, evaluate.label_groups(i.label), KNN_FEATURES, "amo_group")


@query
def knn_embedding(i):
    dims = [f"e{n}" for n in range(64)]
    rows = i.embeddings.select(
        F.col("vec_id").alias("acc_id"), "label",
        *[F.col("embedding")[n].cast("double").alias(c) for n, c in enumerate(dims)],
    )
    return neighbours.knn_vote(rows, rows, dims, "label", k=5, include_self=False)


def _model_rows(i: Inputs) -> tuple[DataFrame, list[str]]:
    features, columns = account_features(_imputed(i))
    rows = scaling.split_by_key(evaluate.label_groups(features.join(i.label, "acc_id")))
    return materialize(rows, "model-rows"), columns


def _train(rows: DataFrame) -> DataFrame:
    return rows.where("part = 'train'")


@query
def rf_survival(i):
    rows, cols = _model_rows(i)
    return models.predict(models.fit_rf_survival(_train(rows), cols), rows, "survival_time")


@query
def rf_spend(i):
    rows, cols = _model_rows(i)
    return models.predict(models.fit_rf_spend(_train(rows), cols), rows, "amount_spent")


@query
def rf_grid(i):
    rows, cols = _model_rows(i)
    fitted = models.fit_rf_grid(_train(rows), cols, "sur_group")
    return models.predict(fitted, rows, "sur_group")


@query
def svm_linear(i):
    rows, cols = _model_rows(i)
    return models.predict(models.fit_svm(_train(rows), cols, "amo_group"), rows, "amo_group")


@query
def poly_spend(i):
    rows, cols = _model_rows(i)
    fitted = models.fit_poly_spend(_train(rows), cols)
    return models.predict(fitted, rows, "amount_spent")


@query
def poly_svr(i):
    """Support vector regression on the monomials of all account features."""
    rows, cols = _model_rows(i)
    return support.fit_poly_svr(_train(rows), cols).predict(rows, "amount_spent")


def _sequence_rows(i: Inputs) -> DataFrame:
    """Flattened, scaled 28-step sequences of all panel columns but the day's spend, with labels."""
    cols = SEQUENCE
    scaled = scaling.minmax_scale(_stored(i).select("acc_id", "day", *cols), cols)
    vectors = models.sequence_vector(sequence.account_sequence(scaled, cols))
    labelled = evaluate.label_groups(vectors.join(i.label, "acc_id"))
    return materialize(scaling.split_by_key(labelled), "sequence-rows")


@query
def gbt_survival(i):
    rows = _sequence_rows(i)
    fitted = models.fit_gbt(_train(rows))
    return models.predict(fitted, rows, "survival_time")


@query
def group_classifier(i):
    rows = _sequence_rows(i)
    inputs = 28 * len(SEQUENCE)
    sur = models.fit_group(_train(rows), inputs, "sur_group", 2)
    amo = models.fit_group(_train(rows), inputs, "amo_group", 3)
    return models.predict(sur, rows, "sur_group").join(
        models.predict(amo, rows, "amo_group"), "acc_id"
    )


@query
def pca_codes(i):
    rows, cols = _model_rows(i)
    return models.pca_codes(_train(rows), rows, cols, 20)


@query
def routed_predict(i):
    """Stored models, read again, on the accounts that were not trained on."""
    rows = _sequence_rows(i)
    fitted = routing.fit_routed(_train(rows), 28 * len(SEQUENCE))
    stored = routing.load_routed(routing.save_routed(fitted, stage_path(i.spark, "routed")))
    return routing.routed_predict(rows, stored)


# --- documented features ---------------------------------------------------

@query
def server_rank(i):
    return cohorts.server_rank(i.activity, i.label)


@query
def activity_index(i):
    return activity.activity_index(activity.activity_daily(i.activity))


@query
def attack_kill(i):
    return combat.attack_kill(
        combat.combat_daily(i.combat, levels=False), activity.activity_daily(i.activity)
    )


@query
def attack_top_server(i):
    return cohorts.attack_top_server(i.combat, i.activity, i.label)


@query
def class_cohort(i):
    return cohorts.class_cohort(i.combat, i.label)


@query
def death_rate(i):
    return activity.death_rate(activity.activity_daily(i.activity))


@query
def boss_hits(i):
    return activity.boss_hits(i.activity)


@query
def top_bin_cohort(i):
    return cohorts.top_bin_cohort(i.activity, i.label, bins=2)


@query
def heavy_traders(i):
    return cohorts.heavy_traders(i.activity, i.trade)


@query
def pledge_co_trade(i):
    return cohorts.pledge_co_trade(i.pledge, _ledger(i))


@query
def combat_trade_day(i):
    return cohorts.combat_trade_day(i.combat, _ledger(i), payment.payment_daily(i.payment))


@query
def pledge_strength(i):
    return pledge.pledge_strength(i.pledge)


@query
def nontemp_combat(i):
    return combat.nontemp_combat(i.combat)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(name: str):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prefer_compiled(spark)
            return shape_frame(BUILDERS[name](Inputs(spark, sf_dir)), SPECS[name])
        return run

    return {name: runner(name) for name in BUILDERS}
