"""The (account, day) panel: join, calendar, imputation, account summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnpanel.functions.exprs import sum0, week_of
from churnpanel.schema import (
    DAYS, KEYS, MEAN_FILL, PANEL_RENAME, PAYMENT_STATS, SQUEEZE_MEAN,
)

FLAGS = ["combat_logged_in", "pledge_logged_in", "trade_logged_in",
         "activity_logged_in", "payment_logged_in"]


def base_accounts(combat: DataFrame) -> DataFrame:
    return combat.select("acc_id").distinct()


def _by_account(parts: list[DataFrame]) -> DataFrame:
    """One row per (acc_id, day) with a struct column ``_k`` for the columns of part k (NULL
    where it has no row).

    The rows of all parts, packed, are dealt by account once.  Everything that follows on an
    account (this grouping, windows, summaries) finds its rows in place: no join of the parts,
    no second exchange.  An account has one calendar of rows at most in each part."""
    packed = [part.select(*KEYS, F.struct(F.lit(True).alias("_there"), *feature_columns(part)).alias(f"_{k}"))
              for k, part in enumerate(parts)]
    rows = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), packed)
    # a key has one row in each part, so there is one value to take
    return rows.repartition("acc_id").groupBy(*KEYS).agg(
        *[F.first(f"_{k}", ignorenulls=True).alias(f"_{k}") for k in range(len(parts))])


def panel_join(
    combat: DataFrame, pledge: DataFrame, trade: DataFrame, activity: DataFrame,
    payment: DataFrame, spine: str = "combat", stats_scope: str = "payment_days",
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Join the five daily tables on (acc_id, day).

    ``spine="combat"`` keeps combat days only; ``"union"`` keeps every active
    day.  All inputs have one row per key; equal keys meet, null ones too.
    ``stats_scope="all_days"`` repeats an account's payment statistics on all of its days,
    not on payment days alone.  With a ``calendar`` (see ``account_calendar``) its keys are
    returned instead, NULL on days that are not on the spine: the same as ``panel_fill`` of
    the joined panel, without moving the panel again."""
    if spine not in ("combat", "union"):
        raise ValueError(f"unknown spine {spine!r}")
    parts = [combat, pledge, trade, activity, payment]
    rows = _by_account(parts + ([calendar] if calendar is not None else []))
    known = F.col("_0").isNotNull() if spine == "combat" else F.coalesce(*[f"_{k}._there" for k in range(5)]).isNotNull()
    if calendar is None:
        rows = rows.where(known)
    kinds = dict(combat.select(*KEYS).dtypes)
    panel = rows.select(*[F.col(c).cast(kinds[c]).alias(c) for c in KEYS], known.alias("_known"),
                        (F.lit(True) if calendar is None else F.col("_5").isNotNull()).alias("_asked"),
                        *[F.when(known, F.col(f"_{k}.{c}")).alias(c)
                          for k, part in enumerate(parts) for c in feature_columns(part)])
    if stats_scope == "all_days":
        account = Window.partitionBy("acc_id")
        panel = panel.withColumns({c: F.when(F.col("_known"), F.max(c).over(account)) for c in PAYMENT_STATS})
    return panel.where("_asked").drop("_known", "_asked")


def account_calendar(accounts: DataFrame, days: int = DAYS) -> DataFrame:
    """Every account on every day 1..days, generated in place (``explode``), not cross-joined."""
    return accounts.select("acc_id", F.explode(F.sequence(F.lit(1), F.lit(days))).alias("day"))


def panel_fill(panel: DataFrame, accounts: DataFrame | None = None, days: int = DAYS) -> DataFrame:
    """Every account on every day 1..days; days without a record are NULL.

    Pass the ``accounts`` when a cheaper source than the panel itself has them."""
    ids = accounts if accounts is not None else panel.select("acc_id").distinct()
    return account_calendar(ids, days).join(panel, KEYS, "left")


def rename_prefix(panel: DataFrame) -> DataFrame:
    return panel.withColumnsRenamed(PANEL_RENAME)


def panel_impute(panel: DataFrame, mean_cols: list[str] = MEAN_FILL) -> DataFrame:
    """Fill NULLs: the account's own mean for ``mean_cols`` (0 if it has none), 0
    elsewhere.  The window holds one calendar per account."""
    filled = []
    for c in panel.columns:
        if c in KEYS:
            filled.append(c)
        elif c in mean_cols:
            filled.append(f"coalesce({c}, avg({c}) over (partition by acc_id), 0D) as {c}")
        else:
            filled.append(f"coalesce({c}, 0) as {c}")
    return panel.selectExpr(*filled)


def presence_flags(panel: DataFrame) -> DataFrame:
    return panel.select(*KEYS, *[F.coalesce(c, F.lit(0)).alias(c) for c in FLAGS])


def feature_columns(panel: DataFrame, leave_out: tuple[str, ...] = ()) -> list[str]:
    return [c for c in panel.columns if c not in KEYS and c not in leave_out]


def account_squeeze(panel: DataFrame, mean_cols: list[str] = SQUEEZE_MEAN) -> DataFrame:
    """One row per account: means for ``mean_cols``, sums for the rest."""
    return panel.groupBy("acc_id").agg(*[
        (F.avg(c) if c in mean_cols else sum0(c)).alias(c) for c in feature_columns(panel)
    ])


def account_mean(panel: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or feature_columns(panel)
    return panel.groupBy("acc_id").agg(*[F.avg(c).alias(c) for c in cols])


def week_mean(panel: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or feature_columns(panel)
    return panel.groupBy("acc_id", week_of("day").alias("week")).agg(
        *[F.avg(c).alias(c) for c in cols]
    )


def played_flag(panel: DataFrame, playtime: str = "a_playtime") -> DataFrame:
    played = F.when(F.col(playtime) != 0, 1.0).otherwise(0.0)
    return panel.withColumn("isplayed", played)


def panel_slice(panel: DataFrame, offset: int, count: int) -> DataFrame:
    """Rows by position in key order.  Only offset + count rows reach one task."""
    return panel.orderBy(*KEYS).offset(offset).limit(count)


def daily_target(panel: DataFrame, payment_day: DataFrame, fill: str = "zero") -> DataFrame:
    """Daily spend on every panel day: 0, or the account's mean, where unknown."""
    known = panel.select(*KEYS).join(payment_day.select(*KEYS, "amount_spent"), KEYS, "left")
    value = F.col("amount_spent")
    if fill == "mean":
        value = F.coalesce(value, F.avg("amount_spent").over(Window.partitionBy("acc_id")))
    return known.select(*KEYS, F.coalesce(value, F.lit(0.0)).alias("amount_spent"))
