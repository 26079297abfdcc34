"""Trades: normalisation, the two-sided ledger and three daily rollups.

A trade touches two accounts.  The ledger turns it into one ``sell`` row and one
``get`` row in a single pass (no union of two scans); every daily table is then
one aggregation of the ledger, with map-side partial sums, so an account that
takes part in a third of all trades costs one row per map task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnpanel.functions.exprs import count_if, evening_flag, sum0, sum_if, time_bin
from churnpanel.functions.ranks import exact_median
from churnpanel.functions.scale import with_scalars
from churnpanel.schema import ITEM_TYPES, KEYS, MONEY_ITEM, TRADE_DAILY_COLUMNS

SIDES = ("sell", "get")


def time_bins(trade: DataFrame, bins: int = 4, midnight: str = "zero") -> DataFrame:
    return trade.withColumn("time_bin", time_bin("time", bins, midnight))


def trade_normalize(
    trade: DataFrame, money: str = MONEY_ITEM, drop_unpriced: bool = True
) -> DataFrame:
    """Undo the provider's scaling (divide by the column minimum), move the amount
    of a money row into its price, and drop unpriced rows (type 1, not money)."""
    rows = trade.where((F.col("type") != 1) | (F.col("item_type") == money)) if drop_unpriced else trade
    rows, low = with_scalars(
        rows, trade, "_low", amount="min(item_amount)", price="min(item_price)"
    )
    amount = F.col("item_amount") / F.col(low["amount"])
    price = F.col("item_price") / F.col(low["price"])
    is_money = F.col("item_type") == money
    return rows.withColumns({
        "item_price": F.when(is_money, amount).otherwise(price),
        "item_amount": F.when(is_money, F.lit(1.0)).otherwise(amount),
    }).drop("_low")


def trade_gross(
    trade: DataFrame, money: str = MONEY_ITEM, items: list[str] = ITEM_TYPES
) -> DataFrame:
    """Normalised rows, missing prices filled with the item type's mean price, and
    the gross price.  The means are one row with a column per item type."""
    rows, s = with_scalars(
        trade, trade, "_s", amount="min(item_amount)", price="min(item_price)",
        **{f"m{i}": f"avg(case when item_type = '{t}' then item_price end)"
           for i, t in enumerate(items)},
    )
    own_mean = F.coalesce(
        *[F.when(F.col("item_type") == t, F.col(s[f"m{i}"])) for i, t in enumerate(items)]
    )
    # the mean of the rescaled prices is the rescaled mean, so one pass gives both
    price = F.coalesce("item_price", own_mean) / F.col(s["price"])
    amount = F.col("item_amount") / F.col(s["amount"])
    is_money = F.col("item_type") == money
    filled = rows.withColumns({
        "item_price": F.when(is_money, amount).otherwise(price),
        "item_amount": F.when(is_money, F.lit(1.0)).otherwise(amount),
    })
    gross = filled.withColumn("total_item_price", F.col("item_amount") * F.col("item_price"))
    return gross.drop("_s")


def trade_ledger(
    trade: DataFrame, money: str = MONEY_ITEM, swap_money: bool = True,
    carry: tuple[str, ...] = ("type", "item_type", "item_amount", "item_price", "time_bin"),
) -> DataFrame:
    """Two rows per trade.  Money rows change sides: who pays money gets goods."""
    swapped = (F.col("item_type") == money) if swap_money else F.lit(False)

    def entry(account: str, side: str, opposite: str) -> Column:
        return F.struct(
            F.col(account).alias("acc_id"), F.when(swapped, opposite).otherwise(side).alias("side")
        )

    both = F.array(entry("source_acc_id", "sell", "get"), entry("target_acc_id", "get", "sell"))
    return trade.select(F.explode(both).alias("e"), "day", *carry).select(
        "e.acc_id", "day", "e.side", *carry
    )


def _on(side: str) -> str:
    return f"side = '{side}'"


def trade_counts(ledger: DataFrame, legacy_total: bool = False) -> DataFrame:
    """Trades per side and in total, over all accounts.  ``legacy_total`` keeps the
    older rule by which an account active on one side only has a total of 0."""
    counts = ledger.groupBy("acc_id").agg(
        count_if(_on("sell")).alias("count_sell"), count_if(_on("get")).alias("count_get")
    )
    return counts.withColumn("total_trade_count", _total(legacy_total))


def _total(legacy_total: bool) -> Column:
    total = F.col("count_sell") + F.col("count_get")
    if legacy_total:
        one_sided = (F.col("count_sell") == 0) | (F.col("count_get") == 0)
        total = F.when(one_sided, F.lit(0).cast("bigint")).otherwise(total)
    return total


def _item_columns(side: str, items: list[str], value: str) -> list[Column]:
    out = []
    for t in items:
        here = f"{_on(side)} and item_type = '{t}'"
        out.append(sum_if(here, "item_amount").alias(f"{side}_count_{t.lower()}"))
        out.append(sum_if(here, value).alias(f"{side}_amount_{t.lower()}"))
    return out


def trade_item_pivot(ledger: DataFrame, items: list[str] = ITEM_TYPES) -> DataFrame:
    """(acc_id, day): amount and value of every item type, sold and got."""
    return ledger.groupBy(*KEYS).agg(
        *[c for side in SIDES for c in _item_columns(side, items, "item_price")]
    )


def _narrow(ledger: DataFrame, base: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """Ledger rows of the base accounts, summed by day, side and ``by``, with their number ``n``.

    Wide daily tables are built from these: a partial row of theirs is far larger than the few
    ledger rows of an account's day, which would be shuffled and spilled in that form.  However
    many trades an account has, its rows are bounded by the calendar and the combinations of
    ``by``, so dealing them by key is safe and the wide rows are made in place."""
    sums = ledger.groupBy(*KEYS, "side", *by).agg(*[F.sum(c).alias(c) for c in values], F.count(F.lit(1)).alias("n"))
    return _base_only(sums, base).repartition(*KEYS)


def _count_if(cond: str) -> Column:
    """``count_if`` over the rows that ``_narrow`` has counted."""
    return F.expr(f"coalesce(sum(case when {cond} then n end), 0L)")


def _base_only(daily: DataFrame, base: DataFrame) -> DataFrame:
    """Restrict to base accounts after aggregation: a calendar of rows per account."""
    return daily.join(base.select("acc_id").distinct(), "acc_id", "left_semi")


def trade_daily(
    trade: DataFrame, base: DataFrame, money: str = MONEY_ITEM, midnight: str = "zero",
    legacy_total: bool = False,
) -> DataFrame:
    """Current daily trade features.  The account's trade counts are summed from
    the daily rows, so the trades are read and shuffled once."""
    ledger = trade_ledger(time_bins(trade_normalize(trade, money), 4, midnight), money)
    daily = ledger.groupBy(*KEYS).agg(
        *[sum_if(_on(s), f"item_{m}").alias(f"{s}_item_{m}")
          for s in SIDES for m in ("amount", "price")],
        *[count_if(f"time_bin = {b}").alias(f"trade_time_bin_{b}") for b in range(4)],
        *[count_if(f"type = {t}").alias(f"trade_type_{t}") for t in (0, 1)],
        *[count_if(_on(s)).alias(f"_n_{s}") for s in SIDES],
    )
    account = Window.partitionBy("acc_id")
    counted = daily.select(
        "*", *[F.sum(f"_n_{s}").over(account).alias(f"count_{s}") for s in SIDES]
    )
    full = counted.withColumns({
        "tot_trade_amount": F.col("sell_item_amount") + F.col("get_item_amount"),
        "tot_get_money": F.col("sell_item_price") - F.col("get_item_price"),
        "trade_logged_in": F.lit(1),
        "total_trade_count": _total(legacy_total),
    })
    return _base_only(full, base).select(*KEYS, *TRADE_DAILY_COLUMNS)


def trade_daily_v1(
    trade: DataFrame, base: DataFrame, money: str = MONEY_ITEM, items: list[str] = ITEM_TYPES,
    sign: str = "sell_minus_get",
) -> DataFrame:
    """Earlier daily features: gross prices with imputed means, per item net values
    and counts, 24 hourly bins; no money swap and no dropped rows."""
    ledger = trade_ledger(
        time_bins(trade_gross(trade, money, items), 24), money, swap_money=False,
        carry=("type", "item_type", "item_amount", "item_price", "total_item_price", "time_bin"),
    )
    rows = _narrow(ledger, base, ["type", "item_type", "time_bin"], ["item_amount", "item_price", "total_item_price"])
    names = [t.lower() for t in items]
    aggs: list[Column] = []
    for s in SIDES:
        aggs += [sum_if(_on(s), "item_amount").alias(f"{s}_item_amount"),
                 sum_if(_on(s), "item_price").alias(f"{s}_item_price"),
                 sum_if(_on(s), "total_item_price").alias(f"total_{s}_item_price")]
        aggs += _item_columns(s, items, "total_item_price")
        aggs += [_count_if(f"{_on(s)} and item_type = '{t}'").alias(f"{s}_item_type_{i}")
                 for i, t in enumerate(items)]
        aggs += [_count_if(f"{_on(s)} and time_bin = {b}").alias(f"{s}_time_bin_{b}")
                 for b in range(24)]
        aggs += [_count_if(f"{_on(s)} and type = {v}").alias(f"{s}_type_{v}") for v in (0, 1)]
    daily = rows.groupBy(*KEYS).agg(*aggs)

    def net(name: str) -> str:
        first, second = ("sell", "get") if sign == "sell_minus_get" else ("get", "sell")
        return f"{first}_{name} - {second}_{name} as tot_{name}"

    def both(name: str) -> str:
        return f"sell_{name} + get_{name} as tot_{name}"

    return daily.selectExpr(
        "*",
        *[net(f"amount_{n}") for n in names], net("item_amount"),
        *[both(f"count_{n}") for n in names],
        *[both(f"item_type_{i}") for i in range(len(items))],
        *[both(f"time_bin_{b}") for b in range(24)],
        "1 as trade_logged_in",
    )


def _median_priced(trade: DataFrame) -> DataFrame:
    price = F.coalesce("item_price", exact_median(trade, "item_price"))
    return trade.withColumn("total_item_price", F.col("item_amount") * price)


def trade_daily_v0(trade: DataFrame, base: DataFrame) -> DataFrame:
    """First daily features: gross price with the global median filled in, four
    time bins (midnight in none), trade types; both sides added."""
    ledger = trade_ledger(
        time_bins(_median_priced(trade), 4, "none"), swap_money=False,
        carry=("type", "total_item_price", "time_bin"),
    )
    daily = ledger.groupBy(*KEYS).agg(
        sum0("total_item_price").alias("total_item_price"),
        *[count_if(f"time_bin = {b}").alias(f"time_bin_{b}") for b in range(4)],
        *[count_if(f"type = {t}").alias(f"type_{t}") for t in (0, 1)],
    )
    return _base_only(daily, base)


def trade_type_mean(trade: DataFrame) -> DataFrame:
    """Seller days: mean trade type beside the summed off-evening flag and price."""
    rows = time_bins(_median_priced(trade), 4, "none")
    return rows.groupBy(F.col("source_acc_id").alias("acc_id"), "day").agg(
        F.avg("type").alias("type"),
        sum0(evening_flag("time_bin")).alias("time_bin"),
        sum0("total_item_price").alias("total_item_price"),
    )


def both_sided_days(ledger: DataFrame) -> DataFrame:
    """Account-days with both a sale and a purchase."""
    daily = ledger.groupBy(*KEYS).agg(
        count_if(_on("sell")).alias("n_sell"), count_if(_on("get")).alias("n_get")
    )
    return daily.where("n_sell > 0 and n_get > 0")


def item_price_mean(trade: DataFrame) -> DataFrame:
    return trade.groupBy("item_type").agg(F.avg("item_price").alias("mean_price"))


def account_trade_value(trade: DataFrame, money: str = MONEY_ITEM) -> DataFrame:
    """Per seller: amount of money rows, amount of all rows, price of all rows."""
    return trade.groupBy(F.col("source_acc_id").alias("acc_id")).agg(
        sum_if(f"item_type = '{money}'", "item_amount").alias("money_amount"),
        sum0("item_amount").alias("all_amount"),
        sum0("item_price").alias("all_price"),
    )
