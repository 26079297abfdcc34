"""Profiling: counts, nulls, histograms, concentration, vocabularies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnpanel.functions.exprs import count_if, fixed_bin, sum_if
from churnpanel.functions.ranks import exact_quantiles
from churnpanel.functions.scale import materialize, skew_join, with_scalars


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _rows(structs: list[Column]) -> Column:
    return F.inline(F.array(*structs))


def labelled_only(trade: DataFrame, label: DataFrame) -> DataFrame:
    """Trades whose two sides both have a label.  Either side may be a hot account:
    only accounts measured to be hot are spread, with their label.

    The trades are stored once, as both sides are measured before the rows are joined."""
    known = label.select("acc_id")
    kept = stored = materialize(trade, "trades")
    for side in ("source_acc_id", "target_acc_id"):
        kept = skew_join(kept, known.withColumnRenamed("acc_id", side), [side], "left_semi", measure=stored)
    return kept


def label_restricted(df: DataFrame, label: DataFrame) -> DataFrame:
    """Rows of labelled accounts, for the one-sided tables."""
    return skew_join(df, label.select("acc_id"), ["acc_id"], "left_semi")


def point_lookup(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == value)


def _characters(tables: list[DataFrame]) -> DataFrame:
    return _union([t.select("acc_id", "char_id") for t in tables])


def char_count(*tables: DataFrame) -> DataFrame:
    """Distinct characters per account over several tables."""
    return _characters(list(tables)).groupBy("acc_id").agg(
        F.count_distinct("char_id").alias("char_count")
    )


def char_rows(*tables: DataFrame) -> DataFrame:
    """Rows per character (not distinct)."""
    return _characters(list(tables)).groupBy("char_id").agg(F.count("acc_id").alias("n_rows"))


def char_totals(*tables: DataFrame) -> DataFrame:
    """Distinct accounts and characters in all.  Pairs are deduplicated first and
    both counts then run over deduplicated ids, spread over the whole cluster."""
    chars = _characters(list(tables))
    ids = _union([
        chars.select(F.lit("acc").alias("kind"), F.col("acc_id").alias("id")),
        chars.select(F.lit("char").alias("kind"), F.col("char_id").alias("id")),
    ]).distinct()
    return ids.agg(
        count_if("kind = 'acc'").alias("n_accounts"),
        count_if("kind = 'char'").alias("n_chars"),
    )


def server_list(*tables: DataFrame) -> DataFrame:
    return _union([t.select("server") for t in tables]).distinct()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column)


def alphabet_codes(df: DataFrame, column: str):
    """A function from a column to its 0-based alphabetical code.

    For closed vocabularies only (item types, servers): the distinct values form
    one sorted array."""
    values = df.select(column).distinct().agg(F.array_sort(F.collect_list(column))).scalar()
    return lambda c: F.array_position(values, c) - 1


def label_encode(df: DataFrame, column: str) -> DataFrame:
    codes = alphabet_codes(df, column)
    return df.select(column).distinct().select(column, codes(F.col(column)).alias("code"))


def null_profile(trade: DataFrame) -> DataFrame:
    """NULLs and values per column, and per item type for the price, in one scan."""
    cols = [c for c in trade.columns if c != "item_type"]
    per_item = trade.groupBy("item_type").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[count_if(f"`{c}` is null").alias(c) for c in cols],
    )
    columns = per_item.agg(
        F.sum("_rows").alias("_rows"),
        sum_if("item_type is null", "_rows").cast("bigint").alias("item_type"),
        *[F.sum(c).alias(c) for c in cols],
    ).select(_rows([
        F.struct(F.lit("column").alias("scope"), F.lit(c).alias("name"),
                 F.col(c).alias("nulls"), (F.col("_rows") - F.col(c)).alias("non_nulls"))
        for c in [*cols, "item_type"]
    ]))
    items = per_item.select(
        F.lit("item_price by item_type").alias("scope"), F.col("item_type").alias("name"),
        F.col("item_price").alias("nulls"), (F.col("_rows") - F.col("item_price")).alias("non_nulls"),
    )
    return columns.unionByName(items)


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample deviation, extremes and exact quartiles per column."""
    simple = df.agg(*[
        F.struct(
            F.lit(c).alias("feature"), F.count(c).alias("n"), F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        ).alias(c) for c in columns
    ]).select(_rows([F.col(c) for c in columns]))
    quartiles = exact_quantiles(df.select(*columns), columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    # one row per column on both sides
    return simple.join(F.broadcast(quartiles), "feature", "left")


def spend_concentration(label: DataFrame, thresholds=tuple(range(1, 20))) -> DataFrame:
    """Revenue above and below every threshold.  One pass: the thresholds become
    columns of one aggregate, then rows."""
    x = "amount_spent"
    wide = label.agg(
        F.sum(x).alias("total"), F.count(x).alias("n"),
        *[sum_if(f"{x} > {t}D", x).alias(f"up_{i}") for i, t in enumerate(thresholds)],
        *[sum_if(f"{x} < {t}D", x).alias(f"down_{i}") for i, t in enumerate(thresholds)],
        *[count_if(f"{x} > {t}D").alias(f"count_{i}") for i, t in enumerate(thresholds)],
    )
    return wide.select(_rows([
        F.struct(
            F.lit(t).cast("double").alias("threshold"),
            (F.col(f"up_{i}") / F.nullif(F.col("total"), F.lit(0.0))).alias("ratio"),
            F.col(f"down_{i}").alias("down"), F.col(f"up_{i}").alias("upper"),
            F.col(f"count_{i}").alias("count"),
            (F.col(f"count_{i}") / F.nullif(F.col("n"), F.lit(0))).alias("cratio"),
        ) for i, t in enumerate(thresholds)
    ]))


def histogram(df: DataFrame, columns: list[str], bins: int = 40) -> DataFrame:
    """Equal-width bin counts for each column: (feature, bin, lower, n)."""
    cols = [f"cast({c} as double)" for c in columns]
    df, b = with_scalars(
        df, df, "_bounds", **{f"lo_{i}": f"min({x})" for i, x in enumerate(cols)},
        **{f"hi_{i}": f"max({x})" for i, x in enumerate(cols)},
    )
    cells = ", ".join(
        f"struct('{c}' as feature, {x} as value, {b[f'lo_{i}']} as lo, {b[f'hi_{i}']} as hi, "
        f"{fixed_bin(x, b[f'lo_{i}'], b[f'hi_{i}'], bins)} as bin)"
        for i, (c, x) in enumerate(zip(columns, cols))
    )
    rows = df.selectExpr(f"inline(array({cells}))").where(F.col("value").isNotNull())
    return rows.groupBy("feature", "bin").agg(
        F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.count(F.lit(1)).alias("n")
    ).select(
        "feature", "bin",
        (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / F.lit(float(bins))).alias("lower"),
        "n",
    )


def spend_by_survival(label: DataFrame) -> DataFrame:
    return label.groupBy("survival_time").agg(
        F.avg("amount_spent").alias("mean_spent"), F.count(F.lit(1)).alias("n")
    )


def zero_share(df: DataFrame, column: str = "amount_spent") -> DataFrame:
    zero = count_if(f"{column} = 0")
    n = F.count(F.lit(1))
    return df.agg(zero.alias("n_zero"), n.alias("n"), (zero / F.nullif(n, F.lit(0))).alias("zero_share"))
