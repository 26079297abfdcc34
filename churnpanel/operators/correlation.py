"""Pearson and Spearman correlation tables and feature selection."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnpanel.functions.ranks import RANGE_ROWS, value_ranks
from churnpanel.functions.scale import skew_join


def corr_pearson(df: DataFrame, columns: list[str]) -> DataFrame:
    """Correlation of every column pair over the rows where both are present, in
    one aggregation.  NULL where a column is constant."""
    pairs = list(combinations_with_replacement(columns, 2))
    wide = df.agg(*[
        F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
        for i, (a, b) in enumerate(pairs)
    ])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("left_column"), F.lit(b).alias("right_column"),
                 F.nanvl(F.col(f"c{i}"), F.lit(None).cast("double")).alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ])))


def corr_spearman(
    df: DataFrame, features: list[str], labels: list[str], range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Spearman correlation of each feature with each label, ties at their average
    rank: (feature, label, rho).

    ``df`` has one row per account, and no NULLs in the columns used.  The labels
    are ranked per account; features are collapsed to distinct values carrying the
    sum of the centred label ranks of their rows, so feature ranks never have to
    travel back to the accounts."""
    ranked = df
    label_ranks = value_ranks(df.select(*labels), labels, range_rows=range_rows)
    for i, name in enumerate(labels):
        one = label_ranks.where(F.col("feature") == name).select(
            F.col("value").alias(f"_v{i}"),
            (F.col("rank") - (F.col("total") + 1) / 2.0).alias(f"_y{i}"),
        )
        keyed = ranked.withColumn(f"_v{i}", F.col(name).cast("double") + F.lit(0.0))
        # a third of all accounts may share one label value
        ranked = skew_join(keyed, one, [f"_v{i}"], "inner", spread=["acc_id"]).drop(f"_v{i}")
    ys = [f"_y{i}" for i in range(len(labels))]
    cells = value_ranks(
        ranked.select(*features, *ys), features,
        extra={**{f"_s{y}": F.sum(y) for y in ys},
               **{f"_q{y}": F.sum(F.col(y) * F.col(y)) for y in ys}},
        range_rows=range_rows,
    )
    x = F.col("rank") - (F.col("total") + 1) / 2.0
    sums = cells.groupBy("feature").agg(
        F.sum(F.col("n") * x * x).alias("xx"),
        *[F.sum(x * F.col(f"_s{y}")).alias(f"xy{y}") for y in ys],
        *[F.sum(f"_q{y}").alias(f"yy{y}") for y in ys],
    )
    rows = [
        F.struct(
            F.lit(name).alias("label"),
            (F.col(f"xy{y}") / F.nullif(F.sqrt(F.col("xx") * F.col(f"yy{y}")), F.lit(0.0))).alias("rho"),
        ) for name, y in zip(labels, ys)
    ]
    return sums.select("feature", F.inline(F.array(*rows)))


def feature_select(corr: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Features kept per label: |rho| not below the label's threshold."""
    limit = None
    for label, t in thresholds.items():
        here = F.when(F.col("label") == label, F.lit(t))
        limit = here if limit is None else F.coalesce(limit, here)
    kept = corr.where(F.abs("rho") >= limit)
    return kept.select("label", "feature", "rho")


def top_features(corr: DataFrame, count: int) -> DataFrame:
    """The ``count`` features most correlated with each label, in descending order of
    |rho| (to nine places, ties by name).  There is one row per feature and label."""
    strength = F.round(F.abs("rho"), 9)
    place = F.row_number().over(Window.partitionBy("label").orderBy(strength.desc_nulls_last(), "feature"))
    ranked = corr.withColumn("place", place.cast("long")).where(F.col("place") <= count)
    return ranked.select("label", "place", "feature", "rho").orderBy("label", "place")


def drop_weak(panel: DataFrame, corr: DataFrame, label: str, threshold: float) -> DataFrame:
    """The panel without the columns whose correlation with ``label`` is weak.
    Column names are part of a plan, so they are read first: one per column."""
    weak = corr.where((F.col("label") == label) & (F.abs("rho") < threshold)).select("feature")
    return panel.drop(*[r["feature"] for r in weak.collect()])
