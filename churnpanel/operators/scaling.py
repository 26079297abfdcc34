"""Feature scaling and key-based splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnpanel.functions.exprs import key_hash, unit_scale
from churnpanel.functions.scale import with_scalars


def minmax_scale(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Columns scaled to [0, 1] with the range of ``fit_on`` (default: ``df``); a
    constant column gives 0.  Fit on training data, apply to any other."""
    rows, b = with_scalars(
        df, fit_on if fit_on is not None else df, "_b",
        **{f"lo_{i}": f"min({c})" for i, c in enumerate(columns)},
        **{f"hi_{i}": f"max({c})" for i, c in enumerate(columns)},
    )
    scaled = {
        c: f"{unit_scale(c, b[f'lo_{i}'], b[f'hi_{i}'])} as {c}" for i, c in enumerate(columns)
    }
    return rows.selectExpr(*[scaled.get(c, c) for c in df.columns])


def standard_minmax(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Standardise, then min-max, in one pass over the fitting data.  The default
    refits on every frame; pass ``fit_on`` to keep the training scale."""
    rows, b = with_scalars(
        df, fit_on if fit_on is not None else df, "_b",
        **{f"lo_{i}": f"min({c})" for i, c in enumerate(columns)},
        **{f"hi_{i}": f"max({c})" for i, c in enumerate(columns)},
        **{f"mean_{i}": f"avg({c})" for i, c in enumerate(columns)},
        **{f"std_{i}": f"stddev_pop({c})" for i, c in enumerate(columns)},
    )
    out = {}
    for i, c in enumerate(columns):
        def z(x, i=i):
            return f"coalesce(({x} - {b[f'mean_{i}']}) / nullif({b[f'std_{i}']}, 0D), 0D)"
        out[c] = f"{unit_scale(z(c), z(b[f'lo_{i}']), z(b[f'hi_{i}']))} as {c}"
    return rows.selectExpr(*[out.get(c, c) for c in df.columns])


def split_by_key(df: DataFrame, key: str = "acc_id", train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """Adds ``part`` (train / test) from a hash of the key: the same account is on
    the same side in every table and every run."""
    bucket = F.pmod(key_hash(key, seed), F.lit(1000))
    side = F.when(bucket < round(train_share * 1000), "train").otherwise("test")
    return df.withColumn("part", side)


def subset_by_key(df: DataFrame, share: float, key: str = "acc_id", seed: int = 7) -> DataFrame:
    """A reproducible training subset, about ``share`` of the keys."""
    return df.where(F.pmod(key_hash(key, seed), F.lit(1000)) < round(share * 1000))


def sample_accounts(df: DataFrame, count: int = 15, seed: int = 11) -> DataFrame:
    """``count`` accounts in hash order, for inspection."""
    ids = df.select("acc_id").distinct()
    ordered = ids.orderBy(key_hash("acc_id", seed), "acc_id")
    return ordered.limit(count)
