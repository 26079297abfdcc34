"""Exact ranks and quantiles of whole columns, without a one-task sort.

Equal values are first collapsed to one row with a count (so a value held by a
third of all rows costs one row).  The distinct values are then cut into ranges in two
levels, both by arithmetic that never decreases with the value: the first level is the
sign and magnitude (sixteen steps for each power of two), the second cuts a crowded first
range evenly into as many parts as its distinct values need.  Every range is ranked on
its own and shifted by the number of rows in the ranges below it.  The cuts only decide
where work happens: any cut gives the same exact ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnpanel.functions.scale import materialize

#: Distinct values that are ranked together.
RANGE_ROWS = 50_000
#: Steps of the first level for each power of two, and above all of them.
STEPS, FAR = 16, 1 << 20


def _magnitude(value: str) -> Column:
    """First range of a value: 0 for 0, rising with the value, infinities and NaN last."""
    steps = F.expr(f"cast(floor(least(log2(abs({value})), 1025D) * {STEPS}) as int) + {FAR}")
    v = F.col(value)
    return F.when(F.isnan(v), 2 * FAR).when(v == 0, 0).when(v > 0, steps).otherwise(-steps)


def value_ranks(
    df: DataFrame, columns: list[str], extra: dict[str, Column] | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """One row per (feature, value): ``n`` rows, ``below`` rows with a smaller
    value, ``rank`` the average rank of the ties, and ``total`` rows in all.

    ``extra`` adds aggregates over the rows that share the value.  Rows where
    the column is NULL are left out; -0.0 and 0.0 are one value, and NaN is above all."""
    extra = extra or {}
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), (F.col(c).cast("double") + F.lit(0.0)).alias("value")) for c in columns
    ])).alias("cell")
    others = [c for c in df.columns if c not in columns]
    long = df.select(cells, *others).select("cell.*", *others).where(F.col("value").isNotNull())
    tied = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), *[e.alias(n) for n, e in extra.items()])
    # read three times from here on; one row for each distinct value
    tied = materialize(tied.withColumn("part", _magnitude("value")), "distinct-values")
    parts = tied.groupBy("feature", "part").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(range_rows)).alias("pieces"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    piece = F.when(F.col("pieces") > 1, F.least(
        F.floor((F.col("value") / F.col("hi") - F.col("lo") / F.col("hi")) / (1 - F.col("lo") / F.col("hi")) * F.col("pieces")),
        F.col("pieces") - 1)).otherwise(0)
    # a negative range is cut from its far end
    piece = F.when((F.col("part") < 0) & (F.col("pieces") > 1), F.col("pieces") - 1 - F.least(
        F.floor((F.col("value") / F.col("lo") - F.col("hi") / F.col("lo")) / (1 - F.col("hi") / F.col("lo")) * F.col("pieces")),
        F.col("pieces") - 1)).otherwise(piece)
    placed = tied.join(parts, ["feature", "part"]).withColumn("piece", piece.cast("int")).drop("pieces", "lo", "hi")
    sizes = placed.groupBy("feature", "part", "piece").agg(F.sum("n").alias("m"))
    # one row for each range; their number grows with the distinct values over ``range_rows``
    lower = Window.partitionBy("feature").orderBy("part", "piece")
    offsets = sizes.select(
        "feature", "part", "piece",
        (F.sum("m").over(lower.rowsBetween(Window.unboundedPreceding, 0)) - F.col("m")).alias("offset"),
        F.sum("m").over(Window.partitionBy("feature")).alias("total"))
    in_range = Window.partitionBy("feature", "part", "piece").orderBy("value")
    running = placed.withColumn(
        "before", F.sum("n").over(in_range.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    return running.join(offsets, ["feature", "part", "piece"]).select(
        "feature", "value", "n",
        (F.col("offset") + F.col("before")).alias("below"),
        (F.col("offset") + F.col("before") + (F.col("n") + 1) / 2.0).alias("rank"),
        "total", *extra,
    )


def exact_quantiles(
    df: DataFrame, columns: list[str], probs: dict[str, float], range_rows: int = RANGE_ROWS
) -> DataFrame:
    """One row per feature with linearly interpolated exact quantiles."""
    ranked = value_ranks(df, columns, range_rows=range_rows)

    def at(index: Column) -> Column:
        held = (F.col("below") <= index) & (index < F.col("below") + F.col("n"))
        return F.max(F.when(held, F.col("value")))

    picks: list[Column] = []
    for name, p in probs.items():
        position = (F.col("total") - 1) * F.lit(p)
        low = F.floor(position)
        picks += [
            at(low).alias(f"_lo_{name}"),
            at(F.least(low + 1, F.col("total") - 1)).alias(f"_hi_{name}"),
            F.max(position - low).alias(f"_w_{name}"),
        ]
    out = ranked.groupBy("feature").agg(*picks)
    return out.select(
        "feature",
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")).alias(n)
            for n in probs
        ],
    )


def exact_median(df: DataFrame, column: str, range_rows: int = RANGE_ROWS) -> Column:
    """The exact global median as a scalar column."""
    return (
        exact_quantiles(df.select(column), [column], {"median": 0.5}, range_rows)
        .agg(F.max("median")).scalar()
    )

