"""Distinct characters per account from sketches that are kept by day.

Distinct counts of days cannot be added, so an exact count rereads all days whenever one
arrives (``profile.char_count``).  A theta sketch of each (account, day) can be merged: a new
day reads its own rows only, and a count over any days reads sketches instead of raw rows.

A sketch holds at most 2**``SIZE`` hashes.  Up to that many distinct characters the count of an
account is exact; beyond, its relative standard error is 1 / sqrt(2**SIZE), 1.6 %."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnpanel.operators.profile import _union

#: Binary logarithm of the hashes a sketch holds.
SIZE = 12


def daily_sketches(*tables: DataFrame, size: int = SIZE) -> DataFrame:
    """acc_id, day, sketch of the distinct characters over several tables.

    Sketches are made in every task before the shuffle, so a hot account sends one row a
    day and task.  Null characters are not counted; an account with no others has an empty sketch."""
    rows = _union([t.select("acc_id", "day", "char_id") for t in tables])
    return rows.groupBy("acc_id", "day").agg(F.theta_sketch_agg("char_id", size).alias("sketch"))


def write_days(sketches: DataFrame, path: str) -> str:
    """Add days to a table of sketches, one folder a day.

    A day that is there already is replaced, so a day may be written again after a failure."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    return path


def read_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("acc_id long, sketch binary, day int").parquet(path)


def merged_counts(sketches: DataFrame, by: tuple[str, ...] = ("acc_id",), size: int = SIZE) -> DataFrame:
    """Distinct characters per group of ``by`` (any columns beside the sketch)."""
    return sketches.groupBy(*by).agg(
        F.theta_sketch_estimate(F.theta_union_agg("sketch", size)).alias("char_count"))
