"""Helpers that keep joins and global values safe on large, skewed data."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALTS = 16
#: A key is hot if it holds one in so many rows; items a sketch keeps track of.
SHARE, TRACKED = 64, 4096


def with_scalars(
    df: DataFrame, source: DataFrame, name: str, **aggs: str
) -> tuple[DataFrame, dict[str, str]]:
    """``df`` plus one struct column ``name`` of global aggregates of ``source``
    (given as SQL text), and the names of its fields.  Drop ``name`` when done.

    The struct is one uncorrelated scalar subquery: a single row by construction,
    computed with map-side partial aggregation, and no join at all.  It appears
    once in the plan, however often its fields are used."""
    fields = ", ".join(f"'{n}', {agg}" for n, agg in aggs.items())
    one = source.agg(F.expr(f"named_struct({fields})").alias("s")).scalar()
    return df.withColumn(name, one), {n: f"{name}.{n}" for n in aggs}


def salted_join(
    big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
    spread: list[str] | None = None, salts: int = SALTS,
) -> DataFrame:
    """Equi-join in which a hot key of ``big`` is spread over ``salts`` tasks.

    ``small`` has at most one row per key, so copying it ``salts`` times keeps it
    far below ``big``.  The salt depends on row content only, so a task that is
    run again sends every row to the same place.  ``how`` is one of inner, left
    and left_semi: with those, each row of ``big`` meets its matches once."""
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"salted_join does not support {how!r}")
    spread = spread or [c for c in big.columns if c not in on]
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def hot_keys(df: DataFrame, key: Column, share: int = SHARE) -> list[int]:
    """Values of ``key`` (a bigint) that hold at least one in ``share`` of the rows.

    One pass with a frequent-items sketch of fixed size in every task; at most ``share``
    numbers reach the driver.  Counts are estimates: they decide where rows go, not what is
    joined."""
    got = df.select(key.alias("key")).agg(
        F.expr(f"approx_top_k(key, {share}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return sorted(t["item"] for t in got.top or [] if t["item"] is not None and t["count"] * share >= got.n)


def skew_join(
    big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
    spread: list[str] | None = None, salts: int = SALTS, share: int = SHARE,
    measure: DataFrame | None = None,
) -> DataFrame:
    """``salted_join`` that copies only what must be copied: the keys that are measured to
    hold one in ``share`` rows of ``big`` are spread over ``salts`` tasks and have their row
    of ``small`` copied; all other rows of either side are joined as they are.

    ``big`` is read once more for the measurement, its key columns only; where that means work, a
    stored frame that holds all its rows can be given as ``measure``."""
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"skew_join does not support {how!r}")
    key = F.xxhash64(*on)
    hot = hot_keys((big if measure is None else measure).select(*on).where(" and ".join(f"`{c}` is not null" for c in on)), key, share)
    if not hot:
        return big.join(small, on, how)
    spread = spread or [c for c in big.columns if c not in on]
    is_hot = key.isin(*hot)
    left = big.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")).otherwise(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = small.withColumn("_salt", F.explode(copies))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def shared_dir(spark: SparkSession) -> str:
    """The folder for written stages that driver and executors share.

    It is the one the cluster names in ``spark.checkpoint.dir``; where that is unset,
    as in tests, stages go below the warehouse, which is shared too.  A folder of one
    machine is never used."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return named or _below_warehouse(spark)


def _below_warehouse(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"


#: Folder of the job scope that is open in this thread of control, if any.
_scope: ContextVar[str | None] = ContextVar("stage_scope", default=None)


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written stage, below the open job scope or the shared folder."""
    return os.path.join(_scope.get() or shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


@contextmanager
def job_scope(spark: SparkSession, name: str = "job") -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A job that owns its stages: all stages written inside are deleted when it ends, also
    when it fails.

    The job needs ``spark.checkpoint.dir``, a folder all executors share, and is refused without
    it.  Frames that read a stage cannot be used after the end (their files are gone); what is
    to outlive the job goes through the function the scope yields, ``keep(df, path)``, which
    writes it and returns a frame that reads it.  Scopes may be nested."""
    if shared_dir(spark) == _below_warehouse(spark):
        raise ValueError("a job needs spark.checkpoint.dir, a folder that all executors share")
    folder = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")

    def keep(df: DataFrame, path: str) -> DataFrame:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    before = _scope.set(folder)
    try:
        yield keep
    finally:
        _scope.reset(before)
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write an intermediate result once and read it back (lineage ends there).

    Used in front of iterative work, which would otherwise recompute its whole
    input on every pass.  Being files in shared storage, the stage outlives any
    executor."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
