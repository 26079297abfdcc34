"""Mergeable distinct counts by day."""

from pyspark.sql import functions as F

from churnpanel.operators import distinct, profile

SCHEMA = "acc_id long, day int, char_id long"


def test_days_are_added_and_replaced(spark, tmp_path):
    path = str(tmp_path / "sketches")
    old = spark.createDataFrame([(1, 1, 10), (1, 1, 11), (1, 2, 10), (2, 1, None), (3, 2, 5)], SCHEMA)
    distinct.write_days(distinct.daily_sketches(old), path)
    count = lambda: {r.acc_id: r.char_count for r in distinct.merged_counts(distinct.read_days(spark, path)).collect()}
    assert count() == {1: 2, 2: 0, 3: 1}
    # a new day reads its own rows; days before it stay
    new = spark.createDataFrame([(1, 3, 12), (1, 3, 11), (4, 3, 7)], SCHEMA)
    distinct.write_days(distinct.daily_sketches(new), path)
    assert count() == {1: 3, 2: 0, 3: 1, 4: 1}
    distinct.write_days(distinct.daily_sketches(new.where("acc_id = 4")), path)
    assert count() == {1: 2, 2: 0, 3: 1, 4: 1}
    assert distinct.merged_counts(distinct.daily_sketches(old.limit(0))).count() == 0


def test_error_bound(spark):
    """One hot account with 60,000 characters in three tables, and many exact small ones."""
    hot = spark.range(60_000).select(F.lit(1).cast("long").alias("acc_id"), (F.col("id") % 5).cast("int").alias("day"), F.col("id").alias("char_id"))
    small = spark.range(20_000).select((F.col("id") % 50 + 2).alias("acc_id"), (F.col("id") % 7).cast("int").alias("day"), (F.col("id") % 1300).alias("char_id"))
    tables = [hot, small, hot.union(small)]
    got = {r.acc_id: r.char_count for r in distinct.merged_counts(distinct.daily_sketches(*tables)).collect()}
    want = {r.acc_id: r.char_count for r in profile.char_count(*tables).collect()}
    assert abs(got.pop(1) - want[1]) < 4 * want.pop(1) / 2 ** (distinct.SIZE / 2)
    assert got == want
