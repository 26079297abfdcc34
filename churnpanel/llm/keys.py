"""One text per key, the common ground of operators that join results back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnpanel.functions.scale import materialize


def one_text_per_key(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text) with every key once.

    Rows with a null key are left out, null texts are empty.  Of rows that repeat a key,
    the one with the greatest text stands for it.  Only keys are shuffled to find the
    repeated ones, and only their rows are shuffled with their texts."""
    rows = docs.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    again = materialize(rows.groupBy("id").count().where("count > 1").select("id"), "repeated-keys")
    if again.isEmpty():
        return rows
    once = rows.join(again, "id", "left_anti")
    return once.unionByName(rows.join(again, "id", "left_semi").groupBy("id").agg(F.max("text").alias("text")))
