"""Audit of how filters interact: what each removes in every order they could run in.

The subsets of the filters form a lattice; an order is a path from the empty set to the
full one.  A document is alive in a state if it passes all filters of that subset, and an
edge (state, filter) removes the documents that are alive and fail the filter.  Two
passes over the lattice count the orders that reach a state (forward) and those that
complete it (backward); their product is the number of orders that use an edge.  So the
sum of an edge's removals over all orders, and from it a filter's Shapley value, needs
no order to be run, and the steps of any order are read off the same edges.

Documents enter as counts by set of failed filters, at most 2**k for a part, which Spark
sums with map-side partial sums; all that follows is independent of their number."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Most filters: k! orders are listed for each part.
MOST = 7
SPACE = "[\\x20\\x09-\\x0D]+"


def path_counts(k: int) -> tuple[list[int], list[int]]:
    """For every subset (as bits) the number of paths that lead to it, and from it to the
    full set."""
    forward, backward = [0] * (1 << k), [0] * (1 << k)
    forward[0] = backward[-1] = 1
    for s in range(1 << k):
        for f in range(k):
            if not s >> f & 1:
                forward[s | 1 << f] += forward[s]
    for s in reversed(range((1 << k) - 1)):
        backward[s] = sum(backward[s | 1 << f] for f in range(k) if not s >> f & 1)
    return forward, backward


def edges(spark: SparkSession, k: int) -> DataFrame:
    """state, filter, n_orders: each edge of the lattice and the orders that use it."""
    forward, backward = path_counts(k)
    rows = [(s, f, forward[s] * backward[s | 1 << f]) for s in range(1 << k) for f in range(k) if not s >> f & 1]
    return spark.createDataFrame(rows, "state int, filter int, n_orders long")


def orders(spark: SparkSession, names: str) -> DataFrame:
    """filter_order, step, state (before the step), filter: every order's path."""
    rows = []
    for order in permutations(range(len(names))):
        state = 0
        for step, f in enumerate(order, 1):
            rows.append(("".join(names[i] for i in order), step, state, f))
            state |= 1 << f
    return spark.createDataFrame(rows, "filter_order string, step int, state int, filter int")


def audit(counts: DataFrame, names: str) -> DataFrame:
    """One row per part, order and step.

    ``counts`` has part, failed (bit i: fails filter ``names[i]``), good, toxic (booleans) and
    n (documents), any number of rows each.  Parts without documents have no rows."""
    k, spark = len(names), counts.sparkSession
    if not 1 <= k <= MOST:
        raise ValueError(f"1 to {MOST} filters")
    full = (1 << k) - 1
    some = counts.groupBy("part", "failed", "good", "toxic").agg(F.sum("n").alias("n"))
    # every state appears, with the documents that are alive in it
    alive = some.withColumn("state", F.explode(F.sequence(F.lit(0), F.lit(full)))).withColumn(
        "n", F.when(F.col("failed").bitwiseAND(F.col("state")) == 0, F.col("n")).otherwise(0))

    def fails(f: int) -> Column:
        return F.col("failed").bitwiseAND(F.lit(1 << f)) != 0

    def total(rows: Column) -> Column:
        return F.coalesce(F.sum(F.when(rows, F.col("n"))), F.lit(0))

    cells = alive.groupBy("part", "state").agg(F.sum("n").alias("alive"), *[
        F.struct(F.lit(f).alias("filter"), total(fails(f)).alias("removed"), total(fails(f) & F.col("good")).alias("good_lost"),
                 total(fails(f) & F.col("toxic")).alias("toxic_lost")).alias(f"f{f}") for f in range(k)])
    cut = cells.select("part", "state", "alive", F.explode(F.array(*[f"f{f}" for f in range(k)])).alias("c")).select(
        "part", "state", "alive", "c.*")
    # the lattice has k * 2**(k-1) edges and k * k! steps, whatever the data
    used = cut.join(F.broadcast(edges(spark, k)), ["state", "filter"])
    one = Window.partitionBy("part", "filter")
    bit = F.expr("shiftleft(1, filter)")
    used = used.select(
        "part", "state", "filter", (F.col("alive") - F.col("removed")).alias("kept"), "removed",
        (F.max(F.when(F.col("state") == 0, F.col("removed"))).over(one) - F.col("removed")).alias("redundant"),
        F.max(F.when(F.col("state") == F.lit(full) - bit, F.col("removed"))).over(one).alias("unique_fails"),
        "good_lost", "toxic_lost", F.sum(F.col("removed") * F.col("n_orders")).over(one).alias("shapley"))
    return used.join(F.broadcast(orders(spark, names)), ["state", "filter"]).select(
        "part", "filter_order", "step", *[F.col(c).cast("long").alias(c) for c in (
            "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")])


#: The rules of ``document_counts``, in bit order.
RULES = "ABCDE"


def document_counts(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """part, failed, good, toxic, n of ``docs`` (doc_id, text, ``part``) under five rules.

    A: under 200 words; B: fewer distinct words than half of them; C: over 3 % of the
    characters are A-Z; D: holds any of ``#$%&*|``; E: a row with a smaller doc_id has the
    same text.  Null texts and parts are empty.  A null doc_id is smaller than none and has
    no smaller one.  Rows that repeat a doc_id count each; an id's labels are the greatest
    of its rows in ``labels`` (doc_id, quality, toxic), a missing label counts as 0.

    Texts are shuffled as 256-bit hashes.  Rows are summed by id first, then by text, so that
    neither a repeated id nor a text that a third of the rows share meets in one task."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    n_words, chars = F.size("words"), F.length("text")
    upper = chars - F.length(F.regexp_replace("text", "[A-Z]+", ""))
    rules = [n_words < 200, F.size(F.array_distinct("words")) * 100 < n_words * 50, upper * 100 > chars * 3,
             F.col("text").rlike("[#$%&*|]")]
    failed = sum((F.when(r, F.lit(1 << i)).otherwise(0) for i, r in enumerate(rules)), F.lit(0))
    once = rows.select("doc_id", "part", failed.alias("failed"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("hash"))
    once = once.groupBy("doc_id", "part", "failed", "hash").agg(F.count(F.lit(1)).alias("n"))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    once = once.join(known, "doc_id", "left").select(
        "doc_id", "part", "failed", "hash", "n", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    alike = once.groupBy("hash", "part", "failed", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.expr("min_by(n, doc_id)").alias("n_first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    # a text's rows differ by part and labels alone here
    least = F.min("first").over(Window.partitionBy("hash"))
    stay = F.when(F.col("first") == least, F.col("n_first")).otherwise(0) + F.col("n_null")
    split = alike.withColumn("stay", stay).select("part", "failed", "good", "toxic", F.explode(F.array(
        F.struct(F.lit(0).alias("again"), F.col("stay").alias("n")),
        F.struct(F.lit(1 << len(rules)).alias("again"), (F.col("n") - F.col("stay")).alias("n")))).alias("s"))
    return split.select("part", (F.col("failed") + F.col("s.again")).alias("failed"), "good", "toxic", "s.n").where("n > 0") \
        .groupBy("part", "failed", "good", "toxic").agg(F.sum("n").alias("n"))
