"""Mixing sources to target weights by hierarchical budgeting.

Leaves are the paths of a tree of columns (domain, language, source).  A budget of
tokens flows from the root down: at every node it is shared among the children by
weight, no child getting more than its leaves can give (their tokens times the
greatest number of epochs).  What a child cannot use goes to its siblings first;
only what a whole subtree cannot use reaches the siblings of its parent.

Each leaf then takes its budget as a token-prefix of seeded epochs: every epoch is
the leaf's documents in an order drawn from (seed, epoch, document); whole epochs
come first and the last one is cut where its tokens would exceed the budget.

Prefix sums need no sort of a whole leaf: documents are summed by (leaf, bucket of
their place), the one bucket that holds the cut is found from those sums, and only
its rows are summed one by one.  Any leaf may therefore hold most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnpanel.functions.scale import materialize

#: A child without a stated weight.
DEFAULT_WEIGHT = 1


def word_count(text: Column | str) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text (null: 0)."""
    text = F.col(text) if isinstance(text, str) else text
    parts = F.split(text, r"[\x20\x09-\x0D]+")
    # only the first and the last part can be empty
    edge = lambda i: F.when(F.element_at(parts, i) == "", 1).otherwise(0)
    n = F.size(parts) - edge(1) - F.when(F.size(parts) > 1, edge(-1)).otherwise(0)
    return F.when(F.coalesce(text, F.lit("")) == "", 0).otherwise(n).cast("long")


def _weight(path: list[str], weights: dict[tuple[str, ...], int]) -> Column:
    """Weight of a node by its path; paths are compared with nulls as ''."""
    level = {k: w for k, w in weights.items() if len(k) == len(path)}
    if not level:
        return F.lit(DEFAULT_WEIGHT).cast("long")
    out = F
    for key, w in level.items():
        hit = F.lit(True)
        for c, v in zip(path, key):
            hit = hit & (F.coalesce(F.col(c).cast("string"), F.lit("")) == v)
        out = out.when(hit, F.lit(w))
    return out.otherwise(F.lit(DEFAULT_WEIGHT)).cast("long")


def share(nodes: DataFrame, parent: list[str], name: str, budget: Column) -> DataFrame:
    """Column ``budget`` of each child (``capacity``, ``weight``): water-filling.

    Children are taken by capacity per weight; the level each could be filled to is
    what those before it leave, divided by the weight not yet served."""
    order = [(F.col("capacity") / F.col("weight")).asc(), F.col(name).asc_nulls_first()]
    before = Window.partitionBy(*parent).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent)
    left = budget - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    full = (left / weight) >= (F.col("capacity") / F.col("weight"))
    marked = nodes.withColumns({"_left": left, "_weight": weight, "_full": full.cast("int")})
    # the first child that is not filled sets the level for all that follow
    upto = Window.partitionBy(*parent).orderBy(*order)
    marked = marked.withColumn("_open", F.min("_full").over(upto) == 0)
    level = F.first(F.when(F.col("_open"), F.struct("_left", "_weight")), ignorenulls=True).over(upto)
    marked = marked.withColumn("_level", level)
    filled = F.floor(F.col("weight") * F.col("_level._left") / F.col("_level._weight"))
    return marked.withColumn(
        "budget", F.when(F.col("_open"), F.least(filled, "capacity")).otherwise(F.col("capacity")).cast("long")
    ).drop("_left", "_weight", "_full", "_open", "_level")


def leaf_budgets(
    docs: DataFrame, levels: list[str], tokens: str, total: Column | int,
    weights: dict[tuple[str, ...], int] | None = None, epochs: int = 1,
) -> DataFrame:
    """One row per leaf: levels, n_docs, tokens, capacity, budget.

    ``total`` is a number of tokens, or an expression over ``all_tokens`` (of the
    corpus).  Only sums per leaf travel; rows are combined before the shuffle."""
    weights = weights or {}
    leaves = docs.groupBy(*levels).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(tokens).alias("tokens"))
    leaves = leaves.withColumn("capacity", F.col("tokens") * F.lit(epochs))
    total = total if isinstance(total, Column) else F.lit(total)
    # a node is (path, capacity); the root's budget is the total it can use
    given = None
    for depth in range(1, len(levels) + 1):
        path, parent = levels[:depth], levels[: depth - 1]
        nodes = leaves if depth == len(levels) else leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", _weight(path, weights))
        if given is None:
            # children of the root: as few rows as there are first-level names
            all_tokens = (F.sum("capacity").over(Window.partitionBy()) / F.lit(epochs)).cast("long")
            nodes = nodes.withColumn("all_tokens", all_tokens).withColumn("_given", total.cast("long"))
            nodes = nodes.drop("all_tokens")
        else:
            on = [F.col(f"n.{c}").eqNullSafe(F.col(f"g.{c}")) for c in parent]
            nodes = nodes.alias("n").join(
                given.select(*parent, F.col("budget").alias("_given")).alias("g"), on
            ).select("n.*", "g._given")
        given = share(nodes, parent, path[-1], F.col("_given")).drop("_given")
    return given.drop("weight")


def place(seed: int, epoch: Column, key: Column) -> Column:
    """Place of a document in an epoch: 32 hexadecimal digits."""
    text = F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(key.cast("string"), F.lit("")))
    return F.md5(text.cast("binary"))


def mix_sources(
    docs: DataFrame, levels: list[str], tokens: str, total: Column | int,
    weights: dict[tuple[str, ...], int] | None = None, epochs: int = 1, seed: int = 0, key: str = "doc_id",
) -> DataFrame:
    """The selected rows of ``docs`` with their ``epoch`` (1, 2, ...).

    A row is returned once per epoch it is selected in.  Null level values form a node
    of their own; a null token count counts as 0; rows with the same key and leaf share a
    place, so the prefix takes or leaves them together; an empty table gives an
    empty result.  Columns of ``docs`` may have any names; one called epoch is replaced."""
    docs = docs.withColumn(tokens, F.coalesce(F.col(f"`{tokens}`"), F.lit(0)).cast("long"))
    names = [c for c in docs.columns if c != "epoch"]
    # rows travel packed, so that no name of theirs meets one of these
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(f"`{key}`").alias("_key"),
                         F.col(f"`{tokens}`").alias("_tokens"), *[F.col(f"`{c}`").alias(f"l{k}") for k, c in enumerate(levels)])
    # token counts are taken once; texts stay where they are until the last join
    bare = set(names) <= {*levels, key, tokens}
    columns = [*(["_row"] if bare else []), "_key", "_tokens", *[f"l{k}" for k in range(len(levels))]]
    small = materialize(packed.select(*columns), "mixing")
    docs = small if bare else packed
    levels, tokens, key = [f"l{k}" for k in range(len(levels))], "_tokens", "_key"
    leaves = leaf_budgets(small, levels, tokens, total, weights, epochs)
    plan = leaves.select(
        *[F.col(c).alias(f"_{c}") for c in levels],
        F.when(F.col("tokens") > 0, F.least(F.floor(F.col("budget") / F.col("tokens")), F.lit(epochs)))
        .otherwise(1).cast("int").alias("_full"),
        F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(0).alias("_rest"),
    ).withColumn("_rest", F.when(F.col("_full") >= epochs, F.lit(0)).otherwise(F.col("_rest")))

    last = F.col("_full") + 1
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in levels]
    slim = small.join(plan, on).where(F.col("_rest") > 0)
    slim = slim.withColumn("_place", place(seed, last, F.col(key)))
    slim = slim.withColumn("_bucket", F.substring("_place", 1, 3))

    # the bucket with the cut: sums per (leaf, bucket), then a prefix over 4096 buckets
    leaf = [f"_{c}" for c in levels]
    sums = slim.groupBy(*leaf, "_bucket").agg(F.sum(tokens).alias("_sum"), F.first("_rest").alias("_rest"))
    upto = Window.partitionBy(*leaf).orderBy("_bucket")
    sums = sums.withColumn("_after", F.sum("_sum").over(upto))
    cut = sums.where(F.col("_after") > F.col("_rest")).groupBy(*leaf).agg(
        F.min(F.struct("_bucket", F.col("_after") - F.col("_sum"))).alias("_at"))
    cut = cut.select(*[F.col(c).alias(f"{c}_") for c in leaf],
                     F.col("_at._bucket").alias("_cut"), F.col("_at.col2").alias("_base"))
    same = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in leaf]

    # rows of that bucket, one by one: the place where the budget is exceeded
    inside = slim.join(cut, [*same, F.col("_bucket") == F.col("_cut")])
    # rows of one place count together (range frame)
    run = Window.partitionBy(*leaf).orderBy("_place")
    inside = inside.withColumn("_after", F.col("_base") + F.sum(tokens).over(run))
    stop = inside.where(F.col("_after") > F.col("_rest")).groupBy(*leaf).agg(F.min("_place").alias("_stop"))

    final = plan.alias("p").join(
        stop.select(*[F.col(c).alias(f"{c}_") for c in leaf], "_stop"), same, "left"
    ).drop(*[f"{c}_" for c in leaf])
    out = docs.join(final, on)
    partial = (F.col("_rest") > 0) & (F.col("_stop").isNull() | (place(seed, last, F.col(key)) < F.col("_stop")))
    copies = F.col("_full") + F.when(partial, 1).otherwise(0)
    out = out.where(copies > 0).withColumn("epoch", F.explode(F.sequence(F.lit(1), copies)))
    return out.select("_row.*", "epoch")
