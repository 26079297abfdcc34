"""The trade graph as edge and degree tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnpanel.functions.scale import SALTS, hot_keys, materialize, salted_join, skew_join


def trade_edges(trade: DataFrame) -> DataFrame:
    return trade.select(
        F.col("source_acc_id").alias("src"), F.col("target_acc_id").alias("dst")
    ).distinct()


def trade_degree(trade: DataFrame) -> DataFrame:
    """Trades per account, counting both endpoints, with multiplicity."""
    ends = trade.select(F.explode(F.array("source_acc_id", "target_acc_id")).alias("acc_id"))
    return ends.groupBy("acc_id").agg(F.count(F.lit(1)).alias("degree"))


def trade_partners(trade: DataFrame) -> DataFrame:
    """Distinct trade partners per account in the undirected graph."""
    edges = trade_edges(trade)
    ways = F.explode(F.array(
        F.struct(F.col("src").alias("acc_id"), F.col("dst").alias("partner")),
        F.struct(F.col("dst").alias("acc_id"), F.col("src").alias("partner")),
    )).alias("w")
    # deduplicated on (account, partner), then counted: a hub is spread over its partners
    return edges.select(ways).select("w.*").groupBy("acc_id").agg(
        F.count_distinct("partner").alias("partners")
    )


def hub_edges(trade: DataFrame, min_degree: int = 3000) -> DataFrame:
    """Distinct edges out of accounts with more than ``min_degree`` trades."""
    hubs = trade_degree(trade).where(F.col("degree") > min_degree).select(
        F.col("acc_id").alias("src")
    )
    return salted_join(trade_edges(trade), hubs, ["src"], "left_semi", spread=["dst"]).select("src", "dst")


def trader_id_sets(trade: DataFrame, base: DataFrame) -> DataFrame:
    """Base accounts that ever sold or bought, with one flag for each."""
    ends = F.explode(F.array(
        F.struct(F.col("source_acc_id").alias("acc_id"), F.lit(1).alias("s"), F.lit(0).alias("b")),
        F.struct(F.col("target_acc_id").alias("acc_id"), F.lit(0).alias("s"), F.lit(1).alias("b")),
    )).alias("e")
    ids = trade.select(ends).select("e.*").groupBy("acc_id").agg(
        F.max("s").alias("is_seller"), F.max("b").alias("is_buyer")
    )
    return ids.join(base.select("acc_id").distinct(), "acc_id", "left_semi")


def degree_features(trade: DataFrame) -> DataFrame:
    """Network measures per account: trades and distinct partners."""
    return trade_degree(trade).join(trade_partners(trade), "acc_id")


def rows_of(df: DataFrame, ids: DataFrame, *order) -> DataFrame:
    """The rows of ``df`` that belong to the accounts of ``ids``, in ``order``."""
    return df.join(ids.select("acc_id").distinct(), "acc_id", "left_semi").orderBy(*order)


def undirected_edges(trade: DataFrame) -> DataFrame:
    """Each pair of accounts that traded once, a < b, without trades with oneself."""
    a, b = F.col("source_acc_id"), F.col("target_acc_id")
    return trade.where(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _spread(hot: list[int], account: str, by: Column) -> Column:
    """The task an edge goes to beside its account: one of several for a hot account."""
    if not hot:
        return F.lit(0)
    return F.when(F.xxhash64(account).isin(*hot), F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).otherwise(0)


def neighbour_lists(pairs: DataFrame) -> tuple[DataFrame, list[int]]:
    """(src, _salt, near, partners): every account's partners in the undirected graph as an array, written
    once, and the hashes of the hubs.  A hub has up to ``SALTS`` rows, each with a part of its partners."""
    ways = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("src"), F.col("b").alias("dst")),
        F.struct(F.col("b").alias("src"), F.col("a").alias("dst")))).alias("w")).select("w.*")
    hot = hot_keys(ways, F.xxhash64("src"))
    near = ways.groupBy("src", _spread(hot, "src", F.col("dst")).alias("_salt")).agg(F.collect_list("dst").alias("near"))
    near = materialize(near, "near")
    partners = near.groupBy("src").agg(F.sum(F.size("near")).alias("partners"))
    # of a size with the accounts: never through the driver
    return materialize(near.join(partners.hint("merge"), "src"), "neighbours"), hot


def _copied(df: DataFrame, account: str, hot: list[int]) -> DataFrame:
    """``df`` with ``_salt``: a row for each part of a hub, one for any other account."""
    one = F.array(F.lit(0))
    copies = F.when(F.xxhash64(account).isin(*hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(one) if hot else one
    return df.withColumn("_salt", F.explode(copies))


def page_rank(trade: DataFrame, steps: int = 10, damping: float = 0.85, write_every: int = 5,
              lists: tuple[DataFrame, list[int]] | None = None) -> DataFrame:
    """(acc_id, pagerank) in the undirected trade graph, after ``steps`` rounds; ranks sum to 1.

    In each round an account hands its rank in equal shares to its partners.  What travels is an
    account's array of partners; only the rank of a hub is copied, for the tasks its partners are
    spread over, and what an account receives is summed on the map side.  A round reads the ranks
    before it in one place, so plans grow by one join a round, and no join of ranks goes through the
    driver.  Ranks are written every few rounds.  ``lists`` are the ``neighbour_lists`` where they are at hand."""
    near, hot = neighbour_lists(undirected_edges(trade)) if lists is None else lists
    accounts = near.groupBy(F.col("src").alias("acc_id")).agg(F.count(F.lit(1)))
    count = max(1, accounts.count())
    rest = F.lit((1 - damping) / count)
    ranks = accounts.select("acc_id", F.lit(1 / count).alias("pagerank"))
    for step in range(1, steps + 1):
        given = _copied(ranks.withColumnRenamed("acc_id", "src"), "src", hot)
        sent = near.join(given.hint("merge"), ["src", "_salt"]).select(
            (F.col("pagerank") * (1 / F.col("partners"))).alias("got"), F.explode("near").alias("acc_id"))
        # everyone has a partner, so everyone is given something
        ranks = sent.groupBy("acc_id").agg((rest + damping * F.sum("got")).alias("pagerank"))
        if step % write_every == 0 and step < steps:
            ranks = materialize(ranks, "ranks")
    return ranks


def triangles(trade: DataFrame, lists: tuple[DataFrame, list[int]] | None = None) -> DataFrame:
    """(acc_id, partners, triangles): pairs of an account's partners that trade with each other.

    Edges point from the account with fewer partners to the one with more (ties by id), so
    no account has more than about sqrt(2 * edges) of them going out, hubs next to none.  Each
    edge u to x carries u's partners beyond x as one array, which is intersected with x's own
    outgoing partners: every triangle is found once, and pairs of edges never become rows."""
    near, hot = neighbour_lists(undirected_edges(trade)) if lists is None else lists
    degree = near.groupBy(F.col("src").alias("acc_id")).agg(F.max("partners").alias("partners"))
    ways = near.select(F.col("src").alias("u"), F.col("partners").alias("nu"), F.explode("near").alias("v")).withColumn(
        "_salt", _spread(hot, "v", F.col("u")))
    known = _copied(degree.select(F.col("acc_id").alias("v"), F.col("partners").alias("nv")), "v", hot)
    first = (F.col("nu") < F.col("nv")) | ((F.col("nu") == F.col("nv")) & (F.col("u") < F.col("v")))
    directed = ways.join(known.hint("merge"), ["v", "_salt"]).where(first).select(
        "u", F.struct(F.col("nv").alias("n"), "v").alias("to"))
    ahead = directed.groupBy("u").agg(F.sort_array(F.collect_list("to")).alias("to")).select("u", F.col("to.v").alias("out"))
    ahead = materialize(ahead, "directed")
    sent = ahead.select("u", "out", F.posexplode("out").alias("i", "x")).where(F.col("i") + 1 < F.size("out")).select(
        "u", "x", F.slice("out", F.col("i") + 2, F.size("out")).alias("rest"))
    # the size of ``sent`` cannot be told from the file it is made of: a size check would send it through the driver
    met = skew_join(sent, ahead.withColumnRenamed("u", "x").hint("merge"), ["x"], spread=["u"])
    closed = met.select("u", "x", F.array_intersect("rest", "out").alias("y")).where(F.size("y") > 0)
    n = F.size("y").cast("long")
    ends = F.concat(F.array(F.struct(F.col("u").alias("acc_id"), n.alias("n")), F.struct(F.col("x").alias("acc_id"), n.alias("n"))),
                    F.transform("y", lambda y: F.struct(y.alias("acc_id"), F.lit(1).cast("long").alias("n"))))
    found = closed.select(F.explode(ends).alias("e")).select("e.*").groupBy("acc_id").agg(F.sum("n").alias("triangles"))
    return degree.join(found, "acc_id", "left").select("acc_id", "partners", F.coalesce("triangles", F.lit(0)).alias("triangles"))


def network_measures(trade: DataFrame, steps: int = 10) -> DataFrame:
    """acc_id, partners, triangles, clustering (share of closed pairs of partners, 0 for
    fewer than two), pagerank of every account that traded with another."""
    lists = neighbour_lists(materialize(undirected_edges(trade), "pairs"))
    pairs = F.col("partners") * (F.col("partners") - 1) / 2
    return triangles(trade, lists).join(page_rank(trade, steps, lists=lists), "acc_id").select(
        "acc_id", "partners", "triangles",
        F.coalesce(F.col("triangles") / F.nullif(pairs, F.lit(0.0)), F.lit(0.0)).alias("clustering"), "pagerank")
