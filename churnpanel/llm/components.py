"""Connected components of a link table, wholly in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnpanel.functions.scale import materialize


def _fingerprint(links: DataFrame) -> tuple:
    """Number of links and two sums of their hashes; sets of links that differ get the same
    with a chance of about 2**-100."""
    got = links.agg(F.count(F.lit(1)), *[F.sum(F.xxhash64("a", "b", F.lit(i)).cast("decimal(20,0)")) for i in range(2)])
    return tuple(got.first())


def connected_components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """id, component (least id reachable) for every row of ``nodes`` (distinct ``id``).

    Alternating large-star and small-star steps: every step only regroups links by one
    end, and their number never grows.  A node with very many links is handled by sums
    (the least neighbour) and a join, never by collecting its neighbours.  Each step is
    written out, so lineage stays short."""
    links = materialize(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = _fingerprint(links)
    while seen[0]:
        # large star: neighbours above a node move to the least node around it
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "links")
        # small star: a node and its smaller neighbours move to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("l"))
        links = materialize(small.select("l.*").where("a <> b").distinct(), "links")
        before, seen = seen, _fingerprint(links)
        if seen == before:
            break
    found = links.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    return nodes.join(found, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
