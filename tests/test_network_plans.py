"""Plans of the network measures: no join through the driver, no doubling from round to round."""

from itertools import combinations

from churnpanel.operators import graph

TRADE = "source_acc_id long, target_acc_id long"


def trades(spark):
    return spark.createDataFrame([*combinations(range(30), 2), *((500, i) for i in range(400, 460))], TRADE)


def test_edges_with_arrays_are_never_broadcast(spark):
    """Their size is judged by the file they are made of, a small part of it: they filled the driver's memory."""
    found = graph.triangles(trades(spark))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    above = plan[:plan.index("posexplode")].splitlines()
    assert "SortMergeJoin" in next(x for x in reversed(above) if "Join" in x)
    assert {r.triangles for r in found.collect() if r.acc_id < 30} == {29 * 28 // 2}


def test_a_round_reads_the_ranks_before_it_once(spark):
    lists = graph.neighbour_lists(graph.undirected_edges(trades(spark)))
    reads = [graph.page_rank(None, steps, write_every=99, lists=lists)._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
             for steps in (1, 4, 8)]
    assert reads == [2, 5, 9]  # before: over 2 ** steps


def test_ranks_and_edges_never_pass_the_driver(spark):
    lists = graph.neighbour_lists(graph.undirected_edges(trades(spark)))
    ranks = graph.page_rank(None, 3, lists=lists)
    assert "Broadcast" not in ranks._jdf.queryExecution().sparkPlan().toString()
    assert {r.acc_id for r in ranks.collect()} == {*range(30), 500, *range(400, 460)}
