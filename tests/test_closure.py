"""The transitive closure: cycles, long ways, and what it sends to the driver."""

import random

import pytest

from inkspring.operators import graph as G
from inkspring.registry import QUERIES


def plainly(edges):
    out = set(edges)
    while more := {(a, d) for a, b in out for c, d in edges if b == c} - out:
        out |= more
    return out


@pytest.mark.parametrize("seed", range(4))
def test_closure_of_any_graph(spark, seed):
    r = random.Random(seed)
    n, m = [(6, 8), (12, 14), (9, 0), (8, 30)][seed]
    edges = [(i, i + 1) for i in range(21)] + [(5, 3), (21, 0)] if seed == 3 else [(r.randrange(n), r.randrange(n)) for _ in range(m)]
    got = [tuple(x) for x in G.ancestors(spark.createDataFrame(edges, "step long, needs long")).collect()]
    assert len(got) == len(set(got)) and set(got) == plainly(edges)


def test_no_table_of_parts_goes_to_the_driver(spark, sf, monkeypatch):
    """The ids of the parts were broadcast as their file is small; at 360 times sf0.1 the driver had no room for them."""
    plans, cut = [], G._cut

    def seen(df):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return cut(df)

    monkeypatch.setattr(G, "_cut", seen)
    out = QUERIES["G7_ancestors"](spark, sf)
    plans.append(out._jdf.queryExecution().sparkPlan().toString())
    assert len(plans) > 2 and any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)
