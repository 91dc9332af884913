"""Connected components against union-find: chains, hubs, circles, repeated edges."""

import random

import pytest

from florafold.operators.components import connected_components


def _plain(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            p, q = sorted((find(a), find(b)))
            up[q] = p
    return {x: find(x) for x in up}


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(1200 - i, 1199 - i) for i in range(40)]  # chains both ways
    edges += [(2500, 2000 + i) for i in range(200)] + [(3000 + i, 3500) for i in range(200)] + [(2500, 3500)] * 3  # hubs
    edges += [(5, 5), (None, 7), (8, None)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    got = connected_components(df, "a", "b").collect()
    assert {r["node"]: r["component"] for r in got} == _plain(edges) and len(got) == len({r["node"] for r in got})
    assert connected_components(df.where("false"), "a", "b").count() == 0


def test_size_of_rounds_is_that_of_their_rows(spark):
    """The planner's size of the result does not multiply from round to round."""
    edges = spark.range(400).selectExpr("id a", "id + 1 b")
    out = connected_components(edges, "a", "b")
    assert len(str(out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 12
    assert out.select("component").distinct().collect() == [(0,)]
