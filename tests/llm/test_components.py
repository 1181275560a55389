import random

import pytest

from sparkyield.llm.common import components


def roots(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("hub_rows", [0, 2_000_000])
def test_against_union_find(spark, hub_rows):
    rng = random.Random(hub_rows)
    edges = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(250)]
    edges += [(1000 + i, 1001 + i) for i in range(60)]  # a path
    edges += [(5000, 5000 + i) for i in range(1, 200)] + [(6000 + i, 5999) for i in range(50)]  # hubs
    edges += [(7, 7), (None, 8), (9, None), (2**62, -(2**62)), (1000, 1001)]
    got = components(spark.createDataFrame(edges, "a long, b long"), hub_rows).collect()
    assert len(got) == len({r["node"] for r in got})
    assert {r["node"]: r["root"] for r in got} == roots(edges)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
