import random

from lithos.operators.components import connected_components


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_random_chain_and_star(spark):
    random.seed(3)
    edges = [(random.randrange(60), random.randrange(60)) for _ in range(35)]
    edges += [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)] + [(5, 5), (None, 3)]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == brute(edges)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0
