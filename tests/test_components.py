import random

from moorage.operators.components import connected_components


def smallest(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {x: find(x) for x in list(up)}


def test_matches_union_find(spark):
    rng = random.Random(3)
    for edges in ([(i, i + 1) for i in range(60)], [(99, i) for i in range(40)], [(rng.randrange(90), rng.randrange(90)) for _ in range(60)], [(5, 5), (7, 6), (6, 7)]):
        got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
        assert got == smallest(edges)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0
