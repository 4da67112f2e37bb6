"""R1 on the published gold graph: 21 components over listings 1..55."""
from sameitem.operators.components import connected_components

# Positive gold pairs of the reference's labelled set.
GOLD_POSITIVE = [
    (1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4), (1, 55), (2, 55), (3, 55), (4, 55), (5, 6), (7, 8), (7, 9),
    (8, 9), (10, 11), (10, 12), (10, 13), (11, 12), (11, 13), (12, 13), (14, 15), (16, 17), (16, 18), (17, 18),
    (19, 20), (19, 21), (20, 21), (22, 23), (24, 25), (24, 26), (24, 27), (25, 26), (25, 27), (26, 27), (28, 29),
    (30, 31), (30, 32), (31, 32), (33, 34), (35, 36), (35, 37), (36, 37), (38, 39), (40, 41), (40, 42), (41, 42),
    (43, 44), (45, 46), (47, 48), (49, 50), (49, 51), (50, 51), (52, 53),
]


def union_find(n, edges):
    parent = list(range(n + 1))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in range(1, n + 1)}


def test_gold_graph(spark):
    edges = spark.createDataFrame(GOLD_POSITIVE, "src long, dst long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    labels = {i: got.get(i, i) for i in range(1, 56)}
    assert len(set(labels.values())) == 21
    assert labels == union_find(55, GOLD_POSITIVE)


def test_long_chain(spark):
    chain = [(i, i + 1) for i in range(1, 300)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "src long, dst long")).collect()}
    assert set(got.values()) == {1} and len(got) == 300


def components_of(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_random_graphs_against_union_find(spark):
    import random
    rng = random.Random(3)
    graphs = [[(rng.randrange(60), rng.randrange(60)) for _ in range(n)] for n in (10, 40, 90)]
    graphs.append([(i, i + 1) for i in range(100, 160)][::-1])           # a path
    graphs.append([(500, i) for i in range(501, 700)] + [(700, 650)])    # a hub with most of the edges
    for edges in graphs:
        proper = [(a, b) for a, b in edges if a != b]
        out = connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()
        assert {r.node: r.component for r in out} == components_of(proper)
