import random

from sunweave.operators.components import connected_components


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {x: find(x) for x in root}


def test_random_graphs(spark):
    rng = random.Random(5)
    for n, m in ((40, 25), (200, 260)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(None, 3), (7, 7)]
        for last in (0, 10, 10_000):  # contraction alone, both, and the last step alone
            got = connected_components(spark.createDataFrame(edges, "src long, dst long"), last_links=last).collect()
            assert {r.node: r.root for r in got} == brute(edges)
            assert len(got) == len(brute(edges))


def test_other_types(spark):
    names = [("b", "a"), ("c", "b"), ("z", "\uffff"), ("\U00010000", "z"), ("k", "k")]
    for last in (0, 10):
        got = connected_components(spark.createDataFrame(names, "src string, dst string"), last_links=last).collect()
        assert {r.node: r.root for r in got} == brute(names)
        digests = [(a.encode(), b.encode()) for a, b in names]
        got = connected_components(spark.createDataFrame(digests, "src binary, dst binary"), last_links=last).collect()
        assert {bytes(r.node): bytes(r.root) for r in got} == brute(digests)


def test_long_path_and_empty(spark):
    path = [(i, i + 1) for i in range(60)]
    empty = spark.createDataFrame([], "src long, dst long")
    for last in (0, 10_000):
        got = connected_components(spark.createDataFrame(path, "src long, dst long"), last_links=last).collect()
        assert {r.root for r in got} == {0} and len(got) == 61
        assert connected_components(empty, last_links=last).collect() == []
