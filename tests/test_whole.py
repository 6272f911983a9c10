"""Queries read all rows of their tables: small tables against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from sunweave.operators import graph
from sunweave.plans.registry import QUERIES
from sunweave.sources.files import make_ephemeris


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """(folder, pairs of lineitem): parts 1 to 60 with a few of suppliers 1 to 25, some of them in one order only."""
    rng, folder = random.Random(5), str(tmp_path_factory.mktemp("tables"))
    pairs = sorted({(rng.randint(1, 25), p) for p in range(1, 61) for _ in range(rng.choice([1, 1, 2, 3]))} | {(130, 240), (130, 40)})
    lines = [(i + 1, s, p, 1) for i, (s, p) in enumerate(pairs)] + [(1, 3, 3, 2)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_partkey long, l_linenumber int").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(i,) for i in range(1, 121)], "c_custkey long").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(i, i % 50 + 1) for i in range(1, 41)], "p_partkey long, p_size int").write.parquet(f"{folder}/part.parquet")
    return folder, [*pairs, (3, 3)]


def around(pairs):
    out = {}
    for a, b in pairs:
        if a != b:
            out.setdefault(a, set()).add(b)
            out.setdefault(b, set()).add(a)
    return out


def first_path(near, path, hops):
    if len(path) > hops:
        return path
    for n in sorted(near.get(path[-1], ())):
        if n not in path and (found := first_path(near, [*path, n], hops)):
            return found
    return None


@pytest.mark.parametrize("seed", range(4))
def test_simple_paths(spark, seed):
    rng = random.Random(seed)
    pairs = {tuple(sorted(rng.sample(range(14), 2))) for _ in range(14 + 3 * seed)} | {(0, k) for k in range(20, 24)}
    edges, near = spark.createDataFrame(sorted(pairs), "a long, b long"), around(pairs)
    for hops in (1, 3, 4, 5):
        got = {r.start: r.path for r in graph.simple_paths(edges, graph.degrees(edges).select("node"), hops).collect()}
        assert got == {n: p for n in near if (p := first_path(near, [n], hops))}


def test_path5_starts_everywhere(spark, tables):
    folder, pairs = tables
    near = around(pairs)
    got = {r.start: r.path for r in QUERIES["path5"](spark, folder).collect()}
    assert got == {n: p for n in near if (p := first_path(near, [n], 4))} and len(got) > 20


def test_route_plan_has_every_edge(spark, tables):
    spark.createDataFrame([(i, f"R{i}") for i in range(5)], "r_regionkey long, r_name string").write.mode("overwrite").parquet(f"{tables[0]}/region.parquet")
    got = [(r.shard_index, r.edge_count, r.edges) for r in QUERIES["route_plan"](spark, tables[0]).collect()]
    ids = {k: [str(i) for i in range(1, 121) if i % 9 % 5 == k] for k in range(5)}
    assert {k: (n, e) for k, n, e in got} == {k: (len(v), ",".join(v)) for k, v in ids.items()}
    assert [n for _, n, _ in got] == sorted((n for _, n, _ in got), reverse=True)


def test_box_shadows_has_each_step(spark, tables):
    facts = QUERIES["box_shadows"](spark, tables[0])
    assert facts.count() == 120 * 480 and {r.n for r in facts.groupBy("datetime").agg(F.count("*").alias("n")).collect()} == {120}
    up = make_ephemeris(spark, 2026, 40.7826, -73.9656, -5).where("doy = 172 AND minute % 3 = 0 AND elevation > 10").count()
    assert facts.where("is_sunlit").select("datetime").distinct().count() >= up > 200


def test_kmeans_blocks_has_twenty_rounds(spark, tables, monkeypatch):
    seen = []
    monkeypatch.setattr(graph, "kmeans_blocks", lambda points, k, rounds: seen.append((k, rounds)) or points)
    QUERIES["kmeans_blocks"](spark, tables[0])
    assert seen == [(20, 20)]
