"""Graph repair, rasters and ray casting against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sunweave.operators import analytics, exposure, graph, topology
from sunweave.operators import spatial as joins
from sunweave.operators.greedy import first_come


def angle(a, b, c):
    """Degrees at b between the ways to a and to c."""
    u, v = [p - q for p, q in zip(a, b)], [p - q for p, q in zip(c, b)]
    n = math.hypot(*u) * math.hypot(*v)
    return math.degrees(math.acos(max(-1, min(1, sum(p * q for p, q in zip(u, v)) / n)))) if n else math.nan


@pytest.fixture(params=range(3))
def town(request, spark):
    """(edges, nodes, set of pairs, places): a random planar-ish graph."""
    rng = random.Random(request.param)
    places = {i: (rng.uniform(0, 60), rng.uniform(0, 60), rng.uniform(0, 2)) for i in range(45)}
    pairs = set()
    for i, p in places.items():
        near = sorted((math.dist(p, q), j) for j, q in places.items() if j != i)[:4]
        for _, j in rng.sample(near, rng.choice([0, 1, 1, 1, 2])):
            pairs.add((min(i, j), max(i, j)))
    edges = spark.createDataFrame(sorted(pairs), "a long, b long")
    nodes = spark.createDataFrame([(i, *p) for i, p in places.items()], "id long, x double, y double, z double")
    return edges, nodes, pairs, places


def adjacent(pairs):
    out = {}
    for a, b in sorted(pairs):
        out.setdefault(a, []).append(b)
        out.setdefault(b, []).append(a)
    return out


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_first_come(spark):
    rng = random.Random(9)
    blocks = {(a, b) for a, b in ((rng.randrange(80), rng.randrange(80)) for _ in range(150)) if a < b}
    chosen = []
    for n in range(80):
        if not any((c, n) in blocks for c in chosen):
            chosen.append(n)
    got = first_come(spark.range(80), spark.createDataFrame(sorted(blocks), "a long, b long"))
    assert sorted(r.id for r in got.collect()) == chosen
    assert first_come(spark.range(0), spark.createDataFrame([], "a long, b long")).collect() == []
    with pytest.raises(ValueError):
        first_come(spark.range(2), spark.createDataFrame([(0, 1), (1, 0)], "a long, b long"))


def test_decluster_is_in_space(spark):
    nodes = spark.createDataFrame([(0, 0.0, 0.0, 0.0), (1, 1.0, 0.0, 0.0), (2, 1.0, 0.0, 50.0)], "id long, x double, y double, z double")
    assert rows(graph.decluster(nodes, 5.0)) == {(0, 0), (1, 0), (2, 2)}


def test_merge_near(spark, town):
    edges, nodes, pairs, places = town
    used, to, mean = set(), {}, {}
    for i in sorted(places):
        if i in used:
            continue
        group = [i] + [j for j in sorted(places) if j > i and j not in used and math.dist(places[i], places[j]) < 7]
        used.update(group)
        to |= dict.fromkeys(group, i)
        mean[i] = tuple(round(sum(places[j][c] for j in group) / len(group), 6) for c in range(3))
    new, moved = graph.merge_near(nodes, edges, 7.0)
    assert {r.id: (round(r.x, 6), round(r.y, 6), round(r.z, 6)) for r in new.collect()} == mean
    assert sorted(tuple(r) for r in moved.collect()) == sorted((to[a], to[b]) for a, b in pairs if to[a] != to[b])


def thinned(pairs, places, most):
    """Edges that Kruskal keeps in each simple cycle of 3 to most nodes, chords of the cycle included."""
    near, gone = adjacent(pairs), set()
    weight = lambda e: (round(math.dist(places[e[0]], places[e[1]]), 6), e)

    def cycles(path):
        for n in near.get(path[-1], ()):
            if n == path[0] and len(path) >= 3:
                yield frozenset(path)
            elif n > path[0] and n not in path and len(path) < most:
                yield from cycles([*path, n])

    for nodes in {c for s in near for c in cycles([s])}:
        root = {n: n for n in nodes}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in sorted((e for e in pairs if set(e) <= nodes), key=weight):
            if find(a) == find(b):
                gone.add((a, b))
            root[find(a)] = find(b)
    return pairs - gone


@pytest.mark.parametrize("most", [3, 6])
def test_short_cycles(town, most):
    edges, nodes, pairs, places = town
    assert rows(graph.without_short_cycles(edges, nodes, most)) == thinned(pairs, places, most)


def brute_spurs(pairs, places):
    near, out = adjacent(pairs), set()
    for i, (n, *more) in ((i, v) for i, v in near.items()):
        if more:
            continue
        if len(near[n]) > 2:
            out.add((i, n))
        elif len(near[n]) == 2:
            k = next(x for x in near[n] if x != i)
            ahead = any(j not in (i, n) and math.dist(places[i], places[j]) <= 5 and 180 - angle(places[n], places[i], places[j]) < 32 for j in places)
            if 180 - angle(places[i], places[n], places[k]) > 75 and not ahead:
                out.add((i, n))
    return out


def test_spurs(town):
    edges, nodes, pairs, places = town
    assert rows(graph.spurs(edges, nodes).select("node", "other")) == brute_spurs(pairs, places)


def test_bridges(town):
    edges, nodes, pairs, places = town
    near, there, out = adjacent(pairs), set(pairs), set()
    candidates = sorted((round(math.dist(places[i], places[j]), 6), i, j) for i, v in near.items() if len(v) == 1 for j in places if j not in (i, v[0]) and math.dist(places[i], places[j]) <= 15 and round(180 - angle(places[v[0]], places[i], places[j]), 6) <= 60)
    done = set()
    for _, i, j in candidates:
        if i in done or (min(i, j), max(i, j)) in there:
            continue
        out.add((i, j))
        there.add((min(i, j), max(i, j)))
        done.add(i)
    assert rows(graph.bridges(edges, nodes, 15.0, 60.0).select("node", "to")) == out


def test_closed_bends(town):
    edges, nodes, pairs, places = town
    near, degree, there, out = adjacent(pairs), {}, set(pairs), set()
    degree = {i: len(near.get(i, ())) for i in places}
    bend = {i for i in places if degree[i] == 2 and angle(places[near[i][0]], places[i], places[near[i][1]]) < 135}
    for i in sorted(bend):
        if degree[i] != 2:
            continue
        options = [(round(math.dist(places[i], places[j]), 6), j) for j in places if j != i and j not in near[i] and (degree[j] > 2 or j in bend) and math.dist(places[i], places[j]) < 15]
        if options:
            j = min(options)[1]
            if (min(i, j), max(i, j)) not in there:
                out.add((min(i, j), max(i, j)))
                there.add((min(i, j), max(i, j)))
                degree[i] += 1
                degree[j] += 1
    assert rows(graph.closed_bends(edges, nodes, 135.0, 15.0)) == out


def test_attach_isolated(town):
    edges, nodes, pairs, places = town
    near = adjacent(pairs)
    single = [i for i in places if len(near.get(i, ())) < 2]
    want = set()
    for i in places:
        if i not in near:
            _, j = min((math.dist(places[i], places[j]), j) for j in single if j != i)
            want.add((min(i, j), max(i, j)))
    assert rows(graph.attach_isolated(edges, nodes)) == want


def test_reindexed_and_rewritten(town):
    edges, nodes, pairs, places = town
    numbered, moved = graph.reindexed(nodes, edges)
    index = {n: k for k, n in enumerate(sorted({x for e in pairs for x in e}))}
    assert {r.id: r["index"] for r in numbered.collect()} == index and rows(moved) == {(index[a], index[b]) for a, b in pairs}
    d = {r.id: r.representative for r in graph.decluster(nodes, 8.0).collect()}
    assert rows(graph.rewrite_edges(edges, graph.decluster(nodes, 8.0))) == {(min(d[a], d[b]), max(d[a], d[b])) for a, b in pairs if d[a] != d[b]}


@pytest.mark.parametrize("seed", range(4))
def test_rasters(spark, seed):
    rng = random.Random(seed)
    w, h = rng.choice([(1, 1), (9, 14), (20, 20), (17, 5)])
    full = {(x, y) for x in range(w) for y in range(h) if rng.random() < 0.85}
    cells = spark.createDataFrame([*full, *list(full)[:3]], "cx int, cy int") if full else spark.createDataFrame([], "cx int, cy int")
    grown = set(full)
    for _ in range(2):
        grown |= {(x, y) for x in range(1, w - 1) for y in range(1, h - 1) if any((x + i, y + j) in grown for i in (-1, 0, 1) for j in (-1, 0, 1))}
    assert rows(graph.dilate(cells, w, h)) == grown
    empty = [(x, y) for x in range(w) for y in range(h) if (x, y) not in full]
    dist = {c: min((max(abs(c[0] - x), abs(c[1] - y)) for x, y in empty), default=None) for c in full}
    far = graph.distance_transform(cells, w, h)
    assert {(r.cx, r.cy): r.dist for r in far.collect()} == dist
    if empty:
        top = {c for c, d in dist.items() if 0 < c[0] < w - 1 and 0 < c[1] < h - 1 and all(dist.get((c[0] + i, c[1] + j), 0) <= d for i in (-1, 0, 1) for j in (-1, 0, 1))}
        assert rows(graph.ridges(far, w, h)) == top


def test_distance_goes_deep(spark):
    cells = spark.range(2601).select((F.col("id") % 51).alias("cx"), F.expr("id div 51").alias("cy")).where("cx BETWEEN 1 AND 49 AND cy BETWEEN 1 AND 49")
    assert graph.distance_transform(cells, 51, 51).agg(F.max("dist")).first()[0] == 25
    assert {r.dist for r in graph.distance_transform(cells.where("cx < 9 AND cy < 9").select(F.col("cx") - 1, F.col("cy") - 1).toDF("cx", "cy"), 8, 8).collect()} == {None}


def test_mesh_shadows(spark):
    rng = random.Random(5)
    samples = [(i, rng.uniform(0, 400), rng.uniform(0, 400), 0.0) for i in range(25)]
    suns = [(k, rng.uniform(0, 360), rng.uniform(6, 80)) for k in range(12)] + [(99, 90.0, 3.0)]
    mesh = [tuple(v for _ in range(3) for v in (x + rng.uniform(-30, 30), y + rng.uniform(-30, 30), rng.uniform(0, 60))) for x, y in ((rng.uniform(0, 400), rng.uniform(0, 400)) for _ in range(40))]

    def hit(o, d, t):
        a, b, c = t[0:3], t[3:6], t[6:9]
        sub = lambda p, q: [i - j for i, j in zip(p, q)]
        cross = lambda p, q: [p[1] * q[2] - p[2] * q[1], p[2] * q[0] - p[0] * q[2], p[0] * q[1] - p[1] * q[0]]
        dot = lambda p, q: sum(i * j for i, j in zip(p, q))
        n = cross(sub(b, a), sub(c, a))
        if abs(dot(n, d)) < 1e-12 or (s := dot(n, sub(a, o)) / dot(n, d)) < 0 or s > 300:
            return False
        p = [i + s * j for i, j in zip(o, d)]
        sides = [dot(n, cross(sub(q, r), sub(p, r))) for r, q in ((a, b), (b, c), (c, a))]
        return all(x >= 0 for x in sides)

    want = {}
    for i, x, y, z in samples:
        for k, az, el in suns:
            d = (math.sin(math.radians(az)), math.cos(math.radians(az)), math.tan(math.radians(el)))
            want[i, k] = el > 5 and not any(hit((x, y, z + 3), d, t) for t in mesh)
    names = ", ".join(f"{c}{i} double" for i in "123" for c in "xyz")
    got = exposure.mesh_facts(spark.createDataFrame(samples, "sample_point_id int, x double, y double, z double"), spark.createDataFrame(suns, "datetime int, azimuth double, elevation double"), spark.createDataFrame(mesh, names), cell=50.0, reach=300.0)
    assert {(r.sample_point_id, r.datetime): r.is_sunlit for r in got.collect()} == want and len(set(want.values())) == 2


def test_points_along_paths(spark):
    rng = random.Random(3)
    paths = {p: [(rng.uniform(0, 50), rng.uniform(0, 50)) for _ in range(rng.choice([1, 2, 3, 9]))] for p in range(12)} | {90: [(1.0, 2.0)] * 3, 91: [(0.0, 0.0), (0.5, 0.0)]}
    df = spark.createDataFrame([(p, i, *q) for p, v in paths.items() for i, q in enumerate(v)], "path_id int, position int, x double, y double")

    def along(v, t):
        if t <= 0 or t >= 1:
            return v[0] if t <= 0 else v[-1]
        target, walked = t * sum(map(math.dist, v, v[1:])), 0.0
        for a, b in zip(v, v[1:]):
            if (d := math.dist(a, b)) and walked + d >= target:
                return tuple(p + (q - p) * (target - walked) / d for p, q in zip(a, b))
            walked += d
        return v[-1]

    got = {}
    for r in analytics.points_along(df, 3.0).collect():
        assert (r.path_id, r.sequence_index) not in got
        got[r.path_id, r.sequence_index] = (r.x, r.y)
    want = {}
    for p, v in paths.items():
        n = max(1, round(sum(map(math.dist, v, v[1:])) / 3.0))
        want |= {(p, i): along(v, i / (n - 1) if n > 1 else 0.0) for i in range(n)}
    assert got.keys() == want.keys() and all(math.dist(got[k], want[k]) < 1e-5 for k in want)
    at = {(r.path_id, r.t): (r.x, r.y) for r in analytics.path_fractions(df, [0.25, 1.0]).collect()}
    assert all(math.dist(at[p, t], along(paths[p], t)) < 1e-5 for p, t in at) and {p for p, _ in at} == {p for p, v in paths.items() if len(v) > 1}
    box = spark.createDataFrame([(10.0, 10.0, 40.0, 40.0, 50.0)], "x1 double, y1 double, x2 double, y2 double, top double")
    lit = {r.path_id: (r.n, r.lit) for r in exposure.lit_along_paths(df, 180.0, 45.0, box, 3.0).collect()}
    assert all(lit[p][0] == sum(1 for q, _ in want if q == p) for p in paths) and 0 < sum(b for _, b in lit.values()) < sum(a for a, _ in lit.values())
    assert {r.lit for r in exposure.lit_along_paths(df, 180.0, 4.0, box, 3.0).collect()} == {0}


def test_search_and_lookup(spark):
    rng = random.Random(8)
    w = [(i, rng.uniform(0, 900), rng.uniform(0, 900), rng.uniform(0, 40)) for i in range(60)]
    ends = [(f"e{i}", rng.uniform(-300, 1200), rng.uniform(0, 900), 0.0) for i in range(15)]
    kind = " string, x double, y double, z double"
    got = rows(joins.connectors(spark.createDataFrame(ends, "id" + kind), spark.createDataFrame(w, "id long, x double, y double, z double"), 20.0))
    assert got == {(e[0], min((math.dist(e[1:], p[1:]), p[0]) for p in w)[1]) for e in ends}
    points = spark.createDataFrame(w, "id long, x double, y double, z double")
    assert {r.id for r in joins.around(points, 450.0, 450.0, 200.0).collect()} == {i for i, x, y, _ in w if math.dist((x, y), (450, 450)) <= 200}
    edges = spark.createDataFrame([(1, 2, "p"), (5, 3, "q")], "a long, b long, name string")
    assert rows(joins.edge_between(spark.createDataFrame([(2, 1), (3, 5), (1, 5)], "a long, b long"), edges)) == {(2, 1, "p"), (3, 5, "q")}


def test_sections_have_bounds(spark):
    many = spark.range(128 * 128 + 1).select(F.col("id").cast("int").alias("section_id"), (F.col("id") % 128).cast("int").alias("grid_col"), F.least(F.lit(127), F.expr("id div 128")).cast("int").alias("grid_row"), F.lit(1).alias("sample_count"))
    with pytest.raises(ValueError, match="more sections"):
        topology.cut_sections(many, 5)
    assert topology.cut_sections(many.limit(128 * 128), 5).count() == 128 * 128
    with pytest.raises(ValueError, match="shards for"):
        topology.cut_sections(many.limit(3), 5)
    cut = spark.createDataFrame([(1, 0, 10), (2, 1, 10), (3, 1, 10)], "section_id int, shard_index int, sample_count int")
    with pytest.raises(ValueError, match="imbalance"):
        topology.require_balance(cut)
    topology.require_balance(cut, 1.4)
    points = spark.createDataFrame([(0.0, 0.0), (130_000.0, 5.0)], "x double, y double")
    empty = spark.createDataFrame([], "origin_x double, origin_y double, cols int, rows int, size double")
    with pytest.raises(ValueError, match="lattice"):
        topology.grid_upsert(empty, points, 1000.0)
    with pytest.raises(ValueError, match="no points"):
        topology.grid_upsert(empty, points.limit(0), 1000.0)
    kept = topology.grid_upsert(topology.grid_upsert(empty, points.limit(1), 1000.0), points.limit(0), 1000.0)
    assert tuple(kept.first()) == (0.0, 0.0, 1, 1, 1000.0)


def _woods(spark):
    points = spark.range(40).select((F.col("id") % 4).alias("edge_id"), F.col("id").alias("sample_point_id"), (F.col("id") * 5.0).alias("x"), F.lit(0.0).alias("y"))
    return points, spark.range(9).select(F.col("id").alias("tree_id"), (F.col("id") * 20.0).alias("x"), F.lit(3.0).alias("y"), F.lit(0.25).alias("shade_norm"))


def _cells_broadcast(df):
    return "BroadcastHashJoin [_cx" in df._jdf.queryExecution().executedPlan().toString()


def test_edge_tree_values_keep_trees_off_the_driver(spark):
    sums = exposure.tree_values(*_woods(spark), 5.0).groupBy("edge_id").agg(F.sum("tree_value").alias("total"))
    assert not _cells_broadcast(sums) and {r.edge_id: r.total for r in sums.collect()} == {0: 2.25, 1: 0.0, 2: 0.0, 3: 0.0}


def test_tree_values_keep_trees_off_the_driver(spark):
    values = exposure.tree_values(*_woods(spark), 7.0)
    assert not _cells_broadcast(values) and {r.sample_point_id for r in values.where("tree_value > 0").collect()} == {i for i in range(40) if min(abs(5 * i - 20 * k) for k in range(9)) <= 40**0.5}


def test_distance_join_keeps_places_off_the_driver(spark):
    places = lambda key: spark.range(50).select(F.col("id").alias(key), (F.col("id") * 7.0).alias("x"), (F.col("id") * 3.0).alias("y"))
    pairs = joins.within(places("id"), places("other"), 20.0)
    assert not _cells_broadcast(pairs) and rows(pairs.select("id", "other")) == {(a, b) for a in range(50) for b in range(50) if 58 * (a - b) ** 2 <= 400}


def test_redundant_edges_between_places(spark, monkeypatch):
    rng = random.Random(4)
    places = {i: (float(rng.randrange(40)), float(rng.randrange(40)), float(i % 3)) for i in range(70)}
    pairs = {tuple(sorted(rng.sample(range(70), 2))) for _ in range(600)} | {(0, k) for k in range(1, 70)}
    edges, nodes = spark.createDataFrame(sorted(pairs), "a long, b long"), spark.createDataFrame([(i, *p) for i, p in places.items()], "id long, x double, y double, z double")
    by_join = graph.redundant_edges(graph.edge_lengths(edges, nodes).select("a", "b", "length"), 2.0)
    monkeypatch.setattr(graph, "PAIRS", 50)
    got = graph.redundant_edges(edges, 2.0, nodes)
    length = lambda p, q: math.dist(places[p], places[q])
    near = adjacent(pairs)
    want = {(a, b) for a, b in pairs if any(length(a, k) + length(k, b) <= length(a, b) + 2 for k in near[a] if k in near[b])}
    assert rows(got) == rows(by_join) == want and 100 < len(want) < len(pairs)


def _grid(spark, seed, w, h, blob):
    rng = random.Random(seed)
    full = {(rng.randrange(w), rng.randrange(h)) for _ in range(250)} | {(x, y) for x in range(blob[0], blob[1]) for y in range(blob[2], blob[3])} - {(7, 9), (40, 300)}
    return spark.createDataFrame(sorted(full), "cx long, cy long"), full




@pytest.mark.parametrize("blob", [(0, 30, 240, 270), (250, 262, 0, 520), (3, 9, 3, 9)])
def test_distances_of_blobs(spark, blob):
    w, h = 300, 520
    cells, full = _grid(spark, blob[0], w, h, blob)
    left, want, r = set(full), {}, 0
    while left:
        r += 1
        stay = {(x, y) for x, y in left if all((x + i, y + j) in left for i in (-1, 0, 1) for j in (-1, 0, 1) if 0 <= x + i < w and 0 <= y + j < h)}
        want |= dict.fromkeys(left - stay, r)
        left = stay
    assert {(d.cx, d.cy): d.dist for d in graph.distance_transform(cells, w, h).collect()} == want and r >= 3


def test_distances_make_no_empty_cells(spark):
    far = graph.distance_transform(spark.createDataFrame([(5, 7), (10**8, 10**8)], "cx long, cy long"), 10**9, 10**9)
    assert {tuple(r) for r in far.collect()} == {(5, 7, 1), (10**8, 10**8, 1)}


@pytest.mark.parametrize("blob", [(0, 30, 240, 270), (250, 262, 0, 520), (3, 9, 3, 9)])
def test_dilate_across_tiles(spark, blob):
    w, h = 300, 520
    cells, full = _grid(spark, blob[0], w, h, blob)
    for _ in range(2):
        full = full | {(x + i, y + j) for x, y in full for i in (-1, 0, 1) for j in (-1, 0, 1) if 1 <= x + i <= w - 2 and 1 <= y + j <= h - 2}
    got = graph.dilate(cells.unionByName(cells), w, h).collect()
    assert {tuple(r) for r in got} == full and len(got) == len(full)
    huge = graph.dilate(spark.createDataFrame([(10**6, 10**6)], "cx long, cy long"), 10**9, 10**9)
    assert "Join" not in huge._jdf.queryExecution().executedPlan().toString() and huge.count() == 25
    assert str(huge._jdf.queryExecution().executedPlan().toString()).count("Exchange") == 1


@pytest.mark.parametrize("times", [1, 2, 5])
def test_dilate_off_the_last_tile(spark, times):
    side = [p + k for p in (256, 512) for k in range(-times - 1, times + 2)]
    full = {(x, y) for x in side for y in side if (x + 2 * y) % 5 == 0}
    want = {(x + i, y + j) for x, y in full for i in range(-times, times + 1) for j in range(-times, times + 1)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a tile's right neighbour is in another task
    try:
        got = graph.dilate(spark.createDataFrame(sorted(full), "cx long, cy long"), 1000, 1000, times).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {tuple(r) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("blob", [(0, 30, 240, 270), (250, 262, 0, 520)])
def test_ridges_across_tiles(spark, blob):
    w, h = 300, 520
    cells, _ = _grid(spark, blob[0], w, h, blob)
    far = graph.distance_transform(cells, w, h)
    dist = {(r.cx, r.cy): r.dist for r in far.collect()}
    top = {c for c, d in dist.items() if 0 < c[0] < w - 1 and 0 < c[1] < h - 1 and all(dist.get((c[0] + i, c[1] + j), 0) <= d for i in (-1, 0, 1) for j in (-1, 0, 1))}
    ridge = graph.ridges(far, w, h)
    assert rows(ridge) == top and "Join" not in ridge._jdf.queryExecution().executedPlan().toString()


def test_bridge_candidates_are_few(spark):
    rng = random.Random(2)
    places = {i: (rng.uniform(0, 100), rng.uniform(0, 100), 0.0) for i in range(200)}
    pairs = {(i, i + 1) for i in range(0, 199) if i % 3}
    edges, nodes = spark.createDataFrame(sorted(pairs), "a long, b long"), spark.createDataFrame([(i, *p) for i, p in places.items()], "id long, x double, y double, z double")
    near = adjacent(pairs)
    want, taken = set(), set()
    order = []
    for n in (n for n in near if len(near[n]) == 1):
        o = near[n][0]
        for t in places:
            d = math.dist(places[n], places[t])
            if t not in (n, o) and d <= 60 and 180 - angle(places[o], places[n], places[t]) <= 40:
                order.append((round(d, 6), n, t))
    for d, n, t in sorted(order):
        if n not in taken and (t, n) not in want:
            taken.add(n)
            want.add((n, t))
    got = graph.bridges(edges, nodes, 60.0, 40.0)
    assert {(r.node, r.to) for r in got.collect()} == want and len(want) > 80
    assert graph._bridge_candidates(edges, nodes, 60.0, 40.0).count() < len(order) / 5


def test_first_links_are_few(spark):
    edges = spark.createDataFrame([(a, b) for a in range(40) for b in range(a + 1, 40)] + [(0, 100), (1, 100), (5, 101)], "a long, b long")
    links = graph._first_links(joins.neighbours(edges), 4)
    assert links.groupBy("node").count().agg(F.max("count")).first()[0] <= 4
    got = {r.start: r.path for r in graph.simple_paths(edges, graph.degrees(edges).select("node"), 4).collect()}
    assert got[0] == [0, 1, 2, 3, 4] and got[101] == [101, 5, 0, 1, 2] and got[100] == [100, 0, 1, 2, 3] and len(got) == 42
