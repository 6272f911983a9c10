"""Street-graph and raster operators."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunweave.functions.spatial import turn_degrees, turn_degrees_3d
from sunweave.operators.components import connected_components
from sunweave.operators.greedy import first_come
from sunweave.operators.prefix import running
from sunweave.operators.sorted_blocks import Tiles, by_blocks, in_tiles, starts
from sunweave.operators.spatial import edge_set, neighbours, within
from sunweave.sources.shared import written

#: Pairs of links that a task looks at at once.
PAIRS = 1 << 20
EIGHT = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j]


def _z(nodes: DataFrame) -> DataFrame:
    return nodes if "z" in nodes.columns else nodes.withColumn("z", F.lit(0.0))


def _at(nodes: DataFrame, name: str) -> DataFrame:
    """Nodes as (name, namex, namey, namez)."""
    return _z(nodes).select(F.col("id").alias(name), *[F.col(c).alias(name + c) for c in "xyz"])


def _apart(a: str, b: str) -> Column:
    """Distance in space of two places with such column prefixes."""
    return F.sqrt(sum(((F.col(a + c) - F.col(b + c)) ** 2 for c in "xyz"), F.lit(0.0)))


def _near(nodes: DataFrame, others: DataFrame, radius: float, keep: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of nodes and others (with columns to keep) at most radius apart in space, both ways but for a node and itself, with dist."""
    o = _z(others).select(F.col("id").alias("other"), "x", "y", F.col("z").alias("r_z"), *keep)
    d = F.sqrt((F.col("x") - F.col("r_x")) ** 2 + (F.col("y") - F.col("r_y")) ** 2 + (F.col("z") - F.col("r_z")) ** 2)
    return within(_z(nodes), o, radius).where("id <> other").withColumn("dist", d).where(F.col("dist") <= radius)


def decluster(nodes: DataFrame, radius: float) -> DataFrame:
    """(id, representative): nodes linked at strictly less than radius in space share the member nearest their centroid.

    Ties go to the smallest id (a defined order instead of that of the input). nodes: (id, x, y) and, if there is one, z.
    """
    links = _near(nodes, nodes, radius).where((F.col("id") < F.col("other")) & (F.col("dist") < radius)).select(F.col("id").alias("src"), F.col("other").alias("dst"))
    root = connected_components(written(links, "links"))
    of = _z(nodes).join(root, F.col("id") == F.col("node"), "left").select("id", "x", "y", "z", F.coalesce("root", "id").alias("root"))
    centre = of.groupBy("root").agg(*[F.avg(c).alias("m" + c) for c in "xyz"])
    d = F.round(sum(((F.col(c) - F.col("m" + c)) ** 2 for c in "xyz"), F.lit(0.0)), 6)
    best = of.join(centre, "root").groupBy("root").agg(F.min(F.struct(d.alias("d"), "id"))["id"].alias("representative"))
    return of.join(best, "root").select("id", "representative")


def rewrite_edges(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """Edges between representatives, without loops and repeats."""
    a, b = (mapping.select(F.col("id").alias(k), F.col("representative").alias("r" + k)) for k in ("a", "b"))
    return edge_set(edges.select("a", "b").join(a, "a").join(b, "b"), "ra", "rb")


def merge_near(nodes: DataFrame, edges: DataFrame, radius: float = 2.5) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) after each node, in order of ids, took in the later ones left within less than radius.

    A taker's place becomes the mean of its group; it keeps its id. Takers are those that no taker before them is near to,
    and every other node goes to the first taker it is near to. Loops go; repeated edges stay for ``edge_set``.
    """
    pairs = written(_near(nodes, nodes, radius).where((F.col("id") < F.col("other")) & (F.col("dist") < radius)).select(F.col("id").alias("a"), F.col("other").alias("b")), "near")
    takers = written(first_come(nodes, pairs), "takers")
    taken = pairs.join(takers.select(F.col("id").alias("a")), "a", "left_semi").join(takers.select(F.col("id").alias("b")), "b", "left_anti")
    of = takers.select("id", F.col("id").alias("taker")).unionByName(taken.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("taker")))
    of = written(of, "taken")
    merged = _z(nodes).join(of, "id").groupBy(F.col("taker").alias("id")).agg(*[F.round(F.avg(c), 9).alias(c) for c in "xyz"])
    to = lambda k: of.select(F.col("id").alias(k), F.col("taker").alias("t" + k))
    moved = edges.select("a", "b").join(to("a"), "a").join(to("b"), "b").where("ta <> tb")
    return merged, moved.select(F.col("ta").alias("a"), F.col("tb").alias("b"))


def edge_lengths(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with their ends (ax to bz), length in space and line as WKT."""
    j = edges.join(_at(nodes, "a"), "a").join(_at(nodes, "b"), "b").withColumn("length", F.round(_apart("a", "b"), 6))
    return j.withColumn("line", F.format_string("LINESTRING Z (%s %s %s, %s %s %s)", *[F.col(k + c).cast("string") for k in "ab" for c in "xyz"]))


def unsampled(edges: DataFrame, samples: DataFrame) -> DataFrame:
    """Edges (edge_id, ...) that have no sample yet."""
    return edges.join(samples.select("edge_id").distinct(), "edge_id", "left_anti")


def sample_points(edges: DataFrame, spacing: float) -> DataFrame:
    """Points along each edge: max(1, length / spacing rounded half to even) of them, the ends included. Needs ax to bz and length."""
    n = F.greatest(F.lit(1), F.rint(F.col("length") / max(0.01, spacing)).cast("int"))
    rows = edges.withColumn("n", n).withColumn("sequence_index", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    t = F.when(F.col("n") > 1, F.col("sequence_index") / (F.col("n") - 1)).otherwise(0.0)
    lerp = lambda k: F.round(F.col("a" + k) + (F.col("b" + k) - F.col("a" + k)) * t, 6).alias(k)
    return rows.select("a", "b", "sequence_index", (t * F.col("length")).alias("distance_from_start"), lerp("x"), lerp("y"), lerp("z"))


def _detours(slack: float):
    """For rows (u, v, x, y, z, l) of links of u to places: triangles (u, v, w) of which a side may be as long as the others but for slack."""

    def run(u, v, x, y, z, l):  # noqa: E741
        first = np.flatnonzero(starts(u))
        end = np.repeat(np.append(first[1:], len(u)), np.diff(np.append(first, len(u))))
        later = end - np.arange(len(u)) - 1
        at = np.concatenate([[0], np.cumsum(later)])
        low = 0
        while low < len(u):
            high = max(low + 1, int(np.searchsorted(at, at[low] + PAIRS, "right")) - 1)
            i = np.repeat(np.arange(low, high), later[low:high])
            j = i + 1 + np.arange(len(i)) - (at[i] - at[low])
            far = np.sqrt((x[i] - x[j]) ** 2 + (y[i] - y[j]) ** 2 + (z[i] - z[j]) ** 2)
            # Lengths are rounded, so that the exact test is left to the few that have all sides.
            some = np.flatnonzero(l[i] + l[j] + far - 2 * np.maximum(np.maximum(l[i], l[j]), far) <= slack + 1e-5)
            i, j, low = i[some], j[some], high
            yield {"u": u[i], "v": np.minimum(v[i], v[j]), "w": np.maximum(v[i], v[j])}

    return run


def redundant_edges(edges: DataFrame, slack: float = 0.1, nodes: DataFrame | None = None) -> DataFrame:
    """Edges that a way over one other node replaces at the cost of slack at most. edges: (a, b, length).

    With nodes, edges are a set (a, b) with a < b, as long as their ends are apart (``edge_lengths``). Then each triangle is
    looked for at its end of the smallest degree, of which no node has more than the root of twice the edges, and its
    third side's length is known before it is looked up.
    """
    if nodes is not None:
        return _redundant_between(edges.select("a", "b"), nodes, slack)
    both = edges.select("a", "b", "length").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "length"))
    first = both.select("a", F.col("b").alias("k"), F.col("length").alias("l1"))
    second = both.select(F.col("a").alias("k"), "b", F.col("length").alias("l2"))
    ways = edges.join(first, "a").join(second, ["k", "b"]).where(F.col("l1") + F.col("l2") <= F.col("length") + slack)
    return ways.select("a", "b").distinct()


def _redundant_between(edges: DataFrame, nodes: DataFrame, slack: float) -> DataFrame:
    e = written(edges, "edges")
    placed = written(_z(nodes).join(degrees(e), F.col("id") == F.col("node")).select("id", "x", "y", "z", "degree"), "placed")
    at = lambda k: placed.select(F.col("id").alias(k), *[F.col(c).alias(k + c) for c in (*"xyz", "degree")])
    j = e.join(at("a"), "a").join(at("b"), "b").withColumn("l", F.round(_apart("a", "b"), 6))
    up = F.struct("adegree", "a") < F.struct("bdegree", "b")
    of = lambda c: F.when(up, F.col("b" + c)).otherwise(F.col("a" + c))
    out = j.select(F.when(up, F.col("a")).otherwise(F.col("b")).alias("u"), of("").alias("v"), *[of(c).alias(c) for c in "xyz"], "l")
    found = by_blocks(out, ["u"], [], _detours(slack), "u long, v long, w long")
    found = written(found.join(e.select(F.col("a").alias("v"), F.col("b").alias("w")), ["v", "w"], "left_semi").select("u", "v", "w"), "triangles")
    for k in "uvw":
        found = found.join(_at(placed, k), k)
    side = lambda p, q: F.struct(F.least(p, q).alias("a"), F.greatest(p, q).alias("b"), F.round(F.when(F.col(p) < F.col(q), _apart(p, q)).otherwise(_apart(q, p)), 6).alias("l"))
    found = found.select(side("u", "v").alias("one"), side("u", "w").alias("two"), side("v", "w").alias("three"))
    by = lambda p, q, r: found.where(F.col(p + ".l") + F.col(q + ".l") <= F.col(r + ".l") + slack).select(r + ".a", r + ".b")
    return by("one", "two", "three").unionByName(by("one", "three", "two")).unionByName(by("two", "three", "one")).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    return neighbours(edges).groupBy("node").agg(F.count("*").alias("degree"))


def without_short(edges: DataFrame, least: float = 1.0) -> DataFrame:
    return edges.where(F.col("length") >= least)


def reindexed(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with an edge, numbered from 0 by id, and the edges in these numbers."""
    used = nodes.join(neighbours(edges).select(F.col("node").alias("id")).distinct(), "id", "left_semi")
    numbered = written(running(used, [F.col("id")], "index"), "numbered")
    a, b = (numbered.select(F.col("id").alias(k), F.col("index").alias("i" + k)) for k in ("a", "b"))
    return numbered, edges.join(a, "a").join(b, "b").select(F.col("ia").alias("a"), F.col("ib").alias("b"))


def without_short_cycles(edges: DataFrame, nodes: DataFrame, most: int = 10) -> DataFrame:
    """Edges (a, b) without the longest of each cycle of three to most edges; equal lengths go by (a, b).

    Thinning every such cycle, with its chords, to its minimum spanning tree removes exactly the edges between whose ends
    a way of two to most - 1 shorter edges leads. Shorter ways are followed from both ends at once, half of the hops each,
    so that an edge sees its surroundings only.
    """
    e = written(edge_lengths(edge_set(edges, "a", "b"), nodes).select("a", "b", F.struct(F.round("length", 6).alias("l"), "a", "b").alias("o")), "edges")
    both = written(e.select(F.col("a").alias("from"), F.col("b").alias("to"), F.col("o").alias("step")).unionByName(e.select(F.col("b").alias("from"), F.col("a").alias("to"), F.col("o").alias("step"))), "steps")

    def reached(end: str, hops: int) -> DataFrame:
        seen = e.select("o", F.col(end).alias("at"))
        for _ in range(hops):
            on = seen.join(both, (F.col("at") == F.col("from")) & (F.col("step") < F.col("o"))).select("o", F.col("to").alias("at"))
            seen = written(seen.unionByName(on).distinct(), "reached")
        return seen

    long = reached("a", most // 2).join(reached("b", most - 1 - most // 2), ["o", "at"], "left_semi").select("o").distinct()
    return e.join(long, "o", "left_anti").select("a", "b")


def straight_nodes(edges: DataFrame, nodes: DataFrame, least: float = 165.0) -> DataFrame:
    """(node, p, q): nodes of degree two whose edges go straight on, with their neighbours p < q."""
    two = neighbours(edges).groupBy("node").agg(F.count("*").alias("d"), F.min("other").alias("p"), F.max("other").alias("q")).where("d = 2 AND p <> q")
    at = lambda k: nodes.select(F.col("id").alias(k), F.col("x").alias(k + "x"), F.col("y").alias(k + "y"))
    j = two.join(at("node"), "node").join(at("p"), "p").join(at("q"), "q")
    angle = turn_degrees(*map(F.col, ("px", "py", "nodex", "nodey", "qx", "qy")))
    return j.where(angle > least).select("node", "p", "q")


def dissolve_straight(edges: DataFrame, nodes: DataFrame, least: float = 165.0) -> DataFrame:
    """Edges after dissolving straight nodes until none is left; in a round no two neighbours go, the smaller id first."""
    while True:
        s = straight_nodes(edges, nodes, least)
        s = written(s, "straight")
        near = neighbours(edges).join(s.select(F.col("node").alias("other")), "other", "left_semi").where("other < node")
        go = written(s.join(near.select("node").distinct(), "node", "left_anti"), "dissolved")
        if go.isEmpty():
            return edges
        rest = edges.join(go.select(F.col("node").alias("a")), "a", "left_anti").join(go.select(F.col("node").alias("b")), "b", "left_anti").select("a", "b")
        edges = written(edge_set(rest.unionByName(go.select(F.col("p").alias("a"), F.col("q").alias("b"))), "a", "b"), "edges")


def _ends(edges: DataFrame) -> DataFrame:
    """(node, other): dead ends with their only neighbour."""
    return neighbours(edges).join(degrees(edges).where("degree = 1").select("node"), "node", "left_semi")


def _ahead_of(ends: DataFrame, nodes: DataFrame, reach: float, keep: tuple[str, ...] = ()) -> DataFrame:
    """(.., to, dist, turn): nodes within reach of placed dead ends and the degrees these would turn to them."""
    rest = [c for c in ends.columns if c not in ("x", "y", "z", "otherx", "othery", "otherz")]
    pairs = _near(ends.withColumnRenamed("other", "from").withColumn("id", F.col("node")), nodes, reach, keep).where("from <> other")
    turn = 180 - turn_degrees_3d([F.col("other" + c) for c in "xyz"], [F.col(c) for c in "xyz"], [F.col("r_" + c) for c in "xyz"])
    return pairs.select(*[F.col("from").alias("other") if c == "other" else F.col(c) for c in rest], *keep, F.col("other").alias("to"), F.round("dist", 6).alias("dist"), F.round(turn, 6).alias("turn"))


def _placed_ends(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    ends = _ends(edges).join(_at(nodes, "node"), "node").join(_at(nodes, "other"), "other")
    return ends.withColumnsRenamed({"nodex": "x", "nodey": "y", "nodez": "z"})


def _ahead(edges: DataFrame, nodes: DataFrame, reach: float) -> DataFrame:
    """(node, other, to, dist, turn): nodes within reach of each dead end and the degrees it would turn to them."""
    return _ahead_of(_placed_ends(edges, nodes), nodes, reach)


def spurs(edges: DataFrame, nodes: DataFrame | None = None, turn: float = 75.0, reach: float = 5.0, ahead: float = 32.0) -> DataFrame:
    """(node, other): dead ends that pruning takes: at crossings, and after a sharp turn with nothing ahead.

    The second kind, which needs the nodes, hangs on a node of degree two, turns there by more than turn degrees, and has no
    node within reach that lies less than ahead degrees off its way.
    """
    ends = _ends(edges).join(degrees(edges).select(F.col("node").alias("other"), "degree"), "other")
    crossing = ends.where("degree > 2").select("node", "other")
    if nodes is None:
        return crossing
    bent = ends.where("degree = 2").select("node", "other").join(neighbours(edges).select(F.col("node").alias("other"), F.col("other").alias("next")), "other").where("next <> node")
    bent = bent.join(_at(nodes, "node"), "node").join(_at(nodes, "other"), "other").join(_at(nodes, "next"), "next")
    angle = 180 - turn_degrees_3d(*[[F.col(k + c) for c in "xyz"] for k in ("node", "other", "next")])
    forward = _ahead(edges, nodes, reach).where(F.col("turn") < ahead).select("node").distinct()
    return crossing.unionByName(bent.where(angle > turn).select("node", "other").join(forward, "node", "left_anti"))


def pruned(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges without those of spurs."""
    gone = spurs(edges, nodes).select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    return edge_set(edges, "a", "b").join(gone, ["a", "b"], "left_anti")


def attach_isolated(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): each node without an edge joined to the nearest other of at most one; ties go to the smallest id.

    All choose at once, by the degrees before. The search widens by doubling its radius until every node has a partner.
    """
    d = degrees(edges)
    single = written(_z(nodes).join(d.where("degree > 1").select(F.col("node").alias("id")), "id", "left_anti").select("id", "x", "y", "z"), "single")
    open_ = written(single.join(d.select(F.col("node").alias("id")), "id", "left_anti"), "open")
    if single.count() < 2 or open_.isEmpty():
        return edges.select("a", "b").limit(0)
    box = single.agg(*[f(c).alias(n + c) for c in "xyz" for n, f in (("low", F.min), ("high", F.max))]).first()
    span = math.dist([box["low" + c] for c in "xyz"], [box["high" + c] for c in "xyz"])
    radius, found = max(span / 1024, 1e-6), None
    while True:
        best = written(_near(open_, single, radius).groupBy("id").agg(F.min(F.struct("dist", "other"))["other"].alias("to")), "partners")
        found = best if found is None else written(found.unionByName(best), "partners")
        open_ = written(open_.join(best.select("id"), "id", "left_anti"), "open")
        if open_.isEmpty():
            return edge_set(found, "id", "to")
        radius *= 2


def _bridge_candidates(edges: DataFrame, nodes: DataFrame, reach: float, turn: float) -> DataFrame:
    """(node, to, dist): of each dead end the candidates up to the first that nothing can block.

    Only its reverse, earlier in the order, can block a candidate, and that has the same distance: all but those to dead ends
    of smaller ids are free. The search widens by doubling its radius for the ends that had no free one within it.
    """
    ends = written(_placed_ends(edges, nodes), "ends")
    of = ends.select(F.col("node").alias("id"), F.lit(True).alias("end"))
    targets = written(_z(nodes).join(of, "id", "left").select("id", "x", "y", "z", F.coalesce("end", F.lit(False)).alias("end")), "targets")
    open_, found, radius = ends, None, reach / 64
    while True:
        last = radius >= reach
        free = _ahead_of(open_, targets, radius, ("end",)).where((F.col("turn") <= turn) & (~F.col("end") | (F.col("to") > F.col("node"))))
        free = free.groupBy("node").agg(F.min(F.struct("dist", "to")).alias("free"))
        # Beyond the radius there may be as near a one with a smaller id, as distances are rounded.
        free = written(free if last else free.where(F.col("free.dist") < radius - 1e-5), "free")
        before = _ahead_of(open_.join(free, "node", "left" if last else "inner"), targets.where("end"), radius)
        before = before.where((F.col("turn") <= turn) & (F.col("to") < F.col("node")) & (F.col("free").isNull() | (F.struct("dist", "to") < F.col("free"))))
        rows = free.select("node", "free.to", "free.dist").unionByName(before.select("node", "to", "dist"))
        found = written(rows if found is None else found.unionByName(rows), "candidates")
        open_ = written(open_.join(free, "node", "left_anti"), "ends")
        if last or open_.isEmpty():
            return found
        radius = min(2 * radius, reach)


def bridges(edges: DataFrame, nodes: DataFrame, reach: float = 10.0, turn: float = 40.0) -> DataFrame:
    """(node, to, dist): the node ahead of each dead end that it is joined to, within reach and turn, with no edge to it yet.

    Candidates are taken nearest first, then by (node, to): one for each dead end, and none that joins two dead ends again
    the other way round.
    """
    c = _bridge_candidates(edges, nodes, reach, turn)
    order = lambda p: F.struct(F.col(p + "dist"), F.col(p + "node"), F.col(p + "to"))
    one = c.select(*[F.col(x).alias("l_" + x) for x in c.columns])
    two = c.select(*[F.col(x).alias("r_" + x) for x in c.columns])
    key = lambda p: F.struct(F.col(p + "node").alias("node"), F.col(p + "to").alias("to"))
    again = one.join(two, (F.col("l_node") == F.col("r_to")) & (F.col("l_to") == F.col("r_node")))
    same = one.join(two, F.col("l_node") == F.col("r_node"))
    blocks = same.unionByName(again).where(order("l_") < order("r_")).select(key("l_").alias("a"), key("r_").alias("b"))
    taken = first_come(c.select(key("").alias("id")), blocks).select("id.node", "id.to")
    return c.join(taken, ["node", "to"]).select("node", "to", "dist")


def closed_bends(edges: DataFrame, nodes: DataFrame, bend: float = 135.0, reach: float = 15.0) -> DataFrame:
    """(a, b): sharp bends joined to the nearest crossing or other sharp bend less than reach away.

    Bends are nodes of degree two with an angle below bend, in order of ids; one that an earlier bend was joined to has
    three edges then and is passed over. A partner it has an edge to already closes nothing.
    """
    two = neighbours(edges).groupBy("node").agg(F.count("*").alias("d"), F.min("other").alias("p"), F.max("other").alias("q"))
    at = two.where("d = 2").join(_at(nodes, "node"), "node").join(_at(nodes, "p"), "p").join(_at(nodes, "q"), "q")
    angle = turn_degrees_3d(*[[F.col(k + c) for c in "xyz"] for k in ("p", "node", "q")])
    bends = written(at.where(angle < bend).select(F.col("node").alias("id"), "p", "q"), "bends")
    targets = bends.select("id").unionByName(two.where("d > 2").select(F.col("node").alias("id")))
    place = _z(nodes).select("id", "x", "y", "z")
    near = _near(bends.join(place, "id"), targets.join(place, "id"), reach).where((F.col("dist") < reach) & (F.col("other") != F.col("p")) & (F.col("other") != F.col("q")))
    choice = written(near.groupBy("id").agg(F.min(F.struct(F.round("dist", 6).alias("d"), "other"))["other"].alias("to")), "choices")
    before = choice.where("id < to").join(choice.select(F.col("id").alias("to")), "to", "left_semi").select(F.col("id").alias("a"), F.col("to").alias("b"))
    act = first_come(choice, before)
    return edge_set(choice.join(act, "id"), "id", "to")


def connected(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges after isolated nodes were attached, spurs pruned twice, dead ends bridged and bends closed."""
    edges = written(edge_set(edges.select("a", "b").unionByName(attach_isolated(edges, nodes)), "a", "b"), "edges")
    for _ in range(2):
        edges = written(pruned(edges, nodes), "edges")
    more = bridges(edges, nodes).select(F.col("node").alias("a"), F.col("to").alias("b"))
    edges = written(edge_set(edges.unionByName(more), "a", "b"), "edges")
    return edge_set(edges.unionByName(closed_bends(edges, nodes)), "a", "b")


def _first_paths(others: int):
    """For rows sorted by (node, path): of each node the paths that are the first to avoid some set of so many other nodes."""

    def blocked(path: list, kept: list, free: int) -> bool:
        """Whether no set of free nodes outside path meets all kept paths."""
        if not kept:
            return False
        return free == 0 or all(x in path or blocked(path, [k for k in kept if x not in k], free - 1) for x in kept[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, kept, full = None, [], False
        for batch in batches:
            nodes, paths = [], []
            for n, path in zip(batch.column("node").to_pylist(), batch.column("path").to_pylist(), strict=True):
                if n != node:
                    node, kept, full = n, [], False
                if full or blocked(path, kept, others):
                    continue
                kept.append(path)
                full = blocked([], kept, others)
                nodes.append(n), paths.append(path)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, batch.schema.field("node").type), pa.array(paths, batch.schema.field("path").type)], names=["node", "path"])

    return run


def _first_links(n: DataFrame, hops: int) -> DataFrame:
    """(node, other, most): links that a first simple path of hops edges may take, and with how many edges left at most.

    A node is poor if it has hops neighbours or fewer that aren't poor themselves, told in hops - 1 rounds. From any other a path
    goes on whatever hops nodes it has been at. So one that comes to a node after s others goes on at the latest to the
    last of the node's s + 1 first neighbours that aren't poor.
    """
    poor = n.select("node").limit(0)
    degree = written(n.groupBy("node").agg(F.count("*").alias("degree")), "degrees")
    for _ in range(hops - 1):
        lost = n.join(poor.select(F.col("node").alias("other")), "other", "left_semi").groupBy("node").agg(F.count("*").alias("lost"))
        poor = written(degree.join(lost, "node", "left").where(F.col("degree") - F.coalesce("lost", F.lit(0)) <= hops).select("node"), "poor")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("other"))
    of = poor.select(F.col("node").alias("other"))
    rich = written(n.join(of, "other", "left_anti").select("node", "other", rank.alias("rank")).where(F.col("rank") <= hops), "first")
    # A poor neighbour counts with those of the next rank.
    ranks = rich.groupBy("node").agg(F.sort_array(F.collect_list("other")).alias("firsts"))
    before = F.size(F.filter("firsts", lambda x: x < F.col("other")))
    some = n.join(of, "other", "left_semi").join(ranks, "node", "left").select("node", "other", F.coalesce(before + 1, F.lit(1)).alias("rank"))
    every = rich.select("node", "other", "rank").unionByName(some)
    # After s others, with h = hops - s edges left, ranks up to s + 1 count.
    return every.where(F.col("rank") <= hops).select("node", "other", (F.lit(hops + 1) - F.col("rank")).alias("most"))


def simple_paths(edges: DataFrame, starts: DataFrame, hops: int) -> DataFrame:
    """(start, path): for each start the first simple path of hops edges, in order of node ids. edges: a set.

    Built from its end: a path that comes to a node has been at a known number of others, s. Of the node's ways on, only
    those count that are the first to avoid some s nodes; of ways of h nodes these are (h + s over h) at most, so that a
    level has a bounded number of rows for each edge, and no path is left out that could be the first. Of a node's links
    nearly always the s + 1 first are enough (``_first_links``).
    """
    links = written(_first_links(neighbours(written(edges.select("a", "b"), "edges")), hops), "links")
    ways = None
    for h in range(1, hops + 1):
        n = links.where(F.col("most") >= h).select("node", "other")
        if ways is None:
            ways = n.select("node", F.array("other").alias("path"))
        else:
            on = ways.select(F.col("node").alias("other"), F.col("path").alias("rest"))
            ways = n.join(on, "other").where(~F.array_contains("rest", F.col("node"))).select("node", F.concat(F.array("other"), "rest").alias("path"))
        # A node's ways are thinned where they are made, then together, so that one of many edges makes no large task.
        schema = ways.schema
        thin = lambda df: df.sortWithinPartitions("node", "path").mapInArrow(_first_paths(hops - h), schema)  # noqa: B023, E731
        ways = written(thin(thin(ways).repartition("node")), "ways")
    first = ways.groupBy("node").agg(F.min("path").alias("path"))
    found = starts.select(F.col("node").alias("start")).distinct().join(first, F.col("start") == F.col("node"))
    return found.select("start", F.concat(F.array("start"), "path").alias("path"))


def kmeans_blocks(points: DataFrame, k: int, rounds: int) -> DataFrame:
    """(id, block): Lloyd's rounds from k seeds, the points that come first by hash.

    An empty block starts anew at a point drawn by hashing with the round and the block. Only the k centres, a bounded
    number, travel between rounds, one job a round.
    """
    first = lambda n, of: [(r["x"], r["y"]) for r in points.select("x", "y", "id", F.xxhash64("id", F.lit(of)).alias("h")).orderBy("h", "id").limit(n).collect()]
    centres = first(k, 0)

    def nearest_centre(df: DataFrame) -> DataFrame:
        each = F.array(*[F.struct(((F.col("x") - x) ** 2 + (F.col("y") - y) ** 2).alias("d"), F.lit(i).alias("i")) for i, (x, y) in enumerate(centres)])
        return df.withColumn("block", F.array_min(each)["i"])

    for turn in range(rounds if centres else 0):
        means = {r["block"]: (r["x"], r["y"]) for r in nearest_centre(points).groupBy("block").agg(F.avg("x").alias("x"), F.avg("y").alias("y")).collect()}
        centres = [means.get(i) or first(1, 1 + turn * k + i)[0] for i in range(len(centres))]
    return nearest_centre(points).select("id", "block") if centres else points.select("id", F.lit(0).alias("block"))


def block_edges(edges: DataFrame, blocks: DataFrame) -> DataFrame:
    """(block, a, b): edges both of whose ends are in one block."""
    of = lambda k: blocks.select(F.col("id").alias(k), F.col("block").alias("b" + k))
    return edges.join(of("a"), "a").join(of("b"), "b").where("ba = bb").select(F.col("ba").alias("block"), "a", "b")


# --- rasters: sparse tables of cells (cx, cy) -------------------------------------------------------------------------------


def _offsets(cells: DataFrame, offsets: list[tuple[int, int]]) -> DataFrame:
    around = F.array(*[F.struct((F.col("cx") + i).alias("nx"), (F.col("cy") + j).alias("ny")) for i, j in offsets])
    return cells.select("*", F.inline(around))


def rasterise(triangles: DataFrame, size: float = 1.0) -> DataFrame:
    """Cells whose centre a triangle (x1, y1 to x3, y3) covers, borders included."""
    c = lambda f, k: F.floor(f(*[F.col(k + i) for i in "123"]) / size).cast("long")
    cells = triangles.withColumn("cx", F.explode(F.sequence(c(F.least, "x"), c(F.greatest, "x")))).withColumn("cy", F.explode(F.sequence(c(F.least, "y"), c(F.greatest, "y"))))
    px, py = (F.col("cx") + 0.5) * size, (F.col("cy") + 0.5) * size
    side = lambda a, b: (F.col("x" + b) - F.col("x" + a)) * (py - F.col("y" + a)) - (F.col("y" + b) - F.col("y" + a)) * (px - F.col("x" + a))
    s = [side("1", "2"), side("2", "3"), side("3", "1")]
    return cells.where((F.least(*s) >= 0) | (F.greatest(*s) <= 0)).select("cx", "cy").distinct()


def _distinct(*codes: np.ndarray) -> np.ndarray:
    """Codes sorted, each once; stable, as that sort merges what comes in sorted runs."""
    every = np.sort(np.concatenate(codes), kind="stable")
    return every[starts(every)]


def _dilated(width: int, height: int, times: int):
    def run(tx, ty, cx, cy):
        tiles = Tiles(times, tx, ty, cx, cy)
        codes = _distinct(tiles.codes)
        shifted = lambda c, step, n: _distinct(*[c + k * step for k in range(-n, n + 1)])
        if min(cx.min(), cy.min()) > times and cx.max() < width - 1 - times and cy.max() < height - 1 - times:
            codes = shifted(shifted(codes, tiles.side, times), 1, times)  # the grid's border is out of reach
            codes = codes[(codes >= 0) & (codes < tiles.end)]  # steps off a tile end in another's halo, or in no tile
        else:
            for _ in range(times):
                grown = shifted(shifted(codes, tiles.side, 1), 1, 1)
                lx, ly, gx, gy = tiles.places(grown)
                grown = grown[tiles.within(lx, ly, 0) & (gx >= 1) & (gx <= width - 2) & (gy >= 1) & (gy <= height - 2)]
                codes = _distinct(codes, grown)
        lx, ly, gx, gy = tiles.places(codes)
        core = tiles.within(lx, ly, times)
        yield {"cx": gx[core], "cy": gy[core]}

    return run


def dilate(cells: DataFrame, width: int, height: int, times: int = 2) -> DataFrame:
    """Cells (cx, cy) of a grid grown so many times by all eight neighbours; the grid's outermost cells stay as they are.

    Each tile grows with the cells around it, so that only those cells travel that were there before.
    """
    here = cells.select(F.col("cx").cast("long"), F.col("cy").cast("long"))
    return in_tiles(here, times, _dilated(width, height, times), "cx long, cy long")


#: Farther than any cell.
_FAR = 1 << 40


def _runs(line: np.ndarray, place: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """(first, last, steps) of cells sorted by line and place: the indices of their run's ends and the steps out of it.

    A run that ends with the grid has no end there.
    """
    new = starts(line)
    new[1:] |= place[1:] != place[:-1] + 1
    first = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    last = np.append(first[1:], len(place)) - 1
    first, last = first[run], last[run]
    before = np.where(place[first] == 0, _FAR, place - place[first] + 1)
    after = np.where(place[last] == size - 1, _FAR, place[last] - place + 1)
    return first, last, np.minimum(before, after)


def _rowwise(width: int):
    def run(cx, cy):
        yield {"cx": cx, "cy": cy, "r": _runs(cy, cx, width)[2]}

    return run


def _distances(width: int, height: int):
    """For cells with the steps out of their row's run: the largest square around each that is full, bisected."""

    def run(cx, cy, r):
        first, last, most = _runs(cx, cy, height)
        most = np.minimum(most, r)
        i = np.flatnonzero(most > 1)
        free = np.zeros(len(cx), np.int64)
        least = [r]  # of each power of two of cells from a cell on
        longest = int((last[i] - first[i]).max(initial=0)) + 1
        while 1 << len(least) <= longest:
            half, below = 1 << (len(least) - 1), least[-1]
            least.append(np.concatenate([np.minimum(below[:-half], below[half:]), below[-half:]]))
        for bit in reversed(range(max(width, height).bit_length() if len(i) else 0)):
            tried = free[i] + (1 << bit)
            low, high = np.maximum(first[i], i - tried), np.minimum(last[i], i + tried)
            level = np.frexp(high - low + 1)[1] - 1
            held = np.empty(len(i), np.int64)
            for k in np.unique(level):
                at = level == k
                held[at] = np.minimum(least[k][low[at]], least[k][high[at] + 1 - (1 << int(k))])
            free[i] = np.where((tried < most[i]) & (held > tried), tried, free[i])
        none = free >= max(width, height)
        yield {"cx": cx, "cy": cy, "dist": pa.array((free + 1).astype(np.int32), mask=none)}

    return run


def distance_transform(cells: DataFrame, width: int, height: int) -> DataFrame:
    """(cx, cy, dist): steps over eight neighbours to the nearest empty cell of the grid; what is outside counts as nothing.

    A cell is more than r steps away from any if so are, within their rows, all cells at most r above and below it. So rows
    tell each cell's steps out of its run, and columns bisect r; nothing is made of the empty cells. dist is null where the
    grid has no empty cell at all.
    """
    here = cells.where(F.col("cx").between(0, width - 1) & F.col("cy").between(0, height - 1)).select(F.col("cx").cast("long"), F.col("cy").cast("long")).distinct()
    rows = by_blocks(here, ["cy"], ["cx"], _rowwise(width), "cx long, cy long, r long")
    return by_blocks(rows, ["cx"], ["cy"], _distances(width, height), "cx long, cy long, dist int")


def _ridges(width: int, height: int):
    def run(tx, ty, cx, cy, dist):
        tiles = Tiles(1, tx, ty, cx, cy)
        order = np.argsort(tiles.codes, kind="stable")
        codes, dist = tiles.codes[order], np.nan_to_num(dist[order].astype(float), nan=-1.0)
        lx, ly, gx, gy = tiles.places(codes)
        open_ = np.flatnonzero(tiles.within(lx, ly, 1) & (gx >= 1) & (gx <= width - 2) & (gy >= 1) & (gy <= height - 2))
        top = np.full(len(open_), -1.0)
        for i, j in EIGHT:
            other = codes[open_] + i * tiles.side + j
            at = np.minimum(np.searchsorted(codes, other), len(codes) - 1)
            top = np.maximum(top, np.where(codes[at] == other, dist[at], -1.0))
        ridge = open_[(top < 0) | ((top <= dist[open_]) & (dist[open_] >= 0))]
        yield {"cx": gx[ridge], "cy": gy[ridge]}

    return run


def ridges(distances: DataFrame, width: int, height: int) -> DataFrame:
    """Cells inside the grid's border without a neighbour that is farther from an empty cell. distances: one row a cell."""
    rows = distances.select(F.col("cx").cast("long"), F.col("cy").cast("long"), "dist")
    return in_tiles(rows, 1, _ridges(width, height), "cx long, cy long")


def pixel_graph(cells: DataFrame) -> DataFrame:
    """Undirected edges (ax, ay, bx, by) between neighbouring cells, each once."""
    here = cells.select(F.col("cx").alias("nx"), F.col("cy").alias("ny"))
    half = [(1, 0), (0, 1), (1, 1), (1, -1)]
    return _offsets(cells.select("cx", "cy"), half).join(here, ["nx", "ny"]).select(F.col("cx").alias("ax"), F.col("cy").alias("ay"), F.col("nx").alias("bx"), F.col("ny").alias("by"))
