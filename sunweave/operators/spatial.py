"""Joins by place and by range, through equalities on cells and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunweave.sources.shared import written


def within(left: DataFrame, right: DataFrame, radius: float, x: str = "x", y: str = "y") -> DataFrame:
    """Pairs with right's point at most radius from left's (inclusive), right's place as r_x and r_y.

    Both sides are hashed to square cells of the radius's size; the right side, meant to be the smaller, enters its own
    and the eight cells around it, so that the pairs meet by equality and are tested exactly then. They meet sorted: Spark
    takes the nine rows for one in its estimate and would send a side to the driver that is nine times as large.
    """
    cell = lambda c: F.floor(c / radius).cast("long")
    around = F.array(*[F.struct((cell(F.col(x)) + i).alias("_cx"), (cell(F.col(y)) + j).alias("_cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    r = right.select(*[F.col(c).alias("r_x" if c == x else "r_y" if c == y else c) for c in right.columns], F.inline(around))
    pairs = left.withColumn("_cx", cell(F.col(x))).withColumn("_cy", cell(F.col(y))).join(r.hint("merge"), ["_cx", "_cy"])
    dx, dy = F.col(x) - F.col("r_x"), F.col(y) - F.col("r_y")
    return pairs.where(dx * dx + dy * dy <= radius * radius).drop("_cx", "_cy")


def nearest(points: DataFrame, px: float, py: float, k: int, key: str = "id") -> DataFrame:
    """The k points nearest to a place, ties by key: a top-k report, of which each task sends k rows at most."""
    d = F.sqrt((F.col("x") - px) * (F.col("x") - px) + (F.col("y") - py) * (F.col("y") - py))
    return points.withColumn("dist", F.round(d, 6)).orderBy("dist", key).limit(k)


def around(points: DataFrame, px: float, py: float, radius: float) -> DataFrame:
    """Points at most radius from a place on the plane; the square around it reaches the scan's statistics."""
    near = points.where(F.col("x").between(px - radius, px + radius) & F.col("y").between(py - radius, py + radius))
    return near.where((F.col("x") - px) * (F.col("x") - px) + (F.col("y") - py) * (F.col("y") - py) <= radius * radius)


def connectors(ends: DataFrame, waypoints: DataFrame, radius: float = 250.0) -> DataFrame:
    """(a, b): each end (id, x, y, z) with its nearest waypoint in space, ties to the smallest id; none without waypoints.

    The search goes on with twice the radius for ends that had no waypoint within it.
    """
    left, found = written(ends.select("id", "x", "y", "z"), "ends"), None
    if waypoints.isEmpty():
        return ends.select(F.col("id").alias("a"), F.lit(None).alias("b")).limit(0)
    w = waypoints.select(F.col("id").alias("b"), "x", "y", F.col("z").alias("r_z"))
    while not left.isEmpty():
        dist = F.sqrt((F.col("x") - F.col("r_x")) ** 2 + (F.col("y") - F.col("r_y")) ** 2 + (F.col("z") - F.col("r_z")) ** 2)
        pairs = within(left, w, radius).withColumn("d", dist)
        best = pairs.groupBy("id").agg(F.min(F.struct("d", "b")).alias("m"))
        # A waypoint farther than radius in space may not be the nearest yet.
        best = written(best.where(F.col("m.d") <= radius).select(F.col("id").alias("a"), F.col("m.b").alias("b")), "connectors")
        found = best if found is None else written(found.unionByName(best), "connectors")
        left = written(left.join(best.select(F.col("a").alias("id")), "id", "left_anti"), "ends")
        radius *= 2
    return found if found is not None else ends.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)


def edge_between(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """pairs (a, b) with the columns of the edge between both, whichever way either names its ends; without one they go."""
    rest = [c for c in edges.columns if c not in ("a", "b")]
    keyed = edges.select(F.least("a", "b").alias("_u"), F.greatest("a", "b").alias("_v"), *rest).dropDuplicates(["_u", "_v"])
    return pairs.join(keyed, (F.least("a", "b") == F.col("_u")) & (F.greatest("a", "b") == F.col("_v"))).drop("_u", "_v")


def range_windows(rows: DataFrame, starts: DataFrame, rank: str, start: str, length: int) -> DataFrame:
    """Joins each start with the rows of ranks [start, start + length): a range join by listing its ranks."""
    each = starts.withColumn(rank, F.explode(F.sequence(F.col(start), F.col(start) + length - 1)))
    return each.join(rows, rank)


def undirected(a: Column, b: Column) -> Column:
    return F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def edge_set(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct undirected edges without self-loops, as (a, b) with a < b."""
    return edges.where(F.col(a) != F.col(b)).select(undirected(F.col(a), F.col(b)).alias("e")).distinct().select("e.*")


def neighbours(edges: DataFrame) -> DataFrame:
    """Both directions of undirected (a, b) edges, as (node, other)."""
    return edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
