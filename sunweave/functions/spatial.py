"""Plane geometry, the section lattice and the Hilbert curve, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LATTICE = 128


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def in_box(x: Column, y: Column, x1: float, y1: float, x2: float, y2: float) -> Column:
    """Inclusive at all sides; as ranges on stored columns these reach the scan's statistics."""
    return x.between(min(x1, x2), max(x1, x2)) & y.between(min(y1, y2), max(y1, y2))


def section_id(x: Column, y: Column, origin_x: float, origin_y: float, size: float) -> Column:
    return (F.floor((y - origin_y) / size) * LATTICE + F.floor((x - origin_x) / size)).cast("int")


def section_column(section: Column) -> Column:
    return section % LATTICE


def section_row(section: Column) -> Column:
    return F.floor(section / LATTICE).cast("int")


def hilbert_index(x: Column, y: Column, order: int = 7) -> Column:
    """The place of a lattice cell along the Hilbert curve, by folding the bits of both coordinates from the highest."""
    n = 1 << order
    bad = (x < 0) | (y < 0) | (x >= n) | (y >= n)
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d"))

    def fold(acc: Column, bit: Column) -> Column:
        s = F.pow(F.lit(2.0), bit).cast("long")
        rx = F.when(acc["x"].bitwiseAND(s) > 0, F.lit(1)).otherwise(0).cast("long")
        ry = F.when(acc["y"].bitwiseAND(s) > 0, F.lit(1)).otherwise(0).cast("long")
        d = acc["d"] + s * s * (3 * rx).bitwiseXOR(ry)
        flip = (ry == 0) & (rx == 1)
        fx, fy = F.when(flip, s - 1 - acc["x"]).otherwise(acc["x"]), F.when(flip, s - 1 - acc["y"]).otherwise(acc["y"])
        return F.struct(F.when(ry == 0, fy).otherwise(fx).alias("x"), F.when(ry == 0, fx).otherwise(fy).alias("y"), d.alias("d"))

    bits = F.array(*[F.lit(b) for b in range(order - 1, -1, -1)])
    return F.when(bad, F.raise_error(F.lit("cell outside the lattice")).cast("long")).otherwise(F.aggregate(bits, start, fold, lambda acc: acc["d"]))


def turn_degrees(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    """The angle at b between the ways to a and to c; 180 is straight on."""
    ux, uy, vx, vy = ax - bx, ay - by, cx - bx, cy - by
    cosine = (ux * vx + uy * vy) / F.nullif(F.sqrt(ux * ux + uy * uy) * F.sqrt(vx * vx + vy * vy), F.lit(0.0))
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))))


def turn_degrees_3d(a: list[Column], b: list[Column], c: list[Column]) -> Column:
    """The angle at b between the ways to a and to c in space; 180 is straight on. Each is a list of coordinates."""
    u, v = ([p - q for p, q in zip(x, b, strict=True)] for x in (a, c))
    dot = lambda p, q: sum((i * j for i, j in zip(p, q, strict=True)), F.lit(0.0))
    cosine = dot(u, v) / F.nullif(F.sqrt(dot(u, u)) * F.sqrt(dot(v, v)), F.lit(0.0))
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))))


def distance_3d(a: list[Column], b: list[Column]) -> Column:
    return F.sqrt(sum(((p - q) ** 2 for p, q in zip(a, b, strict=True)), F.lit(0.0)))


def in_box_3d(x: Column, y: Column, z: Column, one: tuple[float, float, float], two: tuple[float, float, float], pad: float = 0.0) -> Column:
    """Inside the box that two corners span, widened by pad at all sides, borders included."""
    between = [c.between(min(p, q) - pad, max(p, q) + pad) for c, p, q in zip((x, y, z), one, two, strict=True)]
    return between[0] & between[1] & between[2]


def lerp(a: Column, b: Column, t: Column) -> Column:
    return a + (b - a) * t


def in_triangle(px: Column, py: Column, corners: list[tuple[Column, Column]]) -> Column:
    """Whether a place has no negative barycentric coordinate in a triangle, whichever way round its corners go."""
    side = lambda p, q: (q[0] - p[0]) * (py - p[1]) - (q[1] - p[1]) * (px - p[0])
    s = [side(corners[i], corners[(i + 1) % 3]) for i in range(3)]
    return (F.least(*s) >= 0) | (F.greatest(*s) <= 0)


def section_centre(section: Column, origin_x: float, origin_y: float, size: float) -> Column:
    """struct(x, y) of the middle of a section."""
    return F.struct((origin_x + (section_column(section) + 0.5) * size).alias("x"), (origin_y + (section_row(section) + 0.5) * size).alias("y"))


def section_bounds(section: Column, origin_x: float, origin_y: float, size: float, halo: float = 0.0) -> Column:
    """struct(x1, y1, x2, y2) of a section, widened by a halo."""
    x, y = origin_x + section_column(section) * size, origin_y + section_row(section) * size
    return F.struct((x - halo).alias("x1"), (y - halo).alias("y1"), (x + size + halo).alias("x2"), (y + size + halo).alias("y2"))
