"""Samples in the shadow of casters, by tiles: a task has a tile's samples and all casters that may shade them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunweave.functions import solar
from sunweave.sources.shared import written

#: Samples of a group at most, about as many of a tile at least, bits of a group, steps to a row of bits, pairs tested at once,
#: casters of a first round.
SAMPLES, GROUP, BITS, STEPS, PAIRS, FIRST = 1 << 16, 1 << 9, 1 << 28, 1 << 9, 1 << 18, 1 << 11


def boxes_hit(x, y, z, dx, dy, rise, reach, x1, y1, x2, y2, top):
    """Slab test of the level ray; the box shades where the ray is still below its top when it enters."""

    def span(p, d, lo, hi):
        if abs(d) < 1e-12:
            inside = (p >= lo) & (p <= hi)
            return np.where(inside, 0.0, 1e18), np.where(inside, 1e18, -1e18)
        a, b = (lo - p) / d, (hi - p) / d
        return np.minimum(a, b), np.maximum(a, b)

    (ex, fx), (ey, fy) = span(x, dx, x1, x2), span(y, dy, y1, y2)
    enter = np.maximum(np.maximum(ex, ey), 0.0)
    return (enter <= np.minimum(fx, fy)) & (enter <= reach) & (z + enter * rise < top)


def triangles_hit(x, y, z, dx, dy, rise, reach, *corners):
    """Where the ray meets the plane at a distance from 0 to reach, with no negative barycentric coordinate."""
    v = lambda a, b: tuple(p - q for p, q in zip(a, b, strict=True))
    cross = lambda a, b: (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])
    dot = lambda a, b: a[0] * b[0] + a[1] * b[1] + a[2] * b[2]
    one, two, three = corners[0:3], corners[3:6], corners[6:9]
    way, (e1, e2, s) = (dx, dy, rise), (v(two, one), v(three, one), v((x, y, z), one))
    p, q = cross(way, e2), cross(s, e1)
    det = dot(e1, p)
    meets = np.abs(det) > 1e-12
    det = np.where(meets, det, 1.0)
    a, b, t = dot(s, p) / det, dot(way, q) / det, dot(e2, q) / det
    return meets & (a >= 0) & (b >= 0) & (a + b <= 1) & (t >= 0) & (t <= reach)


def _pairs(key: np.ndarray, order: np.ndarray, casters: np.ndarray, lines: tuple, u: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, casters) that share a line, with the place between the caster's bounds along it; some PAIRS at once.

    Keys are the lines, span apart, and the way along them.
    """
    (first, last, span), (u1, u2) = lines, u
    n = last - first + 1
    which = np.repeat(np.arange(len(casters)), n)
    line = (np.arange(len(which)) - np.repeat(np.cumsum(n) - n - first, n)) * span
    lo = np.searchsorted(key, line + np.clip(u1, -0.5, span - 0.5)[which])
    count = np.searchsorted(key, line + np.clip(u2, -0.5, span - 0.5)[which], "right") - lo
    some = np.flatnonzero(count > 0)
    which, lo, count = which[some], lo[some], count[some]
    ends = np.cumsum(count)
    cuts = np.searchsorted(ends, np.arange(PAIRS, ends[-1], PAIRS)) if len(ends) else []
    for a, b in zip([0, *cuts], [*cuts, len(ends)], strict=True):
        if a < b:
            c = count[a:b]
            at = np.arange(c.sum()) + np.repeat(lo[a:b] - (np.cumsum(c) - c), c)
            yield order[at], casters[np.repeat(which[a:b], c)]


def shaded(places: list[np.ndarray], casters: list[np.ndarray], outline: list[tuple], top: np.ndarray, suns: np.ndarray, reach: float, hit: Callable) -> np.ndarray:
    """Whether a caster shades a place, a row for each place and a column for each sun (dx, dy, rise).

    Along a sun's direction, only casters with a corner on both sides of a place's line, or on it, can shade it, from their
    far end back to where the ray has risen above their top. Casters come highest first, and places leave once shaded.
    """
    x, y, z = places
    out = np.zeros((len(x), len(suns)), bool)
    if not len(x) or not len(top):
        return out
    by_height = np.argsort(-top, kind="stable")
    eps = 1e-6 + 1e-12 * max(np.abs(c).max() for c in (x, y, *(c for corner in outline for c in corner)))
    for k, (dx, dy, rise) in enumerate(suns):
        if not np.isfinite(dx + dy + rise):
            continue
        along, across = (lambda px, py: px * dx + py * dy), (lambda px, py: py * dx - px * dy)  # noqa: B023
        u, v = along(x, y), across(x, y)
        cu, cv = [along(*c) for c in outline], [across(*c) for c in outline]
        far = np.minimum(reach, (top - z.min()) / rise) if rise > 0 else np.full(len(top), reach)
        u1, u2 = np.minimum.reduce(cu) - far * (1 + 1e-9) - eps, np.maximum.reduce(cu) + eps
        v1, v2 = np.minimum.reduce(cv) - eps, np.maximum.reduce(cv) + eps
        near = (far >= -eps) & (u2 >= u.min()) & (u1 <= u.max()) & (v2 >= v.min()) & (v1 <= v.max())
        near = by_height[near[by_height]]
        if not len(near):
            continue
        wide = max((v2[near] - v1[near]).mean(), (v.max() - v.min()) / len(v))
        line = lambda w: np.floor((w - v.min()) / wide).astype(np.int64)  # noqa: B023, E731
        most, span = line(v).max(), u.max() - u.min() + 1
        key = line(v) * span + (u - u.min())
        order = np.argsort(key)
        key, dark, start, size = key[order], np.zeros(len(x), bool), 0, FIRST
        while start < len(near) and len(order):
            c = near[start : start + size]
            lines = np.clip(line(v1[c]), 0, most), np.clip(line(v2[c]), 0, most), span
            for at, by in _pairs(key, order, c, lines, (u1[c] - u.min(), u2[c] - u.min())):
                ok = ~dark[at] & (v[at] >= v1[by]) & (v[at] <= v2[by])
                at, by = at[ok], by[ok]
                dark[at[hit(x[at], y[at], z[at], dx, dy, rise, reach, *(f[by] for f in casters))]] = True
            lit = ~dark[order]
            key, order, start, size = key[lit], order[lit], start + size, 2 * size
        out[:, k] = dark
    return out


def _bits(samples: pa.Table, casters: pa.Table, names: list[str], outline: list[tuple[str, str]], suns: np.ndarray, reach: float, hit: Callable) -> pa.Table:
    """(sample_point_id, chunk, bits): for each sample and STEPS suns the words of bits of those it is shaded from."""
    column = lambda t, n: t.column(n).to_numpy().astype(np.float64)
    xyz = np.stack([column(samples, n) for n in ("x", "y", "z")], axis=1)
    known = np.isfinite(xyz).all(axis=1)
    places, place = np.unique(xyz[known], axis=0, return_inverse=True)
    c = {n: column(casters, n) for n in {*names, "top"}}
    parts = []
    for chunk in range(max(1, ceil(len(suns) / STEPS))):
        of = suns[chunk * STEPS : (chunk + 1) * STEPS]
        dark = shaded([np.ascontiguousarray(p) for p in places.T], [c[n] for n in names], [(c[p], c[q]) for p, q in outline], c["top"], of, reach, hit)
        words = max(1, ceil(len(of) / 64))
        packed = np.zeros((len(places), words * 8), np.uint8)
        packed[:, : ceil(len(of) / 8)] = np.packbits(dark, axis=1, bitorder="little")
        bits = np.zeros((len(xyz), words), np.int64)
        bits[known] = packed.view("<i8")[place.ravel()]
        lists = pa.ListArray.from_arrays(np.arange(len(xyz) + 1, dtype=np.int32) * words, bits.ravel())
        parts.append(pa.Table.from_arrays([samples.column("sample_point_id"), pa.array(np.full(len(xyz), chunk, np.int32)), lists], names=["sample_point_id", "chunk", "bits"]))
    return pa.concat_tables(parts)


def _suns(sun: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """The steps with their chunk, word and bit, and the live ones' (dx, dy, rise): a few, whatever the data."""
    a = F.radians("azimuth")
    way = [F.sin(a).alias("dx"), F.cos(a).alias("dy"), F.tan(F.radians("elevation")).alias("rise")]
    df = sun.select("datetime", solar.below_guard(F.col("elevation")).alias("dark"), *way)
    steps = df.toArrow()
    live = np.array([d is False for d in steps.column("dark").to_pylist()], bool)
    suns = np.stack([steps.column(n).to_numpy().astype(np.float64)[live] for n in ("dx", "dy", "rise")], axis=1)
    at = np.cumsum(live) - 1
    places = [(np.where(live, at // STEPS, 0), None), (at % STEPS // 64, ~live), (at % 64, ~live)]
    rows = pa.Table.from_arrays([steps.column("datetime"), steps.column("dark"), *(pa.array(p.astype(np.int32), mask=m) for p, m in places)], names=["datetime", "dark", "chunk", "word", "bit"])
    schema = T.StructType([*df.schema.fields[:2], *(T.StructField(n, T.IntegerType()) for n in ("chunk", "word", "bit"))])
    return sun.sparkSession.createDataFrame(rows, schema), suns


def shadow_facts(samples: DataFrame, sun: DataFrame, casters: DataFrame, outline: list[tuple[str, str]], top: Column, cell: float, reach: float, hit: Callable) -> DataFrame:
    """Facts (sample_point_id, datetime, is_sunlit), lit where no caster's test (hit) says that it shades the sample.

    samples: (sample_point_id, x, y, z), z where the ray starts; casters: the columns that hit takes, with their corners on the
    plane (outline) and their top. Tiles are some cells wide, as wide as the longest shadow at least and wider where samples
    are few; a caster enters those its shadows can reach. A tile with many samples is dealt to several groups, each of which has all of its casters.
    """
    spark, names = samples.sparkSession, casters.columns
    steps, suns = _suns(sun)
    samples = written(samples.select("sample_point_id", "x", "y", "z"), "samples")
    casters = casters.withColumn("top", top).na.drop().distinct()
    has = samples.na.drop(subset=["x", "y", "z"]).agg(F.count("*").alias("n"), F.min("z").alias("z"), *(f(c).alias(f"{c}{i}") for c in "xy" for i, f in ((1, F.min), (2, F.max)))).first()
    highest = casters.agg(F.max("top")).first()[0]
    rise = min((r for r in suns[:, 2] if np.isfinite(r)), default=0.0)
    far = min(reach, max(0.0, (highest - has["z"]) / rise)) if rise > 0 and None not in (highest, has["z"]) else reach
    sparse = ((has["x2"] - has["x1"]) * (has["y2"] - has["y1"]) * GROUP / has["n"]) ** 0.5 if has["n"] else 0.0
    tile = cell * max(1, ceil(max(far, sparse) / cell))
    in_tile = lambda c: F.floor(c / tile).cast("long")
    samples = samples.select("*", *(F.coalesce(in_tile(F.col(c)), F.lit(0)).alias(f"t{c}") for c in "xy"))
    if None in (highest, has["z"]) or not len(suns):
        entered = casters.limit(0).select("*", F.lit(0).cast("long").alias("tx"), F.lit(0).cast("long").alias("ty"))
    else:
        halo = (F.least(F.lit(float(reach)), (F.col("top") - has["z"]) / rise) if rise > 0 else F.lit(float(reach))) * (1 + 1e-9) + 1e-3
        entered = casters.where(F.col("top") >= has["z"])
        for i, c in enumerate("xy"):
            ends = [F.col(corner[i]) for corner in outline]
            one, two = F.greatest(in_tile(F.least(*ends) - halo), in_tile(F.lit(has[f"{c}1"]))), F.least(in_tile(F.greatest(*ends) + halo), in_tile(F.lit(has[f"{c}2"])))
            entered = entered.where(one <= two).withColumn(f"t{c}", F.explode(F.sequence(one, two)))
    rows = max(1, min(SAMPLES, BITS // max(1, len(suns))))
    large = samples.groupBy("tx", "ty").agg(F.count("*").alias("n")).where(F.col("n") > rows)
    large = F.broadcast(written(large.select("tx", "ty", F.ceil(F.col("n") / (rows / 2)).alias("parts")), "large"))
    parts = F.coalesce("parts", F.lit(1).cast("long"))
    left = samples.join(large, ["tx", "ty"], "left").withColumn("part", F.pmod(F.xxhash64("sample_point_id", "x", "y", "z"), parts)).drop("parts")
    right = entered.join(large, ["tx", "ty"], "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
    keys, n = ["tx", "ty", "part"], int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(points: pa.Table, near: pa.Table) -> pa.Table:
        return _bits(points, near, names, outline, suns, reach, hit)

    schema = T.StructType([samples.schema["sample_point_id"], T.StructField("chunk", T.IntegerType()), T.StructField("bits", T.ArrayType(T.LongType()))])
    # By number, as tasks are long for the little they read.
    bits = left.repartition(n, *keys).groupBy(*keys).cogroup(right.repartition(n, *keys).groupBy(*keys)).applyInArrow(run, schema)
    out = bits.join(F.broadcast(steps), "chunk")
    return out.select("sample_point_id", "datetime", (~F.col("dark") & (F.getbit(F.col("bits")[F.col("word")], F.col("bit")) == 0)).alias("is_sunlit"))
