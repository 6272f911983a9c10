import math
import random

import numpy as np
from pyspark.sql import functions as F

from sunweave.operators import exposure, rays

SUN = "datetime int, azimuth double, elevation double"


def _suns(rng, n):
    return [(k, rng.uniform(0, 360), rng.uniform(6, 80)) for k in range(n)] + [(100, 90.0, 20.0), (101, 180.0, 8.0), (102, 0.0, 3.0), (103, 90.0, None), (104, None, 30.0)]


def _woods(seed, n, m, side):
    rng = random.Random(seed)
    places = [np.array([rng.uniform(0, side) for _ in range(n)]), np.array([rng.uniform(0, side) for _ in range(n)]), np.full(n, 3.0)]
    x, y, top = (np.array([rng.uniform(a, b) for _ in range(m)]) for a, b in ((0, side), (0, side), (1, 60)))
    a, e = np.radians([rng.uniform(0, 360) for _ in range(12)] + [90, 180]), np.radians([rng.uniform(6, 80) for _ in range(12)] + [6, 45])
    return places, x, y, top, np.stack([np.sin(a), np.cos(a), np.tan(e)], axis=1)


def _few_pairs(monkeypatch, places, casters, outline, top, suns, hit):
    """The shadows of all pairs, of which far fewer are tested."""
    monkeypatch.setattr(rays, "PAIRS", 500)
    monkeypatch.setattr(rays, "FIRST", 16)
    tested = []
    counted = lambda x, *rest: tested.append(len(x)) or hit(x, *rest)
    got = rays.shaded(places, casters, outline, top, suns, 700.0, counted)
    every = [hit(*(p[:, None] for p in places), *s, 700.0, *(c[None, :] for c in casters)) for s in suns]
    assert (got == np.stack([e.any(axis=1) for e in every], axis=1)).all() and 0 < got.mean() < 1
    assert sum(tested) < 2 * sum(e.sum() for e in every) + got.size and max(tested) <= 500 + len(top)


def test_boxes_are_tested_on_few_pairs(monkeypatch):
    places, x, y, top, suns = _woods(1, 400, 600, 1000.0)
    casters = [x, y, x + 20, y + 20, top]
    _few_pairs(monkeypatch, places, casters, [(casters[i], casters[j]) for i in (0, 2) for j in (1, 3)], top, suns, rays.boxes_hit)


def test_box_shadows_by_tiles(spark, monkeypatch):
    monkeypatch.setattr(rays, "SAMPLES", 20)
    monkeypatch.setattr(rays, "GROUP", 1)
    rng = random.Random(2)
    suns = _suns(rng, 8)
    samples = [(i, rng.uniform(0, 900), rng.uniform(-300, 100), float(i % 3)) for i in range(150)] + [(900, None, 5.0, 0.0), (901, 5.0, 5.0, None)]
    boxes = [(x, y, x + rng.uniform(5, 90), y + rng.uniform(5, 30), rng.uniform(-5, 60)) for x, y in ((rng.uniform(-50, 900), rng.uniform(-350, 100)) for _ in range(80))]
    boxes += [(*boxes[0][:4], 1.0), (None, 0.0, 9.0, 9.0, 50.0), (0.0, 0.0, 900.0, 100.0, None)]
    facts = exposure.occluded_facts(spark.createDataFrame(samples, "sample_point_id int, x double, y double, z double"), spark.createDataFrame(suns, SUN), spark.createDataFrame(boxes, "x1 double, y1 double, x2 double, y2 double, top double"), cell=100.0, reach=250.0)
    assert "[cx" not in facts._jdf.queryExecution().executedPlan().toString()

    def lit(s, azimuth, elevation):
        if elevation is None or elevation <= 5:
            return None if elevation is None else False
        if None in (azimuth, *s):
            return True
        for b in boxes:
            if None in b:
                continue
            t0, t1 = 0.0, 250.0
            for p, d, lo, hi in ((s[1], math.sin(math.radians(azimuth)), b[0], b[2]), (s[2], math.cos(math.radians(azimuth)), b[1], b[3])):
                if abs(d) < 1e-12:
                    t0 = t0 if lo <= p <= hi else math.inf
                else:
                    t0, t1 = max(t0, min((lo - p) / d, (hi - p) / d)), min(t1, max((lo - p) / d, (hi - p) / d))
            if t0 <= t1 and s[3] + 3 + t0 * math.tan(math.radians(elevation)) < b[4]:
                return False
        return True

    want = {(s[0], k): lit(s, a, e) for s in samples for k, a, e in suns}
    rows = facts.collect()
    assert {(r.sample_point_id, r.datetime): r.is_sunlit for r in rows} == want and len(rows) == len(want)
    assert 0.1 < sum(v is False for v in want.values()) / len(want) < 0.9


def test_shadows_of_nothing(spark):
    samples = spark.range(3).select(F.col("id").alias("sample_point_id"), *(F.lit(0.0).alias(c) for c in "xyz"))
    boxes = spark.createDataFrame([(-5.0, -5.0, 5.0, 5.0, 50.0)], "x1 double, y1 double, x2 double, y2 double, top double")
    sun = spark.createDataFrame([(1, 90.0, 45.0), (2, 90.0, 3.0)], SUN)
    rows = lambda *a: sorted(tuple(r) for r in exposure.occluded_facts(*a).collect())
    assert rows(samples, sun, boxes.limit(0)) == [(i, k, k == 1) for i in range(3) for k in (1, 2)]
    assert rows(samples, sun, boxes) == [(i, k, False) for i in range(3) for k in (1, 2)]
    assert rows(samples, sun.where("datetime = 2"), boxes) == [(i, 2, False) for i in range(3)]
    assert rows(samples.limit(0), sun, boxes) == rows(samples, sun.limit(0), boxes) == []
    many = spark.range(1100).select(F.col("id").cast("int").alias("datetime"), F.lit(90.0).alias("azimuth"), (F.col("id") * 0.06 + 6).alias("elevation"))
    box = boxes.select(F.lit(10.0).alias("x1"), "y1", F.lit(20.0).alias("x2"), "y2", F.lit(13.0).alias("top"))
    assert rows(samples, many, box) == [(i, k, 3 + 10 * math.tan(math.radians(k * 0.06 + 6)) >= 13) for i in range(3) for k in range(1100)]


def test_triangles_are_tested_on_few_pairs(monkeypatch):
    places, x, y, top, suns = _woods(3, 400, 600, 1000.0)
    low = np.zeros_like(x)
    casters = [x, y, low, x + 20, y + 20, low, x + 20, y + 5, top]
    _few_pairs(monkeypatch, places, casters, [(casters[i], casters[i + 1]) for i in (0, 3, 6)], top, suns, rays.triangles_hit)


def test_mesh_rays_meet_no_join(spark):
    sample = spark.createDataFrame([(i, 10.0 * i, 0.0, 0.0) for i in range(60)], "sample_point_id int, x double, y double, z double")
    wall = [(v, -5.0, 0.0, v, 5.0, 0.0, v, 0.0, 30.0) for v in (105.0, 405.0)]
    mesh = spark.createDataFrame([*wall, wall[0], (None, *wall[0][1:])], ", ".join(f"{c}{i} double" for i in "123" for c in "xyz"))
    facts = exposure.mesh_facts(sample, spark.createDataFrame([(1, 90.0, 45.0), (2, 270.0, 45.0), (3, 0.0, 45.0)], SUN), mesh, cell=50.0)
    assert "[cx" not in facts._jdf.queryExecution().executedPlan().toString()
    dark = {(i, k) for i in range(60) for w in (105, 405) for k, d in ((1, w - 10 * i), (2, 10 * i - w)) if 0 <= d <= 27}
    assert {(r.sample_point_id, r.datetime) for r in facts.where("NOT is_sunlit").collect()} == dark and facts.count() == 180
