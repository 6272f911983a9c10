"""The fact table of lit and shaded samples: building, rolling up, walking, correcting, packing."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from sunweave.functions.spatial import in_box
from sunweave.functions.timegrid import snap_timestep, window_index
from sunweave.operators import analytics, rays

RUN = ("request_id",)


def edge_rollup(facts: DataFrame, keys: tuple[str, ...] = ("section_id", "edge_id", "datetime")) -> DataFrame:
    """Lit and all samples of each edge and step. A section owns whole edges, so that one exchange at most is needed."""
    return facts.groupBy(*keys).agg(F.count_if("is_sunlit").alias("sunlit_sum"), F.count("*").alias("sample_count"))


def rollup_sections(facts: DataFrame, points: DataFrame, sections: list[int] | None = None) -> DataFrame:
    """The rollup of stored facts (section_id, sample_point_id, datetime, is_sunlit), which get their edge from the points.

    Named sections become a predicate on the facts, which prunes whole leaves; sections no point belongs to raise.
    """
    if sections is not None:
        known = {r["section_id"] for r in points.where(F.col("section_id").isin(sections)).select("section_id").distinct().collect()}
        if missing := sorted(set(sections) - known):
            raise ValueError(f"sections without samples: {missing}")
        facts = facts.where(F.col("section_id").isin(sections))
    edges = points.select("sample_point_id", "edge_id")
    return edge_rollup(facts.select("section_id", "sample_point_id", "datetime", "is_sunlit").join(edges, "sample_point_id"))


def observed_rollup(facts: DataFrame, points: DataFrame, sections: list[int] | None = None) -> tuple[DataFrame, Observation]:
    """The rollup and, once it has been written, its counts of edges' steps and samples, without another pass."""
    seen = Observation("rollup")
    out = rollup_sections(facts, points, sections)
    return out.observe(seen, F.count("*").alias("edge_steps"), F.sum("sample_count").alias("samples"), F.sum("sunlit_sum").alias("sunlit")), seen


def plain_facts(facts: DataFrame) -> DataFrame:
    """The facts as three columns, whatever they are stored with."""
    return facts.select("sample_point_id", "datetime", "is_sunlit")


def plain_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.select("edge_id", "datetime", "sunlit_sum")


def without_tree_values(points: DataFrame) -> DataFrame:
    """Samples or edges with their shade of trees reset."""
    names = [c for c in ("tree_value", "total_tree_value") if c in points.columns]
    return points.withColumns({c: F.lit(0.0) for c in names})


def require_known_edges(requests: DataFrame, points: DataFrame) -> None:
    """Raises for requests of edges without samples."""
    unknown = requests.join(points.select("edge_id").distinct(), "edge_id", "left_anti").select("edge_id").limit(5).collect()
    if unknown:
        raise ValueError(f"edges without samples, such as {[r['edge_id'] for r in unknown]}")


def samples_per_edge(points: DataFrame) -> DataFrame:
    return points.groupBy("edge_id").agg(F.count("*").alias("sample_count"))


def append_missing(rollup: DataFrame, existing: DataFrame, keys: tuple[str, ...] = ("edge_id", "datetime")) -> DataFrame:
    """The rows of rollup that existing has none for (insert if absent)."""
    return rollup.join(existing, list(keys), "left_anti")


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace those of equal keys, null ones included; both must have the same columns and unique keys."""
    n = new.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    return existing.join(n, same, "left_anti").unionByName(new)


def cleared(facts: DataFrame, points: DataFrame, by: str, dates: list, box: tuple[float, float, float, float]) -> DataFrame:
    """facts without those of the dates whose sample point or edge (by) has a point in the box; borders are inside.

    points: (by, x, y). What stays is the complement, so that a fact with a null key or time stays.
    """
    inside = points.where(in_box(F.col("x"), F.col("y"), *box)).select(by).distinct()
    old = F.coalesce(F.to_date("datetime").isin([F.lit(d) for d in dates]), F.lit(False))
    hit = facts.where(old).join(inside, by, "left_anti")
    return facts.where(~old).unionByName(hit.select(*facts.columns))


def edge_profile(points: DataFrame, facts: DataFrame, edge: object, at: Column, reverse: bool = False) -> DataFrame:
    """(step_index, travelled_m, is_sunlit) along one edge at one instant."""
    p = points.where(F.col("edge_id") == edge)
    length = F.max("distance_from_start").over(Window.partitionBy("edge_id"))
    travelled = (length - F.col("distance_from_start")) if reverse else F.col("distance_from_start")
    lit = facts.where(F.col("datetime") == at).select("sample_point_id", "is_sunlit")
    rows = p.withColumn("travelled_m", travelled).join(lit, "sample_point_id")
    order = Window.partitionBy("edge_id").orderBy("travelled_m", "sample_point_id")
    return rows.select("edge_id", (F.row_number().over(order) - 1).alias("step_index"), "travelled_m", "is_sunlit")


def timed_walk(requests: DataFrame, points: DataFrame, facts: DataFrame) -> DataFrame:
    """One row for each sample that a request's walk meets a fact at, with the step it arrives in.

    requests: (request_id, edge_id, entry_time, reverse, speed). The arrival decides the step, so that the join is an
    equality on a computed timestamp: a moving as-of join without any range condition. Where the facts lie in leaves, the
    section of the point and the date and window of the arrival are keys too: equal ids of two sections don't mix, and the
    scan leaves out the leaves that no request comes to.
    """
    shape = points.groupBy("edge_id").agg(F.max("distance_from_start").alias("edge_length_m"), F.count("*").alias("n_points"))
    r = requests.withColumn("speed", F.when(F.col("speed") > 0, F.col("speed")).otherwise(F.raise_error(F.lit("speed must be positive")).cast("double")))
    section = ["section_id"] if {"section_id"} <= set(points.columns) & set(facts.columns) else []
    walk = r.join(shape, "edge_id").join(points.select("edge_id", "sample_point_id", "distance_from_start", *section), "edge_id")
    travelled = F.when(F.col("reverse"), F.col("edge_length_m") - F.col("distance_from_start")).otherwise(F.col("distance_from_start"))
    micros = F.round(travelled / F.col("speed") * 1_000_000).cast("long")
    arrival = F.timestamp_micros(F.unix_micros(F.col("entry_time").cast("timestamp")) + micros).cast("timestamp_ntz")
    walk = walk.withColumn("travelled_m", travelled).withColumn("datetime", snap_timestep(arrival))
    leaf = {c: v for c, v in {"sim_date": F.to_date("datetime"), "window_index": window_index(F.col("datetime"))}.items() if c in facts.columns}
    keys = ["sample_point_id", "datetime", *section, *leaf]
    return walk.withColumns(leaf).join(facts.select(*keys, "is_sunlit"), keys, "left").drop(*section, *leaf)


def sun_runs(lit: DataFrame, partition: tuple[str, ...] = RUN, order: tuple[str, ...] = ("travelled_m", "sample_point_id")) -> DataFrame:
    """Unbroken stretches of equal state: a stretch is where two row numbers keep their difference."""
    every = Window.partitionBy(*partition).orderBy(*order)
    same = Window.partitionBy(*partition, "is_sunlit").orderBy(*order)
    rows = lit.withColumn("run", F.row_number().over(every) - F.row_number().over(same))
    return rows.groupBy(*partition, "is_sunlit", "run").agg(F.min("travelled_m").alias("from_m"), F.max("travelled_m").alias("to_m"), F.count("*").alias("samples"))


def directional_cost(requests: DataFrame, points: DataFrame, facts: DataFrame) -> DataFrame:
    """Cost of walking edges in a direction from an entry time, a row for each request whose edge has samples.

    samples counts those with a fact; without any, the seconds are 0 and pct_sun, entered and exited null. One pass over
    the facts: in the order of each walk, what came before tells where a stretch or a step begins, and both aggregations
    keep the partitioning of that window.
    """
    timed = timed_walk(requests, points, facts)
    known = F.col("is_sunlit").isNotNull()
    before = Window.partitionBy("request_id").orderBy("travelled_m", "sample_point_id").rowsBetween(Window.unboundedPreceding, -1)
    turn = known & ~F.col("is_sunlit").eqNullSafe(F.last("is_sunlit", ignorenulls=True).over(before))
    step = known & ~F.col("datetime").eqNullSafe(F.last(F.when(known, F.col("datetime")), ignorenulls=True).over(before))
    rows = timed.select("*", turn.cast("int").alias("turn"), step.cast("int").alias("step"))
    rows = rows.withColumn("run", F.sum("turn").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    end = F.when(known, F.struct("travelled_m", "sample_point_id", "is_sunlit"))
    lit = F.when(F.col("is_sunlit"), F.col("travelled_m"))
    request = ["request_id", "edge_id", "reverse", "speed", "edge_length_m", "n_points"]
    runs = rows.groupBy(*request, "run").agg(F.count("is_sunlit").alias("samples"), F.count_if("is_sunlit").alias("lit"), F.min(end).alias("first"), F.max(end).alias("last"), F.sum("step").alias("steps"), (F.max(lit) - F.min(lit)).alias("length"))
    sums = [F.sum(c).alias(c) for c in ("samples", "lit", "steps")]
    cost = runs.groupBy(*request).agg(*sums, F.min("first")["is_sunlit"].alias("entered_in_sun"), F.max("last")["is_sunlit"].alias("exited_in_sun"), F.max("length").alias("best"))
    spacing = F.col("edge_length_m") / F.greatest(F.col("n_points") - 1, F.lit(1))
    sun, all_ = F.col("lit"), F.col("samples")
    return cost.select(
        "request_id", "edge_id", "reverse", "samples", "edge_length_m",
        F.round(F.col("edge_length_m") / F.col("speed"), 6).alias("traverse_seconds"),
        F.round(sun * spacing / F.col("speed"), 6).alias("sun_seconds"),
        F.round((all_ - sun) * spacing / F.col("speed"), 6).alias("shade_seconds"),
        F.round(F.lit(100).cast("decimal(20,0)") * sun / F.nullif(all_, F.lit(0)), 2).cast("double").alias("pct_sun"),
        "entered_in_sun", "exited_in_sun",
        F.round(F.coalesce(F.col("best") + spacing, F.lit(0.0)), 6).alias("longest_sun_run_m"),
        F.col("steps").alias("timesteps_spanned"),
    )


def step_facts(points: DataFrame, steps: DataFrame, lit: Column) -> DataFrame:
    """The full product of samples and a bounded number of steps (dark ones too), with the state given by an expression."""
    return points.crossJoin(F.broadcast(steps)).withColumn("is_sunlit", lit)


def occluded_facts(samples: DataFrame, sun: DataFrame, casters: DataFrame, cell: float = 250.0, reach: float = 2286.0, lift: float = 3.0) -> DataFrame:
    """Facts (sample_point_id, datetime, is_sunlit) by box casters: a ray to the sun that hits none is lit.

    samples: (sample_point_id, x, y, z); sun: (datetime, azimuth, elevation), the steps of a day or of a few (a year of
    minutes is half a million rows, whatever the data); casters: axis-parallel boxes (x1, y1, x2, y2, top). Nothing farther
    than reach can shade a sample above the guard.
    """
    # Of boxes over the same ground only the highest counts.
    boxes = casters.groupBy("x1", "y1", "x2", "y2").agg(F.max("top").alias("top"))
    outline = [(x, y) for x in ("x1", "x2") for y in ("y1", "y2")]
    return rays.shadow_facts(samples.withColumn("z", F.col("z") + lift), sun, boxes, outline, F.col("top"), cell, reach, rays.boxes_hit)


def mesh_facts(samples: DataFrame, sun: DataFrame, triangles: DataFrame, cell: float = 250.0, reach: float = 2286.0, lift: float = 3.0) -> DataFrame:
    """Facts like ``occluded_facts`` by the triangles of a mesh (x1, y1, z1 to x3, y3, z3), both sides of which shade.

    The ray from (x, y, z + lift) along (dx, dy, rise) for each metre of ground meets a triangle's plane at the ground
    distance t, and the triangle where the plane's barycentric coordinates are not negative.
    """
    meshes = triangles.select(*[k + i for i in "123" for k in "xyz"])
    outline = [(f"x{i}", f"y{i}") for i in "123"]
    return rays.shadow_facts(samples.withColumn("z", F.col("z") + lift), sun, meshes, outline, F.greatest("z1", "z2", "z3"), cell, reach, rays.triangles_hit)


def lit_along_paths(path_points: DataFrame, azimuth: float, elevation: float, casters: DataFrame, spacing: float = 2.0, ground: float = 0.0) -> DataFrame:
    """(path_id, n, lit): samples along each path, the ends included, and how many of them a sun lights up.

    path_points: (path_id, position, x, y); casters as for ``occluded_facts``. Below the guard none is lit.
    """
    samples = analytics.points_along(path_points, spacing)
    key = F.struct("path_id", "sequence_index")
    at = samples.select(key.alias("sample_point_id"), "x", "y", F.lit(ground).alias("z"))
    sun = path_points.sparkSession.createDataFrame([(0, float(azimuth), float(elevation))], "datetime int, azimuth double, elevation double")
    facts = occluded_facts(at, sun, casters)
    return facts.groupBy(F.col("sample_point_id.path_id").alias("path_id")).agg(F.count("*").alias("n"), F.count_if("is_sunlit").alias("lit"))


def pack_words(facts: DataFrame, keys: list[str], step: str = "k", width: int = 60) -> DataFrame:
    """(keys, word, bits, present): bit k of word w is step w * width + k, lit and there at all.

    Missing steps stay missing, and a step told twice is lit if any telling is; width is 62 at most.
    """
    bit = F.expr(f"shiftleft(1L, cast({step} % {width} AS int))")
    return facts.groupBy(*keys, F.floor(F.col(step) / width).cast("int").alias("word")).agg(F.bit_or(F.when(F.col("is_sunlit"), bit).otherwise(F.lit(0).cast("long"))).alias("bits"), F.bit_or(bit).alias("present"))


def unpack_words(packed: DataFrame, keys: list[str], step: str = "k", width: int = 60) -> DataFrame:
    rows = packed.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(width - 1)))).where(F.getbit("present", "_k") == 1)
    return rows.select(*keys, (F.col("word") * width + F.col("_k")).alias(step), (F.getbit("bits", "_k") == 1).alias("is_sunlit"))


def tree_values(points: DataFrame, trees: DataFrame, radius: float = 5.0) -> DataFrame:
    """(sample_point_id, edge_id, tree_value): the clamped sum of shade within the radius."""
    from sunweave.operators.spatial import within

    near = within(points, trees, radius).groupBy("sample_point_id").agg(F.sum("shade_norm").alias("shade"))
    out = points.select("sample_point_id", "edge_id").join(near, "sample_point_id", "left")
    return out.select("sample_point_id", "edge_id", F.least(F.round(F.coalesce("shade", F.lit(0.0)), 6), F.lit(1.0)).alias("tree_value"))
