"""The capacity model as columns over a grid of fleet shapes (workers, shards)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The measured rates and the workload of the sizing model.
SAMPLES, STEPS, DAYS, EDGES = 365_133, 360, 60, 6_700
V1_RATE, BATCHING, LOCALITY = 73_027.0, 3.0, 1.35
STREAM_RATE, STREAMS_PER_WORKER, MAX_STREAMS = 200_000.0, 2, 12
ROLLUP_RATE, INDEX_RATE = 12_000_000.0, 600_000.0
SPIN_UP_SECONDS, ANALYZE_SECONDS, TARGET_SECONDS = 45.0, 30.0, 900.0
SHORTFALL, LOST_SHARDS, KEPT_WORKERS, HEADROOM = 0.15, 1, 0.9, 0.10
WORKER_VCPU, SHARD_VCPU, OTHER_VCPU = 8, 16, 12
WORKER_GB, SHARD_GB, OTHER_GB = 16, 128, 34
HEARTBEAT_SECONDS, LEASE_SECONDS, REAPER_SECONDS = 30, 120, 60
SECTIONS, WINDOWS, WAYPOINTS, TREES = 84, 6, 4_168, 1_280_954
WORKERS, SHARDS = 54, 9
MAX_BUILDING_M, GUARD_DEGREES, SECTION_M, WINDOW_ARC_DEGREES = 200.0, 5.0, 1000.0, 45.0

ROWS = SAMPLES * STEPS * DAYS
EDGE_ROWS = EDGES * STEPS * DAYS
WORKER_RATE = V1_RATE * BATCHING * LOCALITY


def streams(workers: Column, shards: Column) -> Column:
    return F.least(F.lit(MAX_STREAMS), F.greatest(F.lit(1), F.floor(workers / shards)) * STREAMS_PER_WORKER)


def ingest_rate(workers: Column, shards: Column, scale: float = 1.0) -> Column:
    return shards * streams(workers, shards) * (STREAM_RATE * scale)


def map_seconds(workers: Column, shards: Column, scale: float = 1.0) -> Column:
    """Writing overlaps computing: the slower of both."""
    return F.greatest(F.lit(float(ROWS)) / (workers * (WORKER_RATE * scale)), F.lit(float(ROWS)) / ingest_rate(workers, shards, scale))


def reduce_seconds(shards: Column, scale: float = 1.0) -> Column:
    return F.lit(ROWS / (ROLLUP_RATE * scale) + EDGE_ROWS / (INDEX_RATE * scale)) / shards + ANALYZE_SECONDS / scale


def total_seconds(workers: Column, shards: Column, scale: float = 1.0) -> Column:
    return SPIN_UP_SECONDS / scale + map_seconds(workers, shards, scale) + reduce_seconds(shards, scale)


def shapes(spark: SparkSession, workers: int = 200, shards: int = 40) -> DataFrame:
    """All shapes with cost, times under stress and the five conditions."""
    w, s = F.col("workers"), F.col("shards")
    grid = spark.range(1, workers + 1).select(F.col("id").alias("workers")).crossJoin(F.broadcast(spark.range(1, shards + 1).select(F.col("id").alias("shards"))))
    fewer_w = F.greatest(F.lit(1), F.floor(w * KEPT_WORKERS))
    fewer_s = F.greatest(F.lit(1), s - LOST_SHARDS)
    out = grid.select(
        "workers", "shards", (w * WORKER_VCPU + s * SHARD_VCPU + OTHER_VCPU).alias("vcpu"), (w * WORKER_GB + s * SHARD_GB + OTHER_GB).alias("ram_gb"),
        total_seconds(w, s).alias("nominal"), total_seconds(w, s, 1 - SHORTFALL).alias("pessimistic"),
        total_seconds(fewer_w, fewer_s, 1 - SHORTFALL).alias("pessimistic_failure"),
        ((s > LOST_SHARDS) & (ingest_rate(w, fewer_s) / (w * WORKER_RATE) - 1 >= HEADROOM)).alias("survives_shard_loss"),
        (streams(w, s) >= MAX_STREAMS).alias("saturated"),
    )
    deadlines = F.greatest("nominal", "pessimistic", "pessimistic_failure") <= TARGET_SECONDS
    out = out.withColumn("deadlines_ok", deadlines).withColumn("slack", 1 - F.col("pessimistic_failure") / TARGET_SECONDS)
    return out.withColumn("passes", F.col("deadlines_ok") & F.col("survives_shard_loss") & F.col("saturated"))


def derive_shape(all_shapes: DataFrame) -> DataFrame:
    """The cheapest shape that passes, by cost, then slack, workers and shards."""
    return all_shapes.where("passes").orderBy("vcpu", F.desc("slack"), "workers", "shards").limit(1)


def pareto_frontier(all_shapes: DataFrame) -> DataFrame:
    """Per cost the fastest shape, kept where it beats all cheaper ones: a running minimum over one row a cost."""
    best = all_shapes.groupBy("vcpu").agg(F.min(F.struct("nominal", "workers", "shards")).alias("b")).select("vcpu", "b.*")
    before = Window.orderBy("vcpu").rowsBetween(Window.unboundedPreceding, -1)
    return best.withColumn("floor", F.min("nominal").over(before)).where("floor IS NULL OR nominal < floor - 1e-9").drop("floor")


def speedup(all_shapes: DataFrame) -> DataFrame:
    """Against the measured single machine, for the same work."""
    return all_shapes.select("workers", "shards", (F.lit(ROWS / V1_RATE) / F.col("nominal")).alias("speedup"))


def balanced_shards(all_shapes: DataFrame) -> DataFrame:
    """Per number of workers the fewest shards whose ingest keeps up."""
    enough = ingest_rate(F.col("workers"), F.col("shards")) >= F.col("workers") * WORKER_RATE
    return all_shapes.where(enough).groupBy("workers").agg(F.min("shards").alias("shards"))


def cheapest_nominal(all_shapes: DataFrame, target: float = TARGET_SECONDS) -> DataFrame:
    """The cheapest shape that meets the target without any stress, the first by workers and shards on ties."""
    return all_shapes.where(F.col("nominal") <= target).orderBy("vcpu", "workers", "shards").limit(1)


def bound_by(workers: Column, shards: Column) -> Column:
    """What a shape waits for: writing takes longer than computing where ingest can't keep up."""
    return F.when(ingest_rate(workers, shards) < workers * WORKER_RATE, "I/O-bound").otherwise("compute-bound")


def leases(all_shapes: DataFrame, lease: int = LEASE_SECONDS) -> DataFrame:
    """(workers, shards, floor, ceiling, coverage): bounds of a lease in seconds, and what one of some length absorbs.

    Below three heartbeats a slow worker is taken for dead; from the map phase less a reaper's period on, nothing that dies
    ever comes back in time. coverage is the part of the map phase in which a death is redone before it ends.
    """
    w, s = F.col("workers"), F.col("shards")
    rows = ROWS / (SECTIONS * DAYS * WINDOWS)
    m = map_seconds(w, s)
    absorbed = F.greatest(F.lit(0.0), (m - (lease + REAPER_SECONDS) - rows / WORKER_RATE) / m)
    return all_shapes.select("workers", "shards", F.lit(3 * HEARTBEAT_SECONDS).alias("floor"), (m - REAPER_SECONDS).cast("int").alias("ceiling"), absorbed.alias("coverage"))


def sweep(all_shapes: DataFrame) -> DataFrame:
    """Every shape's ingest, phases, total and speed-up, and what bounds it."""
    w, s = F.col("workers"), F.col("shards")
    return all_shapes.select("workers", "shards", ingest_rate(w, s).alias("ingest"), map_seconds(w, s).alias("map_seconds"), reduce_seconds(s).alias("reduce_seconds"), F.col("nominal").alias("total_seconds"), (F.lit(ROWS / V1_RATE) / F.col("nominal")).alias("speedup"), bound_by(w, s).alias("bound_by"))


def shard_sweep(all_shapes: DataFrame, workers: int = WORKERS, shards: tuple[int, ...] = (1, 2, 4, 6, 8, 10, 14, 20, 30)) -> DataFrame:
    return sweep(all_shapes.where((F.col("workers") == workers) & F.col("shards").isin(*shards)))


def worker_sweep(all_shapes: DataFrame, workers: tuple[int, ...] = (1, 5, 10, 25, 50, 100, 200)) -> DataFrame:
    """Each fleet with the fewest shards that keep up with it; a fleet that no listed shape keeps up with has no row."""
    return sweep(all_shapes.where(F.col("workers").isin(*workers)).join(balanced_shards(all_shapes), ["workers", "shards"], "left_semi"))


def inventory(spark: SparkSession, shards: int = SHARDS) -> DataFrame:
    """(place, table, rows): what the coordinator and each shard hold, and all of them together."""
    geometry = {"waypoints": WAYPOINTS, "edges": EDGES, "sample_points": SAMPLES, "edge_sections": EDGES}
    coordinator = geometry | {"trees": TREES, "tasks": SECTIONS * DAYS * WINDOWS, "sections": SECTIONS, "shards": shards, "runs": 1, "grid": 1}
    each = geometry | {"exposure_samples": ROWS // shards, "exposure_edges": EDGE_ROWS // shards}
    total = {"exposure_samples": ROWS, "exposure_edges": EDGE_ROWS, "geometry": shards * sum(geometry.values()), "coordinator": sum(coordinator.values())}
    rows = [(p, t, n) for p, of in (("coordinator", coordinator), ("shard", each), ("cluster", total)) for t, n in (of | {"total": sum(of.values())}).items()]
    return spark.createDataFrame(rows, "place string, table string, rows long")


def halo_metres() -> float:
    """How far the longest shadow above the guard reaches."""
    return MAX_BUILDING_M / math.tan(math.radians(GUARD_DEGREES))


def working_set_km2() -> float:
    """The rectangle around a section and the sector that its window's shadows come from."""
    r, s = halo_metres() / 1000, SECTION_M / 1000
    return (s + 2 * r * math.sin(math.radians(WINDOW_ARC_DEGREES) / 2)) * (s + r)


def annulus_km2() -> float:
    """The same if shadows came from all sides."""
    return (SECTION_M / 1000 + 2 * halo_metres() / 1000) ** 2
