"""The engine's domain over the star-schema tables, the same rows for Spark and for SQL.

Geometry and states are made of the tables' keys by integer arithmetic. SQL views have the names of the functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunweave.functions.timegrid import floor_timestep

#: Midnight of the day that the step facts play on.
DAY = "2024-06-15"


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def samples(self) -> DataFrame:
        return self.table("events").select((F.col("user_id") % 9).alias("section_id"), F.col("user_id").alias("edge_id"), F.col("event_id").alias("sample_point_id"), floor_timestep(F.col("ts")).alias("datetime"), (F.col("value") >= 35).alias("is_sunlit"))

    def points(self) -> DataFrame:
        w = Window.partitionBy("user_id").orderBy("ts", "event_id")
        rows = self.table("events").withColumn("sequence_index", F.row_number().over(w) - 1)
        return rows.select((F.col("user_id") % 9).alias("section_id"), F.col("user_id").alias("edge_id"), F.col("event_id").alias("sample_point_id"), "sequence_index", (F.col("sequence_index") * 2.0).alias("distance_from_start"))

    def steps(self) -> DataFrame:
        k = self.spark.range(60).select(F.col("id").cast("int").alias("k"))
        return k.withColumn("datetime", F.to_timestamp_ntz(F.lit(f"{DAY} 15:00:00")) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("k") * 3, F.lit(0)))

    def grid_facts(self) -> DataFrame:
        rows = self.points().crossJoin(F.broadcast(self.steps()))
        return rows.select("section_id", "edge_id", "sample_point_id", "sequence_index", "k", "datetime", ((F.col("sequence_index") * 7 + F.col("k") * 13) % 10 < 6).alias("is_sunlit"))

    def day_facts(self) -> DataFrame:
        """Facts of steps all over the day, with gaps."""
        k = self.spark.range(60).select((F.col("id") * 6 + F.col("id") % 5).cast("int").alias("k"))
        rows = self.points().crossJoin(F.broadcast(k)).where((F.col("sample_point_id") + F.col("k")) % 4 != 0)
        return rows.select("edge_id", "sample_point_id", "k", ((F.col("sequence_index") * 7 + F.col("k") * 13) % 10 < 6).alias("is_sunlit"))

    def placed_points(self) -> DataFrame:
        return self.points().select("*", *_place(F.col("sample_point_id"), 7919, 104729))

    def requests(self, reverse: bool) -> DataFrame:
        entry = F.to_timestamp_ntz(F.lit(f"{DAY} 16:00:00")) + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("edge_id") % 11).cast("int"), F.lit(30))
        edges = self.table("events").select(F.col("user_id").alias("edge_id")).distinct()
        return edges.select(F.col("edge_id").alias("request_id"), "edge_id", entry.alias("entry_time"), F.lit(reverse).alias("reverse"), F.lit(0.25).alias("speed"))

    def sections(self) -> DataFrame:
        n = self.table("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("sample_count"))
        j = self.table("nation").join(n, "n_nationkey", "left")
        return j.select(F.col("n_nationkey").alias("section_id"), (F.col("n_nationkey") % 5).alias("grid_col"), F.floor(F.col("n_nationkey") / 5).cast("int").alias("grid_row"), F.col("n_regionkey").alias("shard_index"), F.coalesce("sample_count", F.lit(0)).alias("sample_count"))

    def tasks(self) -> DataFrame:
        c = self.table("customer").join(F.broadcast(self.table("nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_nationkey", "n_regionkey")
        o = self.table("orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
        key = F.col("o_orderkey")
        state = F.when(F.col("o_orderstatus") == "P", "pending").when(F.col("o_orderstatus") == "O", "running").when(key % 50 == 0, "failed").otherwise("done")
        day = F.col("o_orderdate").cast("timestamp")
        started = F.when(state != "pending", day)
        finished = F.when(state.isin("done", "failed"), F.timestamp_seconds(F.unix_timestamp(day) + key % 500 + 1))
        return o.select(
            key.alias("task_id"), F.lit("run").alias("run_id"), F.col("c_nationkey").alias("section_id"), F.to_date("o_orderdate").alias("sim_date"),
            (key % 6).cast("int").alias("window_index"), F.col("n_regionkey").alias("shard_index"), state.alias("state"),
            (6 - F.left("o_orderpriority", F.lit(1)).cast("int")).alias("priority"), F.floor("o_totalprice").cast("long").alias("est_raycasts"),
            (key % 3).cast("int").alias("attempts"), F.lit(2).alias("max_attempts"), F.when(state != "pending", F.concat(F.lit("w"), (F.col("o_custkey") % 54).cast("string"))).alias("worker_id"),
            F.when(state == "running", day).alias("lease_expires_at"), F.when((state == "running") & (key % 4 == 0), day).alias("heartbeat_at"), started.alias("started_at"), finished.alias("finished_at"),
            F.when(state == "done", key % 1000).alias("rows_written"), F.when(state != "pending", key % 2 == 0).alias("affinity_hit"), F.when(state == "failed", F.concat(F.lit("error "), key.cast("string"))).alias("last_error"),
        )

    def runs(self) -> DataFrame:
        """One run, whose cap is about a tenth of all tasks, so that some shards are at it."""
        return self.table("orders").agg((F.count("*") * 97 / 1000).cast("int").alias("max_tasks_per_shard")).select(F.lit("run").alias("run_id"), "max_tasks_per_shard")

    def shards(self) -> DataFrame:
        k = F.col("r_regionkey")
        return self.table("region").select(k.alias("shard_index"), F.concat(F.lit("db"), k.cast("string")).alias("host"), (5432 + k).cast("int").alias("port"), F.lower("r_name").alias("dbname"), F.when(k == 3, "draining").otherwise("online").alias("state"), F.lit(16).alias("vcpu"), F.lit(128).alias("ram_gb"), F.lit(None).cast("timestamp").alias("last_seen_at"))

    def waypoints(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("id"), *_place(F.col("c_custkey"), 7919, 104729))

    def trees(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("tree_id"), *_place(F.col("p_partkey"), 6271, 15485863), (F.col("p_size") / 50.0).alias("shade_norm"))

    def edges(self) -> DataFrame:
        """Distinct undirected (a, b), a < b, of all pairs of whole keys."""
        from sunweave.operators.spatial import edge_set

        return edge_set(self.table("lineitem"), "l_suppkey", "l_partkey")

    def nodes(self) -> DataFrame:
        """The ends of all edges, in space."""
        ids = self.table("lineitem").select(F.explode(F.array("l_suppkey", "l_partkey")).alias("id")).distinct()
        return ids.select("id", *_place(F.col("id"), 7919, 104729), (F.col("id") * 7 % 5).cast("double").alias("z"))

    def streets(self) -> DataFrame:
        """Edges (edge_id, ax, ay, bx, by) between the places of customers."""
        k = F.col("c_custkey")
        ends = zip(("ax", "ay", "bx", "by"), (*_place(k, 7919, 104729), *_place(k + 1, 7919, 104729)), strict=True)
        return self.table("customer").select(k.alias("edge_id"), *[c.alias(n) for n, c in ends])

    def cells(self) -> DataFrame:
        """Full cells of a grid as large as the keys."""
        return self.table("lineitem").select(F.col("l_suppkey").alias("cx"), (F.col("l_partkey") * 3 + F.col("l_linenumber") % 3).alias("cy")).distinct()

    def grid_size(self) -> tuple[int, int]:
        m = self.table("lineitem").agg((F.max("l_suppkey") + 1).alias("w"), (F.max("l_partkey") * 3 + 3).alias("h")).first()
        return (m["w"] or 1), (m["h"] or 1)

    def route_points(self) -> DataFrame:
        """The samples of each edge as a path of its own."""
        k = F.col("sample_point_id")
        return self.points().select(F.col("edge_id").alias("path_id"), F.col("sequence_index").alias("position"), (k % 100).cast("double").alias("x"), (k * 7 % 90).cast("double").alias("y"))

    def od(self) -> DataFrame:
        h = self.spark.range(3, 21).select(F.col("id").alias("hour"))
        rows = self.table("supplier").crossJoin(F.broadcast(h))
        k = F.col("s_suppkey") * F.col("hour")
        return rows.select(F.when(F.col("s_suppkey") % 2 == 0, "wkdy").otherwise("wknd").alias("day_type"), "hour", (k % 5).cast("double").alias("trips"), F.when(k % 7 != 0, (k % 40).cast("double")).alias("min_exposure"), (k % 60).cast("double").alias("max_exposure"))

    def edge_shards(self) -> DataFrame:
        """(edge_id, hilbert_index, shard_index) of customers as edges."""
        from sunweave.functions.spatial import hilbert_index

        w = self.waypoints()
        cell = lambda c, n: F.least(F.floor(F.col(c) / n), F.lit(127)).cast("int")
        return w.select(F.col("id").alias("edge_id"), hilbert_index(cell("x", 40), cell("y", 175)).alias("hilbert_index"), (F.col("id") % 9).alias("shard_index"))


def _place(key: Column, a: int, b: int) -> tuple[Column, Column]:
    return ((key * a) % 5000).cast("double").alias("x"), ((key * b) % 22000).cast("double").alias("y")


#: The same views in SQL; those that a query names are put before it.
SQL = {
    "samples": "SELECT user_id % 9 AS section_id, user_id AS edge_id, event_id AS sample_point_id, date_trunc('hour', ts) + to_minutes(CAST(minute(ts) // 3 * 3 AS BIGINT)) AS datetime, value >= 35 AS is_sunlit FROM events",
    "points": "SELECT user_id % 9 AS section_id, user_id AS edge_id, event_id AS sample_point_id, CAST(row_number() OVER w - 1 AS INTEGER) AS sequence_index, (row_number() OVER w - 1) * 2.0::DOUBLE AS distance_from_start FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)",
    "steps": f"SELECT CAST(k AS INTEGER) AS k, TIMESTAMP '{DAY} 15:00:00' + to_minutes(CAST(3 * k AS BIGINT)) AS datetime FROM range(60) t(k)",
    "grid_facts": "SELECT section_id, edge_id, sample_point_id, sequence_index, k, datetime, (sequence_index * 7 + k * 13) % 10 < 6 AS is_sunlit FROM points, steps",
    "sections": "SELECT n_nationkey AS section_id, n_nationkey % 5 AS grid_col, CAST(n_nationkey // 5 AS INTEGER) AS grid_row, n_regionkey AS shard_index, COALESCE(n, 0) AS sample_count FROM nation LEFT JOIN (SELECT c_nationkey AS n_nationkey, count(*) AS n FROM customer GROUP BY 1) USING (n_nationkey)",
    "day_facts": "SELECT edge_id, sample_point_id, k, (sequence_index * 7 + k * 13) % 10 < 6 AS is_sunlit FROM points, (SELECT CAST(i * 6 + i % 5 AS INTEGER) AS k FROM range(60) t(i)) WHERE (sample_point_id + k) % 4 <> 0",
    "placed_points": "SELECT *, CAST(sample_point_id * 7919 % 5000 AS DOUBLE) AS x, CAST(sample_point_id * 104729 % 22000 AS DOUBLE) AS y FROM points",
    "route_points": "SELECT edge_id AS path_id, sequence_index AS position, CAST(sample_point_id % 100 AS DOUBLE) AS x, CAST(sample_point_id * 7 % 90 AS DOUBLE) AS y FROM points",
    "tasks": "SELECT *, CASE WHEN state = 'running' THEN day END AS lease_expires_at, CASE WHEN state = 'running' AND task_id % 4 = 0 THEN day END AS heartbeat_at, CASE WHEN state <> 'pending' THEN day END AS started_at, CASE WHEN state IN ('done', 'failed') THEN day + to_seconds(task_id % 500 + 1) END AS finished_at, CASE WHEN state <> 'pending' THEN w END AS worker_id, CASE WHEN state = 'done' THEN task_id % 1000 END AS rows_written, CASE WHEN state <> 'pending' THEN task_id % 2 = 0 END AS affinity_hit, CASE WHEN state = 'failed' THEN 'error ' || task_id END AS last_error FROM (SELECT o_orderkey AS task_id, 'run' AS run_id, c_nationkey AS section_id, CAST(o_orderdate AS DATE) AS sim_date, CAST(o_orderkey % 6 AS INTEGER) AS window_index, n_regionkey AS shard_index, CASE WHEN o_orderstatus = 'P' THEN 'pending' WHEN o_orderstatus = 'O' THEN 'running' WHEN o_orderkey % 50 = 0 THEN 'failed' ELSE 'done' END AS state, CAST(6 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS INTEGER) AS priority, CAST(floor(o_totalprice) AS BIGINT) AS est_raycasts, CAST(o_orderkey % 3 AS INTEGER) AS attempts, 2 AS max_attempts, 'w' || (o_custkey % 54) AS w, CAST(o_orderdate AS TIMESTAMP) AS day FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)",
    "runs": "SELECT 'run' AS run_id, CAST(floor(count(*) * 97 / 1000) AS INTEGER) AS max_tasks_per_shard FROM orders",
    "shards": "SELECT r_regionkey AS shard_index, 'db' || r_regionkey AS host, CAST(5432 + r_regionkey AS INTEGER) AS port, lower(r_name) AS dbname, CASE WHEN r_regionkey = 3 THEN 'draining' ELSE 'online' END AS state, 16 AS vcpu, 128 AS ram_gb FROM region",
    "streets": "SELECT c_custkey AS edge_id, CAST(c_custkey * 7919 % 5000 AS DOUBLE) AS ax, CAST(c_custkey * 104729 % 22000 AS DOUBLE) AS ay, CAST((c_custkey + 1) * 7919 % 5000 AS DOUBLE) AS bx, CAST((c_custkey + 1) * 104729 % 22000 AS DOUBLE) AS b_y FROM customer",
    "cells": "SELECT DISTINCT l_suppkey AS cx, l_partkey * 3 + l_linenumber % 3 AS cy FROM lineitem",
    "grid_size": "SELECT max(l_suppkey) + 1 AS w, max(l_partkey) * 3 + 3 AS h FROM lineitem",
    "waypoints": "SELECT c_custkey AS id, CAST((c_custkey * 7919) % 5000 AS DOUBLE) AS x, CAST((c_custkey * 104729) % 22000 AS DOUBLE) AS y FROM customer",
    "trees": "SELECT p_partkey AS tree_id, CAST((p_partkey * 6271) % 5000 AS DOUBLE) AS x, CAST((p_partkey * 15485863) % 22000 AS DOUBLE) AS y, p_size / 50.0::DOUBLE AS shade_norm FROM part",
    "edges": "SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM (SELECT l_suppkey AS a, l_partkey AS b FROM lineitem) WHERE a <> b",
    "nodes": "SELECT id, CAST((id * 7919) % 5000 AS DOUBLE) AS x, CAST((id * 104729) % 22000 AS DOUBLE) AS y, CAST(id * 7 % 5 AS DOUBLE) AS z FROM (SELECT l_suppkey AS id FROM lineitem UNION SELECT l_partkey FROM lineitem)",
    "od": "SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'wkdy' ELSE 'wknd' END AS day_type, hour, CAST(s_suppkey * hour % 5 AS DOUBLE) AS trips, CASE WHEN s_suppkey * hour % 7 <> 0 THEN CAST(s_suppkey * hour % 40 AS DOUBLE) END AS min_exposure, CAST(s_suppkey * hour % 60 AS DOUBLE) AS max_exposure FROM supplier, range(3, 21) t(hour)",
    "hilbert": "SELECT x, y, d FROM (WITH RECURSIVE h(x, y, s, cx, cy, d) AS (SELECT x, y, 64, x, y, 0 FROM range(128) a(x), range(128) b(y) UNION ALL SELECT x, y, s // 2, CASE WHEN ry = 0 THEN fy ELSE fx END, CASE WHEN ry = 0 THEN fx ELSE fy END, d + s * s * xor(3 * rx, ry) FROM (SELECT *, CASE WHEN ry = 0 AND rx = 1 THEN s - 1 - cx ELSE cx END AS fx, CASE WHEN ry = 0 AND rx = 1 THEN s - 1 - cy ELSE cy END AS fy FROM (SELECT *, CASE WHEN cx & s > 0 THEN 1 ELSE 0 END AS rx, CASE WHEN cy & s > 0 THEN 1 ELSE 0 END AS ry FROM h WHERE s > 0))) SELECT x, y, d FROM h WHERE s = 0)",
    "edge_shards": "SELECT id AS edge_id, CAST(d AS BIGINT) AS hilbert_index, id % 9 AS shard_index FROM waypoints JOIN hilbert ON hilbert.x = least(CAST(floor(waypoints.x / 40) AS BIGINT), 127) AND hilbert.y = least(CAST(floor(waypoints.y / 175) AS BIGINT), 127)",
    "rollup": "SELECT section_id, edge_id, datetime, count(*) FILTER (is_sunlit) AS sunlit_sum, count(*) AS sample_count FROM samples GROUP BY ALL",
    "counts": "SELECT datetime, count(*) FILTER (is_sunlit) AS sunlit FROM samples GROUP BY ALL",
}
_NEEDS = {"grid_facts": ["points", "steps"], "day_facts": ["points"], "placed_points": ["points"], "route_points": ["points"], "edge_shards": ["waypoints", "hilbert"], "rollup": ["samples"], "counts": ["samples"]}


def with_views(names: str, query: str) -> str:
    """The query after the definitions of the views it names."""
    order: list[str] = []
    for name in names.split():
        for n in [*_NEEDS.get(name, []), name]:
            if n not in order:
                order.append(n)
    return ("WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in order) + " " + query) if order else query
