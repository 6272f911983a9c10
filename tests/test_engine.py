"""Golden values, invariants and round trips of the engine's operators."""

import datetime as dt
import math
import random
import struct
from itertools import combinations_with_replacement

import pytest
from pyspark.sql import functions as F

from sunweave.functions import solar, spatial, timegrid
from sunweave.operators import analytics, capacity, exposure, graph, integrity, queue, report, topology
from sunweave.operators import spatial as joins
from sunweave.sources import catalog, config, files
from sunweave.streaming import exposure as streams

NOON = dt.datetime(2026, 6, 15)


@pytest.fixture(scope="module")
def street(spark):
    """One 400 m street of 201 samples, 60 steps from 15:00 on; the sun's edge moves along it."""
    points = spark.range(201).select(F.lit("e1").alias("edge_id"), F.col("id").alias("sample_point_id"), (F.col("id") * 2.0).alias("distance_from_start"))
    k = spark.range(60).select((F.col("id") / 59.0).alias("part"), (F.to_timestamp_ntz(F.lit("2026-06-15 15:00:00")) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int") * 3, F.lit(0))).alias("datetime"))
    facts = exposure.step_facts(points, k, F.col("distance_from_start") > 400 * F.col("part")).select("edge_id", "sample_point_id", "datetime", "is_sunlit")
    return points.cache(), facts.cache()


def request(spark, *rows):
    return spark.createDataFrame(rows, "request_id int, edge_id string, entry_time timestamp_ntz, reverse boolean, speed double")


def test_directional_cost_golden(spark, street):
    points, facts = street
    at = NOON.replace(hour=16)
    got = {r.request_id: r for r in exposure.directional_cost(request(spark, (1, "e1", at, False, 0.5), (2, "e1", at, True, 0.5)), points, facts).collect()}
    for i, sun, shade, pct, entered, exited, run in ((1, 504.0, 300.0, 62.69, False, True, 252.0), (2, 492.0, 312.0, 61.19, True, False, 246.0)):
        r = got[i]
        assert (r.samples, r.edge_length_m, r.traverse_seconds, r.timesteps_spanned) == (201, 400.0, 800.0, 5)
        assert (r.sun_seconds, r.shade_seconds, r.pct_sun, r.entered_in_sun, r.exited_in_sun, r.longest_sun_run_m) == (sun, shade, pct, entered, exited, run)
    rollup = {r.datetime: r for r in exposure.edge_rollup(facts, ("edge_id", "datetime")).collect()}
    assert (rollup[at].sunlit_sum, rollup[at].sample_count) == (133, 201)


def test_directional_cost_edges(spark, street):
    points, facts = street
    late = NOON.replace(hour=23, minute=59)
    rows = exposure.directional_cost(request(spark, (1, "e1", late, False, 0.5), (2, "unknown", late, False, 1.0)), points, facts).collect()
    assert [(r.request_id, r.samples, r.sun_seconds, r.pct_sun, r.entered_in_sun, r.longest_sun_run_m) for r in rows] == [(1, 0, 0.0, None, None, 0.0)]
    with pytest.raises(Exception, match="speed must be positive"):
        exposure.directional_cost(request(spark, (1, "e1", late, False, 0.0)), points, facts).collect()


def test_snap_and_windows(spark):
    cases = {"03:01:30": 180, "03:04:30": 186, "02:10:00": 180, "23:00:00": 1257, "20:58:31": 1257, "12:01:29": 720}
    rows = spark.createDataFrame([(dt.datetime.fromisoformat(f"2026-06-15 {t}"), m) for t, m in cases.items()], "ts timestamp_ntz, want int")
    for r in rows.select("want", timegrid.snap_timestep(F.col("ts")).alias("s")).collect():
        assert r.s == NOON + dt.timedelta(minutes=r.want)
    w = spark.range(6).select(timegrid.window_bounds(F.lit(NOON.date()), F.col("id").cast("int")).alias("b")).select("b.*").orderBy("lo").collect()
    assert all(a.hi == b.lo for a, b in zip(w, w[1:])) and w[0].first_minute == 180 and w[-1].last_minute == 1259
    with pytest.raises(ValueError):
        timegrid.window_bounds(F.lit(NOON.date()), F.lit(0), windows=7)
    with pytest.raises(Exception, match="out of range"):
        spark.range(1).select(timegrid.window_bounds(F.lit(NOON.date()), F.lit(6))).collect()


def test_hilbert_is_a_path(spark):
    c = spark.range(1 << 14).select((F.col("id") % 128).cast("int").alias("x"), F.expr("cast(id div 128 AS int)").alias("y"))
    rows = sorted((r.d, r.x, r.y) for r in c.withColumn("d", spatial.hilbert_index(F.col("x"), F.col("y"))).collect())
    assert [r[0] for r in rows] == list(range(1 << 14))
    assert all(abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1 for a, b in zip(rows, rows[1:]))


def test_balanced_runs_is_optimal():
    rng = random.Random(1)
    for _ in range(60):
        w = [rng.randrange(1, 20) for _ in range(rng.randrange(1, 8))]
        for k in range(1, len(w) + 2):
            runs = topology.balanced_runs(w, k)
            load = [sum(x for x, r in zip(w, runs) if r == i) for i in set(runs)]
            best = min((max(sum(w[a:b]) for a, b in zip((0, *c), (*c, len(w)))) for c in combinations_with_replacement(range(len(w) + 1), max(0, k - 1)) if list(c) == sorted(c)), default=sum(w))
            assert max(load) == best and runs == sorted(runs) and len(set(runs)) <= max(k, 1)


def test_capacity_golden(spark):
    shapes = capacity.shapes(spark).cache()
    best = capacity.derive_shape(shapes).first()
    assert (best.workers, best.shards, best.vcpu, round(best.slack, 5)) == (54, 9, 588, 0.02894)
    assert round(best.nominal, 1) == 668.7
    assert shapes.agg(F.count_if("deadlines_ok"), F.count_if("passes")).first()[:] == (4981, 448)
    assert round(capacity.speedup(shapes).where("workers = 54 AND shards = 9").first().speedup, 1) == 161.5
    front = capacity.pareto_frontier(shapes).orderBy("vcpu").collect()
    assert all(a.nominal > b.nominal for a, b in zip(front, front[1:]))


def test_sun(spark):
    e = files.make_ephemeris(spark, 2026, 40.7826, -73.9656, -5)
    assert e.count() == 365 * 1440 and e.groupBy("doy").count().select("count").distinct().collect()[0][0] == 1440
    top = e.where("doy = 172").orderBy(F.desc("elevation")).first()
    assert abs(top.elevation - (90 - 40.7826 + 23.44)) < 0.3 and abs(top.azimuth - 180) < 2
    d = spark.range(1).select(solar.daylight_hours(F.lit(172)).alias("s"), solar.daylight_hours(F.lit(355)).alias("w"), solar.live_steps(F.lit(172), F.lit(180), F.lit(1260)).alias("n"), solar.live_steps(F.lit(355), F.lit(180), F.lit(1260)).alias("m"), solar.shortest_arc(F.lit(350.0), F.lit(10.0), F.lit(0.5)).alias("a")).first()
    assert 14.9 < d.s < 15.2 and 9 < d.w < 9.3 and (d.m, d.n) == (168, 285) and d.a == 0


def test_box_shadow(spark):
    samples = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 30.0, 0.0, 0.0), (3, 0.0, 30.0, 0.0)], "sample_point_id int, x double, y double, z double")
    box = spark.createDataFrame([(10.0, -5.0, 12.0, 5.0, 23.0)], "x1 double, y1 double, x2 double, y2 double, top double")
    sun = spark.createDataFrame([(1, 90.0, 45.0), (2, 90.0, 70.0), (3, 270.0, 45.0), (4, 90.0, 3.0)], "datetime int, azimuth double, elevation double")
    got = {(r.sample_point_id, r.datetime): r.is_sunlit for r in exposure.occluded_facts(samples, sun, box, lift=3.0).collect()}
    assert got == {(1, 1): False, (1, 2): False if 3 + 10 * math.tan(math.radians(70)) < 23 else True, (1, 3): True, (1, 4): False, (2, 1): True, (2, 2): True, (2, 3): True if 3 + 18 >= 23 else False, (2, 4): False, (3, 1): True, (3, 2): True, (3, 3): True, (3, 4): False}


def tasks(spark):
    rows = []
    for i in range(18):
        rows.append((i, "r", 9000 + i % 9, i % 2, i % 3, "pending", 1, 4000 + 100 * (i % 9) * (1 + i % 2), 0, 2, None, None, None, None, None, None, None))
    return spark.createDataFrame(rows, "task_id long, run_id string, section_id int, window_index int, shard_index int, state string, priority int, est_raycasts long, attempts int, max_attempts int, worker_id string, lease_expires_at timestamp, started_at timestamp, finished_at timestamp, rows_written long, affinity_hit boolean, last_error string").cache()


def at(*when):
    return F.lit(dt.datetime(*when)).cast("timestamp")


def reports(spark, *rows, extra=""):
    return spark.createDataFrame(rows, "task_id long, worker_id string" + extra)


RUNS = [("r", 2), ("other", 100)]


def test_queue(spark):
    t = tasks(spark)
    shards = spark.createDataFrame([(0, "online"), (1, "online"), (2, "draining")], "shard_index int, state string")
    runs = spark.createDataFrame(RUNS, "run_id string, max_tasks_per_shard int")
    now = at(2026, 1, 1)
    with pytest.raises(ValueError, match="does not exist"):
        queue.claim(t, shards, runs, "nope", "w1", now)
    after, got = queue.claim(t, shards, runs, "r", "w1", now)
    best = max((r for r in t.collect() if r.shard_index != 2), key=lambda r: (r.est_raycasts, -r.task_id))
    first = got.first()
    assert first.task_id == best.task_id and first.affinity_hit is False and first.attempts == 1
    assert (first.lease_expires_at - first.started_at).total_seconds() == 120
    after, got = queue.claim(after, shards, runs, "r", "w2", now, section=9000, window=0)
    assert got.first().task_id == 0 and got.first().affinity_hit is True
    after, got = queue.claim(after, shards, runs, "r", "w2", now, section=9002, window=0)
    assert got.first().affinity_hit is False
    after = after.cache()
    assert {r.shard_index: r.free for r in queue.admissible_shards(after, shards, runs, "r").collect()}.keys() <= {0, 1}
    assert queue.admissible_shards(after, shards, runs, "nope").count() == 0
    assert {r.shard_index for r in queue.admissible_shards(after, shards, runs, "other").collect()} == {0, 1}
    held = after.where("state = 'running'").first()
    report = ", rows_written long, raycasts_done long"
    same, answer = queue.complete(after, reports(spark, (held.task_id, "impostor", 5, 1), (99, "w1", 5, 1), extra=report), now)
    assert same.exceptAll(after).count() == 0 and {(r.task_id, r.ok) for r in answer.collect()} == {(held.task_id, False), (99, False)}
    done, answer = queue.complete(after, reports(spark, (held.task_id, held.worker_id, 5, 1), extra=report), now)
    done = done.where("state = 'done'").first()
    assert (done.task_id, done.rows_written, done.lease_expires_at, answer.first().ok) == (held.task_id, 5, None, True)
    beaten, answer = queue.heartbeat(after, reports(spark, (held.task_id, held.worker_id, None), extra=", raycasts_done long"), at(2026, 1, 2))
    assert answer.first().ok and beaten.where(F.col("task_id") == held.task_id).first().lease_expires_at == dt.datetime(2026, 1, 2, 0, 2)
    failed, _ = queue.fail(after, reports(spark, (held.task_id, held.worker_id, "x" * 5000), extra=", error string"), now)
    back = failed.where(F.col("task_id") == held.task_id).first()
    assert (back.state, len(back.last_error), back.worker_id, back.finished_at) == ("pending", 4000, None, None)
    again, got = queue.claim(failed, shards, runs, "r", "w9", at(2026, 3, 1), section=held.section_id, window=held.window_index)
    assert got.first().task_id == held.task_id and got.first().started_at == dt.datetime(2026, 1, 1) and got.first().attempts == 2
    late = at(2027, 1, 1)
    reaped = queue.reap_expired(after, late)
    assert reaped.where("state = 'running'").count() == 0 and queue.reap_expired(after, late, "other").where("state = 'running'").count() == 3
    assert {r.last_error for r in reaped.where("last_error IS NOT NULL").collect()} == {"lease expired (last heartbeat never, worker w1)", "lease expired (last heartbeat never, worker w2)"}
    spent = after.withColumn("attempts", F.lit(2))
    over = queue.reap_expired(spent, late).where("state = 'failed'").collect()
    assert len(over) == 3 and {r.finished_at for r in over} == {None}
    assert queue.run_progress(after).first().running == 3
    after = after.withColumn("sim_date", F.lit(NOON.date()))
    whole, left = queue.complete_or_outstanding(after, "r", 5)
    assert not whole and left.count() == 5
    assert queue.complete_or_outstanding(after.withColumn("state", F.lit("done")), "r")[0] and not queue.complete_or_outstanding(after, "other")[0]


def test_claims_stop_at_the_cap(spark):
    t = tasks(spark)
    shards = spark.createDataFrame([(0, "online"), (1, "online"), (2, "draining")], "shard_index int, state string")
    runs = spark.createDataFrame(RUNS, "run_id string, max_tasks_per_shard int")
    taken = []
    for i in range(6):
        t, got = queue.claim(t, shards, runs, "r", f"w{i}", at(2026, 1, 1))
        t = spark.createDataFrame(t.collect(), t.schema)
        taken += got.collect()
    assert len(taken) == 4 and sorted(r.shard_index for r in taken) == [0, 0, 1, 1]
    lpt = queue.claimable(tasks(spark), shards, runs, "r").collect()
    assert {r.task_id for r in lpt} == {r.task_id for r in taken}


def test_registry_of_shards(spark):
    kind = "shard_index int, host string, port int, dbname string, state string, vcpu int, ram_gb int, last_seen_at timestamp"
    old = spark.createDataFrame([(0, "a", 1, "x", "draining", 8, None, None), (1, "b", 2, "y", "online", 8, 64, None)], kind)
    new = spark.createDataFrame([(0, "c", None, None, None, 32), (2, "d", 9, "z", 4, 4)], "shard_index int, host string, port int, dbname string, vcpu int, ram_gb int")
    got = {r.shard_index: tuple(r)[1:7] + (r.last_seen_at is not None,) for r in queue.register_shards(old, new, at(2026, 1, 1)).collect()}
    assert got == {0: ("c", 5432, "shard_0", "draining", 8, 32, True), 1: ("b", 2, "y", "online", 8, 64, False), 2: ("d", 9, "z", "online", 4, 4, True)}
    assert {r.state for r in queue.set_shard_state(old, 1, "offline").collect()} == {"draining", "offline"}
    with pytest.raises(ValueError):
        queue.set_shard_state(old, 1, "gone")


def test_pack_round_trip(spark, street):
    _, facts = street
    k = facts.withColumn("k", F.expr("cast((unix_micros(cast(datetime AS timestamp)) - unix_micros(timestamp'2026-06-15 15:00:00')) / 180000000 AS int)")).select("sample_point_id", "k", "is_sunlit")
    again = exposure.unpack_words(exposure.pack_words(k, ["sample_point_id"]), ["sample_point_id"])
    assert [r["rows"] for r in integrity.differences(k, again).collect()] == [0, 0]
    rng = random.Random(2)
    steps = [(i, s, rng.random() < 0.5) for i in range(5) for s in rng.sample(range(360), 90)]
    gaps = spark.createDataFrame(steps, "id int, k int, is_sunlit boolean")
    again = exposure.unpack_words(exposure.pack_words(gaps.unionByName(gaps.limit(7)), ["id"]), ["id"])
    assert sorted(tuple(r) for r in again.collect()) == sorted(steps)


def test_upsert_replaces_null_keys(spark):
    old = spark.createDataFrame([(1, None, 1), (1, "a", 2)], "k int, s string, v int")
    new = spark.createDataFrame([(1, None, 3)], "k int, s string, v int")
    twice = exposure.upsert(exposure.upsert(old, new, ["k", "s"]), new, ["k", "s"])
    assert sorted((r.s or "", r.v) for r in twice.collect()) == [("", 3), ("a", 2)]


def test_walk_tells_sections_apart(spark, street):
    points, facts = street
    leaf = lambda df, section: df.withColumn("section_id", F.lit(section))
    other = leaf(facts, 2).withColumn("is_sunlit", F.lit(False))
    both = leaf(facts, 1).unionByName(other).withColumns({"sim_date": F.to_date("datetime"), "window_index": timegrid.window_index(F.col("datetime"))})
    ask = request(spark, (1, "e1", NOON.replace(hour=16), False, 0.5))
    want, got = (exposure.directional_cost(ask, leaf(points, 1), f).collect() for f in (facts, both))
    assert want == got and len(got) == 1


def test_rollup_is_observed(spark, street):
    points, facts = street
    own = facts.withColumn("section_id", F.lit(1)).drop("edge_id")
    df, seen = exposure.observed_rollup(own, points)
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["edge_steps"] == 60 and seen.get["samples"] == 201 * 60
    assert exposure.plain_facts(own).columns == ["sample_point_id", "datetime", "is_sunlit"] and exposure.plain_rollup(df).columns == ["edge_id", "datetime", "sunlit_sum"]
    exposure.require_known_edges(request(spark, (1, "e1", NOON, False, 0.5)), points)
    with pytest.raises(ValueError, match="nowhere"):
        exposure.require_known_edges(request(spark, (1, "nowhere", NOON, False, 0.5)), points)


def test_section_rollup_needs_known_sections(spark, street):
    points, facts = street
    own = facts.withColumn("section_id", F.lit(1)).drop("edge_id")
    got = exposure.rollup_sections(own, points.withColumn("section_id", F.lit(1)), [1])
    assert got.exceptAll(exposure.edge_rollup(own.join(points, "sample_point_id"))).count() == 0 and got.count() == 60
    with pytest.raises(ValueError, match="without samples"):
        exposure.rollup_sections(own, points.withColumn("section_id", F.lit(1)), [1, 9])


def test_fact_leaves_are_replaced_whole(spark, street, tmp_path):
    _, facts = street
    path = f"file://{tmp_path}/facts"
    leaf = facts.select("sample_point_id", "datetime", "is_sunlit", F.lit(0).alias("section_id"), F.to_date("datetime").alias("sim_date"), timegrid.window_index(F.col("datetime")).alias("window_index"))
    files.write_facts(leaf, path)
    files.write_facts(leaf.withColumn("section_id", F.lit(1)), path)
    files.write_facts(leaf.withColumn("is_sunlit", F.lit(False)), path)
    assert files.read_facts(spark, path).count() == 2 * 201 * 60
    assert files.read_facts(spark, path, section=0).where("is_sunlit").count() == 0
    assert files.read_facts(spark, path, section=1, day=dt.date(2026, 6, 15), windows=[4]).count() == 201 * 60
    sizes = spark.createDataFrame([(0, 201), (1, 200)], "section_id int, sample_count int")
    bad = integrity.leaf_sizes(files.read_facts(spark, path), sizes, 60).collect()
    assert [(r.section_id, r.delta) for r in bad] == [(1, 60)]
    due = spark.createDataFrame([(0, dt.date(2026, 6, 15), 4), (3, dt.date(2026, 6, 15), 0)], "section_id int, sim_date date, window_index int")
    empty = integrity.leaf_sizes(files.read_facts(spark, path), sizes.unionByName(sizes.limit(1).withColumns({"section_id": F.lit(3)})), 60, due)
    assert sorted((r.section_id, r.actual, r.expected) for r in empty.collect()) == [(1, 12060, 12000), (3, 0, 12060)]
    leaves = {r["name"]: r["rows"] for r in catalog.leaves(files.read_facts(spark, path)).collect()}
    assert leaves == {f"exposure_s{i}_20260615_w4": 201 * 60 for i in (0, 1)}
    assert catalog.tree_size(spark, path) > 0 == catalog.tree_size(spark, path + "/none")
    files.delete_leaves(spark, path, [(1, "2026-06-15", 4), (8, "2026-06-15", 4)])
    assert files.read_facts(spark, path).count() == 201 * 60
    (tmp_path / "facts" / "_temporary" / "0").mkdir(parents=True)
    assert len(files.sweep_unfinished(spark, path)) == 1 and files.sweep_unfinished(spark, path) == []


def test_files(spark, tmp_path):
    (tmp_path / "trees.csv").write_text("unity_x,unity_z,shade_norm,extra\n1.5,2,0.5,a\nbad,2,0.1,b\n3,4,,c\n")
    got = files.read_trees(spark, f"file://{tmp_path}/trees.csv").collect()
    assert sorted((r.x, r.y, r.z, r.shade_norm) for r in got if r.shade_norm) == [(1.5, 2.0, -112.0, 0.5)] and len(got) == 2
    (tmp_path / "g.json").write_text('{"vertices":[{"id":"a","x":1,"y":9,"z":2},{"id":"b","x":3,"y":9,"z":4}],"edges":[{"from":"a","to":"b"},{"a":"b","b":"a"}]}')
    nodes, edges = files.read_graph(spark, f"file://{tmp_path}/g.json")
    assert sorted((r.id, r.x, r.y) for r in nodes.collect()) == [("a", 1.0, 2.0), ("b", 3.0, 4.0)] and joins.edge_set(edges, "a", "b").count() == 1
    (tmp_path / "r.csv").write_text('date,path,start_time_hhmm\n2026-06-15,"START,a,b,END",1600\n2026-06-15,"a,zz",\n')
    routes = files.read_routes(spark, f"file://{tmp_path}/r.csv", nodes)
    assert sorted((r.id, r.position) for r in routes.collect()) == [("a", 1), ("b", 2)]
    (tmp_path / "e.bin").write_bytes(files.ephemeris_bytes(2026, [(1.5, -2.5), (2.0, 3.0)])[:-4] + struct.pack("<f", 3.0))
    e = files.read_ephemeris(spark, f"file://{tmp_path}/e.bin").orderBy("minute").collect()
    assert [(r.year, r.doy, r.minute, r.azimuth, r.elevation) for r in e] == [(2026, 1, 0, 1.5, -2.5), (2026, 1, 1, 2.0, 3.0)]
    (tmp_path / "e.csv").write_text("datetime,azimuth,apparent_elevation\n2026-01-01,1.0,2.0\n2026-01-01,x,\n2026-01-01,3.0,4.0\n")
    c = files.read_ephemeris_csv(spark, f"file://{tmp_path}/e.csv").orderBy("i").collect()
    assert [(r.azimuth, r.elevation) for r in c] == [(1.0, 2.0), (1.0, 2.0), (3.0, 4.0)]
    (tmp_path / "od.csv").write_text("wkdy_8,min_wkdy_8,max_wkdy_8\n10,0.5,0.7\n30,0.1,\n30,0.1,0.3\n")
    m = {(r.day_type, r.hour): (r.mean_min, r.mean_max) for r in analytics.weighted_od_mean(files.read_od(spark, [f"file://{tmp_path}/od.csv"])).collect()}
    assert m["wkdy", 8] == (0.2, 0.4) and m["wknd", 3] == (0.0, 0.0) and len(m) == 36
    s = files.insert_statements(spark.createDataFrame([(1, "it's", True, None)], "a int, b string, c boolean, d double"), "t").first()[0]
    assert s == "INSERT INTO t VALUES (1, 'it''s', TRUE, NULL);"


def test_graph(spark):
    nodes = spark.createDataFrame([(0, 0.0, 0.0), (1, 10.0, 0.0), (2, 20.0, 0.1), (3, 30.0, 0.0), (4, 20.0, 10.0), (5, 38.0, 1.0)], "id long, x double, y double")
    edges = spark.createDataFrame([(0, 1), (1, 2), (2, 3), (2, 4)], "a long, b long")
    assert {tuple(r) for r in graph.dissolve_straight(edges, nodes).collect()} == {(0, 2), (2, 3), (2, 4)}
    assert {r.node for r in graph.spurs(edges).collect()} == {3, 4}
    assert [(r.node, r.to) for r in graph.bridges(edges, nodes).collect()] == [(3, 5)]
    assert {r.path[-1] for r in graph.simple_paths(edges, spark.createDataFrame([(0,)], "node long"), 3).collect()} == {3}
    cells = graph.rasterise(spark.createDataFrame([(0.0, 0.0, 4.0, 0.0, 0.0, 4.0)], "x1 double, y1 double, x2 double, y2 double, x3 double, y3 double"))
    assert {(r.cx, r.cy) for r in cells.collect()} == {(i, j) for i in range(4) for j in range(4) if i + j + 1 <= 4}
    square = spark.range(25).select((F.col("id") % 5).alias("cx"), F.expr("id div 5").alias("cy"))
    assert {(r.cx + 1, r.cy + 1) for r in graph.ridges(graph.distance_transform(square.select(F.col("cx") + 1, F.col("cy") + 1).toDF("cx", "cy"), 7, 7), 7, 7).select(F.col("cx") - 1, F.col("cy") - 1).toDF("cx", "cy").collect()} == {(3, 3)}
    d = {r.id: r.representative for r in graph.decluster(nodes, 10.05).collect()}
    assert set(d.values()) == {2}  # all in one chain; the member nearest the centroid
    assert {r.representative for r in graph.decluster(nodes, 8.0).collect()} == {0, 1, 2, 3, 4, 5}


def test_spikes(spark):
    step = lambda i: dt.datetime(2026, 6, 15, 3) + dt.timedelta(minutes=3 * i)
    counts = [0, 0, 5000, 4000, 900, 950, *range(1000, 1012)]
    rows = spark.createDataFrame([(step(i), n) for i, n in enumerate(counts)], "datetime timestamp_ntz, sunlit long")
    assert [r.datetime for r in analytics.sunrise_spikes(rows).orderBy("datetime").collect()] == [step(2), step(3)]
    late = spark.createDataFrame([(step(240 + i), n) for i, n in enumerate([9, 7, 8, 0, 1, 1])], "datetime timestamp_ntz, sunlit long")
    assert [r.datetime for r in analytics.sunset_spikes(late).orderBy("datetime").collect()] == [step(242), step(244)]


def test_streaming_matches_batch(spark, street, tmp_path):
    _, facts = street
    facts.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(facts.schema).parquet(f"{tmp_path}/in")
    q = streams.windowed_rollup(stream).writeStream.format("memory").queryName("rolled").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("rolled").agg(F.sum("sunlit_sum"), F.sum("sample_count")).first()
    assert got[1] == 201 * 60 and got[0] == facts.where("is_sunlit").count()
    leaf = stream.select("sample_point_id", "datetime", "is_sunlit", F.lit(0).alias("section_id"), F.to_date("datetime").alias("sim_date"), F.lit(4).alias("window_index"))
    for n in range(2):
        streams.ingest_leaves(leaf, f"{tmp_path}/out", f"{tmp_path}/check{n}").awaitTermination()
    assert files.read_facts(spark, f"{tmp_path}/out").count() == 201 * 60
