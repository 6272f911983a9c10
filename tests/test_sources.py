"""Files, catalogue, settings, checks, reports and streams."""

import datetime as dt
import json
import struct
import warnings

import pytest
from pyspark.sql import functions as F

from sunweave.functions import solar, spatial
from sunweave.operators import analytics, capacity, integrity, report
from sunweave.sources import catalog, config, files, shared
from sunweave.streaming import exposure as streams


def test_graph_document_round_trip(spark, tmp_path):
    nodes = spark.createDataFrame([("a", 1.5, 2.0, -112.0), ("b", 3.0, 4.0, 0.0), ("c", 9.0, 9.0, 1.0)], "id string, x double, y double, z double")
    edges = spark.createDataFrame([("a", "b"), ("b", "c")], "a string, b string")
    files.write_graph(nodes, edges, f"file://{tmp_path}/g")
    text = "".join(p.read_text() for p in sorted((tmp_path / "g").glob("part-*")))
    assert json.loads(text)["vertices"][0] == {"id": "a", "x": 1.5, "y": -112.0, "z": 2.0}
    n, e = files.read_graph(spark, f"file://{tmp_path}/none", f"file://{tmp_path}/g")
    assert sorted(map(tuple, n.collect())) == sorted(map(tuple, nodes.collect())) and sorted(map(tuple, e.collect())) == [("a", "b"), ("b", "c")]
    n, e = files.read_graph(spark, f"file://{tmp_path}/g", box=(5.0, 5.0, 0.0, 0.0))
    assert {r.id for r in n.collect()} == {"a", "b"} and [tuple(r) for r in e.collect()] == [("a", "b")]
    with pytest.raises(FileNotFoundError):
        files.read_graph(spark, f"file://{tmp_path}/none")
    files.write_points_csv(nodes, f"file://{tmp_path}/p")
    lines = [x for p in sorted((tmp_path / "p").glob("part-*")) for x in p.read_text().splitlines()]
    assert "point_id,x,y,z" in lines and "a,1.5000,-112.0000,2.0000" in lines
    files.write_graph(nodes.limit(0), edges.limit(0), f"file://{tmp_path}/empty")
    assert json.loads("".join(p.read_text() for p in (tmp_path / "empty").glob("part-*"))) == {"vertices": [], "edges": []}


def test_missing_trees_warn(spark, tmp_path):
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert files.read_trees(spark, f"file://{tmp_path}/none.csv").collect() == []
    assert any("no trees" in str(w.message) for w in seen)


def test_routes(spark, tmp_path):
    nodes = spark.createDataFrame([("a", 1.0, 2.0)], "id string, x double, y double")
    (tmp_path / "r.csv").write_text('date,path,start_time_hhmm,length_m\n2026-06-15,"START,a,END",1600,12.5\n2026-06-16,"a,zz",900,bad\n')
    got = {(r.date, r.exposure, r.length_m, r.position, r.id) for r in files.read_routes(spark, f"file://{tmp_path}/r.csv", nodes).collect()}
    assert got == {("2026-06-15", 0.0, 12.5, 1, "a"), ("2026-06-16", 0.0, 0.0, 0, "a")}
    (tmp_path / "s.csv").write_text("date,path\n1,2\n")
    with pytest.raises(ValueError, match="start_time_hhmm"):
        files.read_routes(spark, f"file://{tmp_path}/s.csv", nodes)


def test_ephemeris_files(spark, tmp_path):
    rows = spark.createDataFrame([(2026, 1, 0, 1.5, -2.0), (2026, 1, 2, 4.0, None), (2027, 1, 1, 9.0, 8.0)], "year int, doy int, minute int, azimuth double, elevation double")
    files.write_ephemeris(rows, f"file://{tmp_path}/e")
    got = sorted(map(tuple, files.read_ephemeris(spark, f"file://{tmp_path}/e/*.bin").collect()))
    assert got == [(2026, 1, 0, 1.5, -2.0), (2026, 1, 1, 1.5, -2.0), (2026, 1, 2, 4.0, -2.0), (2027, 1, 0, 0.0, 0.0), (2027, 1, 1, 9.0, 8.0)]
    (tmp_path / "e.csv").write_text("datetime,azimuth,apparent_elevation\n2026-01-01 00:00:00,1.0,2.0\n2026-01-01 00:01:00,x,\n2026-01-01 00:02:00,3.0,4.0\n")
    files.convert_ephemeris(spark, f"file://{tmp_path}/e.csv", f"file://{tmp_path}/c")
    assert sorted((r.minute, r.azimuth, r.elevation) for r in files.read_ephemeris(spark, f"file://{tmp_path}/c/*.bin").collect()) == [(0, 1.0, 2.0), (1, 1.0, 2.0), (2, 3.0, 4.0)]
    files.write_ephemeris_csv(rows.where("year = 2026"), f"file://{tmp_path}/out")
    assert {r.datetime: r.azimuth for r in files.read_ephemeris_csv(spark, f"file://{tmp_path}/out").collect()} == {"2026-01-01 00:00:00": 1.5, "2026-01-01 00:02:00": 4.0}
    with pytest.raises(ValueError):
        files.write_ephemeris(rows.limit(0), f"file://{tmp_path}/none")
    (tmp_path / "bad.bin").write_bytes(struct.pack("<4shhii", b"SLRD", 1, 2026, 5, 0))
    with pytest.raises(Exception, match="without entries"):
        files.read_ephemeris(spark, f"file://{tmp_path}/bad.bin").collect()


def test_ephemeris_lookup(spark):
    minutes = [(1, m, (350.0 + 10 * m) % 360, float(m)) for m in range(1440)]
    e = spark.createDataFrame(minutes, "doy int, minute int, azimuth double, elevation double")
    t = [dt.datetime(2026, 1, 1, 0, 0, 30), dt.datetime(2026, 1, 1, 23, 59, 30), dt.datetime(2026, 5, 1, 1, 0, 0)]
    times = spark.createDataFrame([(x,) for x in t], "datetime timestamp_ntz")
    got = {r.datetime: (r.azimuth, r.elevation) for r in solar.ephemeris_at(times, e).collect()}
    assert got[t[0]] == (355.0, 0.5) and got[t[1]][1] == 719.5 and got[t[2]][1] == 1439.0
    assert {(r.azimuth, r.elevation) for r in solar.ephemeris_at(times, e.limit(0)).collect()} == {(0.0, -90.0)}
    one = spark.range(1).select(solar.blended_angle(F.lit(9.0)).alias("up"), solar.blended_angle(F.lit(-9.0)).alias("down"), solar.blended_angle(F.lit(0.0)).alias("mid"), solar.sun_vector(F.lit(90.0), F.lit(0.0)).alias("v"), solar.clock(F.lit(25.5)).alias("c")).first()
    assert (one.up, one.down, one.mid, round(one.v.x, 9), one.c) == (-90.0, -9.0, -45.0, 1.0, "01:30")


def test_appended_facts(spark, tmp_path):
    path = f"file://{tmp_path}/facts"
    facts = spark.createDataFrame([("p", dt.datetime(2026, 1, 1, 3), True), ("q", dt.datetime(2026, 1, 1, 3, 3), False)], "sample_point_id string, datetime timestamp_ntz, is_sunlit boolean")
    assert files.missing_facts(facts.drop("is_sunlit"), path).count() == 2
    files.append_facts(facts.limit(1), path)
    assert [r.sample_point_id for r in files.missing_facts(facts.select("sample_point_id", "datetime"), path).collect()] == ["q"]
    files.append_facts(facts.where("sample_point_id = 'q'"), path)
    assert sorted(map(tuple, files.read_appended_facts(spark, path).collect())) == sorted(map(tuple, facts.collect()))


def test_dumps(spark, tmp_path):
    df = spark.createDataFrame([(1, "it's", None, dt.date(2026, 1, 1))], "a int, b string, c double, d date")
    assert files.create_statement(df, "t") == "CREATE TABLE t (a INTEGER, b TEXT, c DOUBLE PRECISION, d DATE);"
    files.dump_script({"t": df}, f"file://{tmp_path}/sql")
    lines = [x for p in (tmp_path / "sql" / "t").glob("part-*") for x in p.read_text().splitlines()]
    assert sorted(lines) == ["CREATE TABLE t (a INTEGER, b TEXT, c DOUBLE PRECISION, d DATE);", "INSERT INTO t VALUES (1, 'it''s', NULL, '2026-01-01');"]
    import duckdb

    con = duckdb.connect()
    for line in sorted(lines):
        con.execute(line)
    assert con.execute("SELECT b FROM t").fetchall() == [("it's",)]
    files.dump_tables({"t": df}, f"file://{tmp_path}/backup", "parquet")
    assert files.restore_tables(spark, f"file://{tmp_path}/backup", ["t"])["t"].collect() == df.collect()
    files.dump_tables({"t": df}, f"file://{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/csv/t").first().b == "it's"
    assert {r.table: r.bytes > 0 for r in catalog.tables(spark, f"file://{tmp_path}/backup").collect()} == {"t": True}
    assert [(r.column, r.type) for r in catalog.columns({"t": df}).orderBy("position").collect()] == [("a", "int"), ("b", "string"), ("c", "double"), ("d", "date")]
    wkt = spark.range(1).select(files.point_wkt(F.lit(1.0), F.lit(2.0), F.lit(3.0)), files.line_wkt((F.lit(1.0), F.lit(2.0), F.lit(3.0)), (F.lit(4.0), F.lit(5.0), F.lit(6.0)))).first()
    assert tuple(wkt) == ("POINT Z (1.0 2.0 3.0)", "LINESTRING Z (1.0 2.0 3.0, 4.0 5.0 6.0)")


def test_aggregates_are_made_once(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.createDataFrame([(1, 8, 3, 4, 75.0), (1, 9, 1, 2, 50.0), (2, 8, 0, 0, None)], "month int, hour int, sunlit_count long, total_count long, percentage double")

    path = f"file://{tmp_path}/cache"
    one, two = files.cached(spark, path, make), files.cached(spark, path, make)
    assert len(made) == 1 and one.count() == two.count() == 3
    doc = json.loads(analytics.month_hour_document(one).first().document)
    assert doc["1"]["9"] == {"sunlit_count": 1, "total_count": 2, "percentage": 50.0} and set(doc) == {"1", "2"}


def test_settings():
    c = config.RunConfig.load({"SUNWEAVE_WINDOWS": "4", "SUNWEAVE_AFFINITY": "off", "SUNWEAVE_RUN_ID": " x ", "SUNWEAVE_STEP_MINUTE": ""})
    assert (c.windows, c.affinity, c.run_id, c.step_minute) == (4, False, "x", 3)
    for name, value in (("WINDOWS", "7"), ("STEP_MINUTE", "x"), ("LEASE_SECONDS", "80"), ("AFFINITY", "maybe"), ("END_MINUTE", "100"), ("GUARD_DEGREES", "95")):
        with pytest.raises(ValueError):
            config.RunConfig.load({"SUNWEAVE_" + name: value})
    assert config.planned_dates("6.21, 1.1 6.21", 2026) == [dt.date(2026, 1, 1), dt.date(2026, 6, 21)]
    for bad in ("6", "13.1", "2.30", "a.b"):
        with pytest.raises(ValueError, match="bad date"):
            config.planned_dates(bad, 2026)
    assert config.typed_dates("6.21, x, 2.30 7") == [(6, 21), (2, 30)]


def test_checks(spark):
    df = spark.createDataFrame([(1, 2), (3, 3), (None, 1)], "lo int, hi int")
    assert integrity.checked(df.where("hi <> 3"), integrity.CHECKS["leaf"]).count() == 2
    with pytest.raises(Exception, match="check failed"):
        integrity.checked(df, integrity.CHECKS["leaf"]).collect()
    assert [r.violations for r in integrity.broken(df, {"leaf": "lo < hi"}).collect()] == [1]
    shard = spark.createDataFrame([(1,), (1,)], "shard_index int")
    integrity.require_shard(shard, 1)
    with pytest.raises(ValueError):
        integrity.require_shard(shard, 2)
    texts = spark.createDataFrame([("123e4567-e89b-12d3-a456-426614174000",), ("{123E4567E89B12D3A456426614174000}",), ("nope",), (None,)], "u string")
    assert [r.v for r in texts.select(integrity.valid_uuid(F.col("u")).alias("v")).collect()] == [True, True, False, None]


def test_reports(spark):
    n = spark.createDataFrame([(7.0,), (4_300.0,), (5_600_000.0,), (2.5e12,)], "n double")
    assert [r.t for r in n.select(report.human(F.col("n")).alias("t")).collect()] == ["7", "4K", "6M", "2.5T"]
    s = spark.createDataFrame([(9.4,), (61.25,), (7200.0,)], "s double")
    assert [r.t for r in s.select(report.duration(F.col("s")).alias("t")).collect()][::2] == ["9 s", "2.00 h"]
    assert spark.range(1).select(report.bar(F.lit(0.5), 4)).first()[0] == "##.."
    blocks = analytics.block_extents(spark.createDataFrame([(1, 0.0, 0.0), (1, 4.0, 2.0), (2, 5.0, 5.0)], "block int, x double, y double"))
    paths = spark.createDataFrame([(1, [7, 8])], "block int, path array<int>")
    lines = {r.block: r.line for r in report.partition_lines(blocks, paths).collect()}
    assert lines == {1: "block 1: 2 nodes, (0.0, 0.0) to (4.0, 2.0), centre (2.0, 1.0); 7 -> 8", 2: "block 2: 1 nodes, (5.0, 5.0) to (5.0, 5.0), centre (5.0, 5.0); no path"}


def test_capacity_constants():
    assert round(capacity.halo_metres()) == 2286 and round(capacity.annulus_km2(), 1) == 31.0 and capacity.working_set_km2() < capacity.annulus_km2()


def test_space_functions(spark):
    c = lambda *v: [F.lit(float(x)) for x in v]
    one = spark.range(1).select(
        spatial.in_box_3d(*c(1, 1, 6), (0, 0, 0), (5, 5, 5), 1.0).alias("pad"), spatial.in_box_3d(*c(1, 1, 6), (5, 5, 5), (0, 0, 0)).alias("out"),
        spatial.distance_3d(c(0, 0, 0), c(2, 3, 6)).alias("d"), spatial.lerp(*c(2, 4, 0.25)).alias("l"),
        spatial.in_triangle(*c(1, 1), [tuple(c(0, 0)), tuple(c(0, 4)), tuple(c(4, 0))]).alias("in"), spatial.in_triangle(*c(3, 3), [tuple(c(0, 0)), tuple(c(0, 4)), tuple(c(4, 0))]).alias("beyond"),
        spatial.section_centre(F.lit(130), 0.0, 0.0, 100.0).alias("m"), spatial.section_bounds(F.lit(130), 0.0, 0.0, 100.0, 5.0).alias("b"),
    ).first()
    assert (one.pad, one.out, one.d, one.l, one["in"], one.beyond) == (True, False, 7.0, 2.5, True, False)
    assert tuple(one.m) == (250.0, 150.0) and tuple(one.b) == (195.0, 95.0, 305.0, 205.0)


def test_shared_folder_is_needed_on_a_cluster(spark):
    class Session:
        class conf:
            get = staticmethod(lambda name, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(Session)


def test_windows_and_sessions_of_a_stream(spark, tmp_path):
    t = lambda m: dt.datetime(2026, 1, 1, 10) + dt.timedelta(minutes=m)
    rows = spark.createDataFrame([("e", t(m), m % 2 == 0) for m in (0, 10, 20, 90, 100)], "edge_id string, datetime timestamp, is_sunlit boolean")
    rows.write.parquet(f"{tmp_path}/in")
    schema = "edge_id string, datetime timestamp, is_sunlit boolean"

    def run(df, name):
        q = df.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name)

    sessions = run(streams.session_rollup(streams.read_facts_stream(spark, f"{tmp_path}/in", schema, 1)), "sessions")
    assert sorted((r.session_start, r.sample_count) for r in sessions.collect()) == [(t(0), 3), (t(90), 2)]
    sliding = run(streams.windowed_rollup(streams.read_facts_stream(spark, f"{tmp_path}/in", schema), width="1 hour", slide="30 minutes"), "sliding")
    assert sliding.agg(F.sum("sample_count")).first()[0] == 10
    last = run(streams.latest_state(streams.read_facts_stream(spark, f"{tmp_path}/in", schema).select(F.lit(1).alias("task_id"), F.col("edge_id").alias("worker_id"), F.col("datetime").alias("lease_expires_at"))), "latest")
    assert [(r.task_id, r.lease_expires_at) for r in last.collect()] == [(1, t(100))]


def test_lease_states(spark, tmp_path):
    t = lambda s: dt.datetime(2026, 1, 1) + dt.timedelta(seconds=s)
    schema = "task_id long, worker_id string, event string, at timestamp, lease_seconds int"
    batches = [
        [(1, "w1", "claim", t(0), 60), (1, "w2", "claim", t(10), 60), (1, "w2", "heartbeat", t(20), 60), (1, "w1", "heartbeat", t(30), 60)],
        [(1, "w2", "claim", t(100), 60), (1, "w1", "complete", t(110), 60), (1, "w2", "complete", t(120), 60), (2, "w3", "claim", t(121), 10)],
        [(3, "w4", "claim", t(1000), 10)],
    ]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.parquet(f"{tmp_path}/in{i}")
    (tmp_path / "in").mkdir()
    states = streams.lease_states(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
    q = states.writeStream.format("memory").queryName("leases").outputMode("append").start()
    for i in range(len(batches)):
        for f in (tmp_path / f"in{i}").glob("part-*.parquet"):
            f.rename(tmp_path / "in" / f"{i}-{f.name}")
        q.processAllAvailable()
    q.stop()
    got = {(r.task_id, r.worker_id, r.event): (r.accepted, r.state) for r in spark.table("leases").collect()}
    assert got[1, "w1", "claim"] == (True, "running") and got[1, "w1", "heartbeat"] == (True, "running") and got[1, "w2", "heartbeat"] == (False, "running")
    assert got[1, "w2", "complete"] == (True, "done") and got[1, "w1", "complete"] == (False, "running")
    assert got[2, "w3", "expired"] == (True, "pending")
