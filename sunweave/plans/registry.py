"""All queries of the engine by name, with the SQL that another engine can check them by."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunweave.functions import ids, solar, timegrid
from sunweave.functions import spatial as geo
from sunweave.operators import analytics, capacity, exposure, graph, integrity, queue, report, topology
from sunweave.operators import spatial as joins
from sunweave.plans.views import DAY, Views, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(views: str = "", sql: str | None = None):
    """Registers a function of Views under its name, with its SQL over the named views if there is any."""

    def add(f: Callable[[Views], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[f.__name__] = with_views(views, sql)
        return f

    return add


def _texts(df: DataFrame, *names: str) -> DataFrame:
    """Dates as text, which other engines' clients give alike."""
    return df.withColumns({n: F.col(n).cast("string") for n in names})


# --- facts and rollups ----------------------------------------------------------------------------------------------------


@query("rollup", "SELECT * FROM rollup")
def edge_rollup(v):
    return exposure.edge_rollup(v.samples())


@query("rollup", "SELECT section_id, count(*) AS edge_steps, CAST(sum(sample_count) AS BIGINT) AS samples FROM rollup GROUP BY section_id")
def rollup_all_sections(v):
    return exposure.edge_rollup(v.samples()).groupBy("section_id").agg(F.count("*").alias("edge_steps"), F.sum("sample_count").alias("samples"))


@query("samples", "SELECT edge_id, datetime, CAST(sum(CAST(is_sunlit AS INTEGER)) AS BIGINT) AS sunlit_sum FROM samples WHERE (edge_id, datetime) NOT IN (SELECT (edge_id, datetime) FROM samples WHERE sample_point_id % 3 = 0) GROUP BY ALL")
def edge_rollup_v1_antijoin(v):
    s = v.samples()
    new = s.groupBy("edge_id", "datetime").agg(F.sum(F.col("is_sunlit").cast("int")).alias("sunlit_sum"))
    return exposure.append_missing(new, s.where("sample_point_id % 3 = 0").select("edge_id", "datetime"))


@query("rollup", "SELECT * FROM rollup WHERE hour(datetime) <> 12 UNION ALL SELECT section_id, edge_id, datetime, 0, sample_count FROM rollup WHERE hour(datetime) = 12")
def upsert_rollup(v):
    r = exposure.edge_rollup(v.samples())
    new = r.where(F.hour("datetime") == 12).withColumn("sunlit_sum", F.lit(0).cast("long"))
    return exposure.upsert(r, new, ["section_id", "edge_id", "datetime"])


@query("points grid_facts", f"SELECT edge_id, row_number() OVER (PARTITION BY edge_id ORDER BY t, sample_point_id) - 1 AS step_index, t AS travelled_m, is_sunlit FROM (SELECT p.edge_id, p.sample_point_id, max(distance_from_start) OVER (PARTITION BY p.edge_id) - distance_from_start AS t, g.is_sunlit FROM points p JOIN grid_facts g USING (sample_point_id) WHERE p.edge_id = 7 AND g.datetime = TIMESTAMP '{DAY} 16:30:00')")
def edge_profile(v):
    return exposure.edge_profile(v.points(), v.grid_facts(), 7, F.to_timestamp_ntz(F.lit(f"{DAY} 16:30:00")), reverse=True)


_WALK = f"""
w AS (SELECT edge_id, sample_point_id, CASE WHEN {{rev}} THEN max(distance_from_start) OVER e - distance_from_start ELSE distance_from_start END AS t, max(distance_from_start) OVER e AS len, count(*) OVER e AS n FROM points WINDOW e AS (PARTITION BY edge_id)),
a AS (SELECT *, TIMESTAMP '{DAY} 16:00:30' + to_minutes(CAST(edge_id % 11 AS BIGINT)) + to_microseconds(CAST(round(t / 0.25 * 1000000) AS BIGINT)) AS arrival FROM w),
s AS (SELECT *, date_trunc('day', arrival) + to_minutes(CAST(180 + 3 * greatest(0, least(359, round_even((epoch_us(arrival - date_trunc('day', arrival)) / 60000000.0 - 180) / 3, 0))) AS BIGINT)) AS datetime FROM a),
l AS (SELECT s.*, g.is_sunlit FROM s LEFT JOIN grid_facts g USING (sample_point_id, datetime)),
r AS (SELECT *, row_number() OVER (PARTITION BY edge_id ORDER BY t, sample_point_id) - row_number() OVER (PARTITION BY edge_id, is_sunlit ORDER BY t, sample_point_id) AS run FROM l WHERE is_sunlit IS NOT NULL),
runs AS (SELECT edge_id, is_sunlit, run, min(t) AS from_m, max(t) AS to_m, count(*) AS samples FROM r GROUP BY ALL),
best AS (SELECT edge_id, max(to_m - from_m) AS best FROM runs WHERE is_sunlit GROUP BY edge_id)"""
_COST = """
SELECT l.edge_id AS request_id, l.edge_id, {rev} AS reverse, count(is_sunlit) AS samples, len AS edge_length_m, round(len / 0.25, 6) AS traverse_seconds,
 round(count(*) FILTER (is_sunlit) * (len / greatest(n - 1, 1)) / 0.25, 6) AS sun_seconds, round(count(*) FILTER (NOT is_sunlit) * (len / greatest(n - 1, 1)) / 0.25, 6) AS shade_seconds,
 CAST(round(CAST(100 * count(*) FILTER (is_sunlit) AS DECIMAL(38, 12)) / nullif(count(is_sunlit), 0), 2) AS DOUBLE) AS pct_sun,
 arg_min(is_sunlit, (t, sample_point_id)) FILTER (is_sunlit IS NOT NULL) AS entered_in_sun, arg_max(is_sunlit, (t, sample_point_id)) FILTER (is_sunlit IS NOT NULL) AS exited_in_sun,
 round(COALESCE(any_value(best) + len / greatest(n - 1, 1), 0), 6) AS longest_sun_run_m, count(DISTINCT datetime) FILTER (is_sunlit IS NOT NULL) AS timesteps_spanned
FROM l LEFT JOIN best ON best.edge_id = l.edge_id GROUP BY l.edge_id, len, n"""


def _walked(rev: str, last: str) -> str:
    return with_views("points grid_facts", "").rstrip() + ", " + _WALK.format(rev=rev) + last.format(rev=rev)


@query()
def directional_cost_fwd(v):
    return exposure.directional_cost(v.requests(False), v.points(), v.grid_facts())


@query()
def directional_cost_rev(v):
    return exposure.directional_cost(v.requests(True), v.points(), v.grid_facts())


@query()
def longest_run(v):
    lit = exposure.timed_walk(v.requests(False), v.points(), v.grid_facts()).where("is_sunlit IS NOT NULL")
    return exposure.sun_runs(lit)


ORACLES["directional_cost_fwd"] = _walked("false", _COST)
ORACLES["directional_cost_rev"] = _walked("true", _COST)
ORACLES["longest_run"] = _walked("false", " SELECT edge_id AS request_id, is_sunlit, run, from_m, to_m, samples FROM runs")


_PACKED = "SELECT edge_id, sample_point_id, CAST(k // 60 AS INTEGER) AS word, bit_or(CASE WHEN is_sunlit THEN 1::BIGINT << (k % 60) ELSE 0 END) AS bits, bit_or(1::BIGINT << (k % 60)) AS present FROM day_facts GROUP BY ALL"
_SAMPLE = ["edge_id", "sample_point_id"]


@query("points day_facts", _PACKED)
def pack_day(v):
    return exposure.pack_words(v.day_facts(), _SAMPLE)


@query("points day_facts", "SELECT edge_id, sample_point_id, k, is_sunlit FROM day_facts")
def unpack_day(v):
    return exposure.unpack_words(exposure.pack_words(v.day_facts(), _SAMPLE), _SAMPLE)


@query("", "SELECT * FROM (VALUES ('left', 0::BIGINT), ('right', 0::BIGINT)) t(side, rows)")
def exposure_bijection(v):
    facts = v.day_facts()
    again = exposure.unpack_words(exposure.pack_words(facts, _SAMPLE), _SAMPLE).select(*facts.columns)
    return integrity.differences(facts, again)


@query("points day_facts", f"SELECT edge_id, CAST(sum(bit_count(bits)) AS BIGINT) AS lit FROM ({_PACKED}) GROUP BY edge_id")
def popcount_total(v):
    return exposure.pack_words(v.day_facts(), _SAMPLE).groupBy("edge_id").agg(F.sum(F.bit_count("bits")).alias("lit"))


@query("points grid_facts", "SELECT section_id, edge_id, datetime, count(*) FILTER (is_sunlit) AS sunlit_sum, count(*) AS sample_count FROM grid_facts GROUP BY ALL")
def section_rollup(v):
    facts = v.grid_facts().select("section_id", "sample_point_id", "datetime", "is_sunlit")
    return exposure.rollup_sections(facts, v.points())


@query("points grid_facts", "SELECT section_id, edge_id, datetime, count(*) FILTER (is_sunlit) AS sunlit_sum, count(*) AS sample_count FROM grid_facts WHERE section_id IN (1, 4) GROUP BY ALL")
def section_rollup_some(v):
    facts = v.grid_facts().select("section_id", "sample_point_id", "datetime", "is_sunlit")
    return exposure.rollup_sections(facts, v.points(), [1, 4])


@query("points", "SELECT edge_id, count(*) AS sample_count FROM points GROUP BY edge_id")
def edge_samples(v):
    return exposure.samples_per_edge(v.points())


_BOX, _CLEARED = "x BETWEEN 500 AND 2500 AND y BETWEEN 1000 AND 9000", "CAST(datetime AS DATE) IN (DATE '2024-01-03', DATE '2024-01-05')"
_CLEAR = ([date(2024, 1, 3), date(2024, 1, 5)], (2500.0, 1000.0, 500.0, 9000.0))


@query("samples points placed_points", f"SELECT * FROM samples WHERE NOT ({_CLEARED} AND sample_point_id IN (SELECT sample_point_id FROM placed_points WHERE {_BOX}))")
def cleared_facts(v):
    return exposure.cleared(v.samples(), v.placed_points(), "sample_point_id", *_CLEAR)


@query("rollup points placed_points", f"SELECT * FROM rollup WHERE NOT ({_CLEARED} AND edge_id IN (SELECT edge_id FROM placed_points WHERE {_BOX}))")
def cleared_rollup(v):
    return exposure.cleared(exposure.edge_rollup(v.samples()), v.placed_points(), "edge_id", *_CLEAR)


@query("points trees", "SELECT sample_point_id, edge_id, least(round(COALESCE(s, 0), 6), 1) AS tree_value FROM (SELECT sample_point_id, edge_id, x, y, (SELECT sum(shade_norm) FROM trees t WHERE (t.x - p.x) * (t.x - p.x) + (t.y - p.y) * (t.y - p.y) <= 3600) AS s FROM (SELECT *, CAST(sample_point_id * 7919 % 5000 AS DOUBLE) AS x, CAST(sample_point_id * 104729 % 22000 AS DOUBLE) AS y FROM points) p)")
def tree_shade(v):
    return exposure.tree_values(v.placed_points(), v.trees(), 60.0)


@query("points trees", "SELECT edge_id, round(sum(least(round(COALESCE(s, 0), 6), 1)), 4) AS total_tree_value FROM (SELECT edge_id, (SELECT sum(shade_norm) FROM trees t WHERE (t.x - p.x) * (t.x - p.x) + (t.y - p.y) * (t.y - p.y) <= 3600) AS s FROM (SELECT *, CAST(sample_point_id * 7919 % 5000 AS DOUBLE) AS x, CAST(sample_point_id * 104729 % 22000 AS DOUBLE) AS y FROM points) p) GROUP BY edge_id")
def edge_tree_value(v):
    return exposure.tree_values(v.placed_points(), v.trees(), 60.0).groupBy("edge_id").agg(F.round(F.sum("tree_value"), 4).alias("total_tree_value"))


# --- analytics ----------------------------------------------------------------------------------------------------------


@query("rollup sections", "SELECT count(DISTINCT edge_id) AS edges, CAST(COALESCE(sum(sample_count), 0) AS BIGINT) AS samples, CAST(COALESCE(sum(sunlit_sum), 0) AS BIGINT) AS sunlit, CAST(round(CAST(100 * sum(sunlit_sum) AS DECIMAL(38, 12)) / nullif(sum(sample_count), 0), 3) AS DOUBLE) AS pct_sun, (SELECT count(DISTINCT shard_index) FROM sections) AS shards_read FROM rollup WHERE datetime >= TIMESTAMP '2024-01-10 12:00:00' AND datetime < TIMESTAMP '2024-01-10 13:00:00'")
def network_snapshot(v):
    hour = F.to_timestamp_ntz(F.lit("2024-01-10 12:00:00"))
    r = exposure.edge_rollup(v.samples()).where((F.col("datetime") >= hour) & (F.col("datetime") < F.to_timestamp_ntz(F.lit("2024-01-10 13:00:00"))))
    return analytics.network_snapshot(r.withColumn("datetime", hour), hour, v.sections())


_PROFILE = "SELECT month, hour, sunlit_count, total_count, CAST(round(CAST(100 * sunlit_count AS DECIMAL(38, 12)) / nullif(total_count, 0), 2) AS DOUBLE) AS percentage FROM (SELECT CAST(month(datetime) AS INTEGER) AS month, CAST(hour(datetime) AS INTEGER) AS hour, count(*) FILTER (is_sunlit) AS sunlit_count, count(*) AS total_count FROM samples WHERE minute(datetime) = 0 AND hour(datetime) BETWEEN 3 AND 21 GROUP BY ALL)"


@query("samples", _PROFILE)
def month_hour_profile(v):
    return analytics.month_hour_profile(v.samples())


@query("samples", f"SELECT month, round(avg(percentage), 6) AS mean_pct, row_number() OVER (ORDER BY round(avg(percentage), 6), month) - 1 AS rank FROM ({_PROFILE}) GROUP BY month")
def month_ranks(v):
    return analytics.month_ranks(analytics.month_hour_profile(v.samples()))


@query("samples", "SELECT strftime(datetime, '%Y-%m') AS month, count(*) AS rows, count(*) FILTER (is_sunlit) AS sunlit FROM samples GROUP BY 1")
def monthly_totals(v):
    return analytics.monthly_totals(v.samples())


@query("counts", "SELECT * FROM counts")
def timestep_counts(v):
    return analytics.timestep_counts(v.samples())


_SUNRISE = """
m AS (SELECT CAST(datetime AS DATE) AS date, datetime, sunlit, row_number() OVER (PARTITION BY CAST(datetime AS DATE) ORDER BY datetime) AS i FROM counts WHERE CAST(datetime AS TIME) <= TIME '12:00:00'),
f AS (SELECT date, min(i) AS first FROM m WHERE sunlit > 0 GROUP BY date),
dip AS (SELECT m.date, min((sunlit, i)) AS d, first, max(sunlit) FILTER (i = first) AS start FROM m JOIN f USING (date) WHERE i BETWEEN first AND first + 14 GROUP BY m.date, first),
spikes AS (SELECT m.date, datetime FROM m JOIN dip USING (date) WHERE start - d[1] > 1 AND i >= first AND i < d[2] AND sunlit > 0)"""


@query()
def sunrise_spikes(v):
    return _texts(analytics.sunrise_spikes(analytics.timestep_counts(v.samples()), drop=1), "date")


ORACLES["sunrise_spikes"] = with_views("counts", "").rstrip() + ", " + _SUNRISE.replace("d[1]", "struct_extract(d, 1)").replace("d[2]", "struct_extract(d, 2)") + " SELECT CAST(date AS VARCHAR) AS date, datetime FROM spikes"


@query("counts", "SELECT CAST(date AS VARCHAR) AS date, datetime FROM (SELECT CAST(datetime AS DATE) AS date, datetime, sunlit, lag(sunlit) OVER (PARTITION BY CAST(datetime AS DATE) ORDER BY datetime) AS b FROM counts WHERE hour(datetime) >= 14) WHERE sunlit > b AND sunlit > 0")
def sunset_spikes(v):
    return _texts(analytics.sunset_spikes(analytics.timestep_counts(v.samples())), "date")


@query("rollup counts", "SELECT section_id, edge_id, datetime, CASE WHEN datetime IN (SELECT datetime FROM (SELECT datetime, sunlit, lag(sunlit) OVER (PARTITION BY CAST(datetime AS DATE) ORDER BY datetime) AS b FROM counts WHERE hour(datetime) >= 14) WHERE sunlit > b AND sunlit > 0) THEN 0 ELSE sunlit_sum END AS sunlit_sum, sample_count FROM rollup")
def spike_corrected_rollup(v):
    s = v.samples()
    return analytics.corrected_rollup(exposure.edge_rollup(s), analytics.sunset_spikes(analytics.timestep_counts(s)))


@query("samples counts", "SELECT section_id, edge_id, sample_point_id, datetime, CASE WHEN datetime IN (SELECT datetime FROM (SELECT datetime, sunlit, lag(sunlit) OVER (PARTITION BY CAST(datetime AS DATE) ORDER BY datetime) AS b FROM counts WHERE hour(datetime) >= 14) WHERE sunlit > b AND sunlit > 0) THEN false ELSE is_sunlit END AS is_sunlit FROM samples")
def spike_corrected_facts(v):
    s = v.samples()
    return analytics.corrected_facts(s, analytics.sunset_spikes(analytics.timestep_counts(s)))


@query("od", "SELECT day_type, hour, round(COALESCE(sum(trips * min_exposure) FILTER (ok) / nullif(sum(trips) FILTER (ok), 0), 0), 4) AS mean_min, round(COALESCE(sum(trips * max_exposure) FILTER (ok) / nullif(sum(trips) FILTER (ok), 0), 0), 4) AS mean_max FROM (SELECT *, trips <> 0 AND min_exposure IS NOT NULL AND max_exposure IS NOT NULL AS ok FROM od) GROUP BY ALL")
def weighted_od_mean(v):
    return analytics.weighted_od_mean(v.od())


@query("points grid_facts", f"SELECT segment, min(position) AS position, rpad(repeat('1', CAST(round_even(10.0::DOUBLE * count(*) FILTER (NOT is_sunlit) / count(*), 0) AS BIGINT)), 10, '0') AS barcode FROM (SELECT edge_id AS segment, sequence_index AS position, is_sunlit FROM grid_facts WHERE datetime = TIMESTAMP '{DAY} 16:30:00') GROUP BY segment")
def shadow_barcode(v):
    facts = v.grid_facts().where(F.col("datetime") == F.to_timestamp_ntz(F.lit(f"{DAY} 16:30:00")))
    return analytics.shadow_barcode(facts.select(F.col("edge_id").alias("segment"), F.col("sequence_index").alias("position"), "is_sunlit"))


@query("points", "SELECT path_id, round(COALESCE(sum(sqrt((nx - x) ** 2 + (ny - y) ** 2)), 0), 6) AS length_m FROM (SELECT path_id, x, y, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM (SELECT edge_id AS path_id, sequence_index AS position, CAST(sample_point_id % 100 AS DOUBLE) AS x, CAST(sample_point_id * 7 % 90 AS DOUBLE) AS y FROM points) WINDOW w AS (PARTITION BY path_id ORDER BY position)) GROUP BY path_id")
def path_lengths(v):
    p = v.points().select(F.col("edge_id").alias("path_id"), F.col("sequence_index").alias("position"), (F.col("sample_point_id") % 100).cast("double").alias("x"), (F.col("sample_point_id") * 7 % 90).cast("double").alias("y"))
    return analytics.path_lengths(p)


_LEGS = "legs AS (SELECT path_id, position, x, y, nx, ny, leg, COALESCE(lag(stop) OVER w, 0) AS start, stop, max(stop) FILTER (nx IS NOT NULL) OVER (PARTITION BY path_id) AS total FROM (SELECT *, sum(leg) OVER w AS stop FROM (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny, COALESCE(sqrt((lead(x) OVER w - x) ** 2 + (lead(y) OVER w - y) ** 2), 0) AS leg FROM route_points WINDOW w AS (PARTITION BY path_id ORDER BY position)) WINDOW w AS (PARTITION BY path_id ORDER BY position)) WINDOW w AS (PARTITION BY path_id ORDER BY position))"


@query()
def path_fractions(v):
    return analytics.path_fractions(v.route_points(), [0.0, 0.3, 0.5, 1.0])


ORACLES["path_fractions"] = with_views("points route_points", "").rstrip() + f", {_LEGS}, f AS (SELECT path_id, t, min((position, round(x + (nx - x) * CASE WHEN leg > 0 THEN (t * total - start) / leg ELSE 0 END, 6), round(y + (ny - y) * CASE WHEN leg > 0 THEN (t * total - start) / leg ELSE 0 END, 6))) AS p FROM legs, (VALUES (0.0::DOUBLE), (0.3::DOUBLE), (0.5::DOUBLE), (1.0::DOUBLE)) q(t) WHERE nx IS NOT NULL AND t * total >= start AND t * total <= stop GROUP BY ALL) SELECT path_id, t, struct_extract(p, 2) AS x, struct_extract(p, 3) AS y FROM f"


@query("points route_points", "SELECT path_id, greatest(1, CAST(round_even(sum(leg) / 100, 0) AS INTEGER)) AS n FROM (SELECT path_id, COALESCE(sqrt((lead(x) OVER w - x) ** 2 + (lead(y) OVER w - y) ** 2), 0) AS leg FROM route_points WINDOW w AS (PARTITION BY path_id ORDER BY position)) GROUP BY path_id")
def path_samples(v):
    return analytics.points_along(v.route_points(), 100.0).groupBy("path_id").agg(F.count("*").cast("int").alias("n"))


@query("samples", "SELECT count(*) AS rows, min(datetime) AS first, max(datetime) AS last, count(DISTINCT edge_id) AS edges FROM samples")
def fact_summary(v):
    return integrity.summary(v.samples())


@query("samples", "SELECT DISTINCT CAST(CAST(datetime AS DATE) AS VARCHAR) AS date FROM samples")
def simulated_dates(v):
    return v.samples().select(F.to_date("datetime").cast("string").alias("date")).distinct()


@query("", "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1")
def json_config(v):
    return v.table("events").groupBy(F.get_json_object("props", "$.k").cast("long").alias("k")).agg(F.count("*").alias("n"))


# --- time grid and sun ----------------------------------------------------------------------------------------------------

_SNAP = "date_trunc('day', ts) + to_minutes(CAST(180 + 3 * greatest(0, least(359, round_even((epoch_us(ts - date_trunc('day', ts)) / 60000000.0::DOUBLE - 180) / 3, 0))) AS BIGINT))"


@query("", f"SELECT event_id, {_SNAP} AS datetime FROM events")
def snap_timestep(v):
    return v.table("events").select("event_id", timegrid.snap_timestep(F.col("ts")).alias("datetime"))


@query("", "SELECT CAST(d AS VARCHAR) AS d, CAST(w AS INTEGER) AS w, CAST(d AS TIMESTAMP) + to_minutes(CAST(180 + w * 180 AS BIGINT)) AS lo, CAST(d AS TIMESTAMP) + to_minutes(CAST(360 + w * 180 AS BIGINT)) AS hi, CAST(180 + w * 180 AS INTEGER) AS first_minute, CAST(359 + w * 180 AS INTEGER) AS last_minute, 'exposure_s7_' || strftime(d, '%Y%m%d') || '_w' || w AS leaf FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), range(6) t(w)")
def window_bounds(v):
    days = v.table("orders").select(F.to_date("o_orderdate").alias("d")).distinct().crossJoin(F.broadcast(v.spark.range(6).select(F.col("id").cast("int").alias("w"))))
    return days.withColumn("b", timegrid.window_bounds(F.col("d"), F.col("w"))).select(F.col("d").cast("string").alias("d"), "w", "b.*", timegrid.leaf_name(F.lit(7), F.col("d"), F.col("w")).alias("leaf"))


_DATES = [date(2024, 1, 4), date(2024, 1, 12), date(2024, 1, 20), date(2024, 1, 26)]


@query("", "SELECT event_id, (SELECT CAST(arg_min(d, (abs(d - CAST(ts AS DATE)), i)) AS VARCHAR) FROM (VALUES (DATE '2024-01-04', 0), (DATE '2024-01-12', 1), (DATE '2024-01-20', 2), (DATE '2024-01-26', 3)) t(d, i)) AS nearest FROM events")
def nearest_date(v):
    return v.table("events").select("event_id", timegrid.nearest_date(F.to_date("ts"), _DATES).cast("string").alias("nearest"))


_LIVE = "CAST(floor(greatest(0, least(hi, 716 + h / 2 - 20) - greatest(lo, 716 - h / 2 + 20)) / 3) AS INTEGER)"
_DAYLIGHT = "2 * degrees(acos(greatest(-1, least(1, -tan(radians(40.7826::DOUBLE)) * tan(radians(23.45::DOUBLE * sin(radians(360.0::DOUBLE * (doy + 284) / 365)))))))) / 15 * 60"


@query("", f"SELECT doy, w, {_LIVE} AS live FROM (SELECT CAST(doy AS INTEGER) AS doy, CAST(w AS INTEGER) AS w, 180.0::DOUBLE + 180 * w AS lo, 360.0::DOUBLE + 180 * w AS hi, {_DAYLIGHT} AS h FROM range(1, 366) a(doy), range(6) b(w))")
def live_steps(v):
    grid = v.spark.range(1, 366).select(F.col("id").cast("int").alias("doy")).crossJoin(v.spark.range(6).select(F.col("id").cast("int").alias("w")))
    return grid.select("doy", "w", solar.live_steps(F.col("doy"), 180 + 180 * F.col("w"), 360 + 180 * F.col("w")).alias("live"))


@query("sections", f"SELECT section_id, doy, w, sample_count * greatest(1, {_LIVE}) AS est_raycasts FROM (SELECT section_id, sample_count, CAST(doy AS INTEGER) AS doy, CAST(w AS INTEGER) AS w, 180.0::DOUBLE + 180 * w AS lo, 360.0::DOUBLE + 180 * w AS hi, {_DAYLIGHT} AS h FROM sections, range(15, 366, 30) a(doy), range(6) b(w) WHERE sample_count > 0)")
def task_estimates(v):
    grid = v.spark.range(15, 366, 30).select(F.col("id").cast("int").alias("doy")).crossJoin(v.spark.range(6).select(F.col("id").cast("int").alias("w")))
    rows = v.sections().where("sample_count > 0").crossJoin(F.broadcast(grid))
    return rows.select("section_id", "doy", "w", (F.col("sample_count") * F.greatest(F.lit(1), solar.live_steps(F.col("doy"), 180 + 180 * F.col("w"), 360 + 180 * F.col("w")))).alias("est_raycasts"))


def _sun(v):
    from sunweave.sources.files import make_ephemeris

    return make_ephemeris(v.spark, 2026, 40.7826, -73.9656, -5)


_SUN = """
WITH m AS (SELECT CAST(i // 1440 + 1 AS INTEGER) AS doy, CAST(i % 1440 AS INTEGER) AS minute FROM range(365 * 1440) t(i)),
g AS (SELECT *, 2 * pi() / 365 * (doy - 1 + (minute / 60.0::DOUBLE - 12) / 24) AS g FROM m),
e AS (SELECT *, 229.18::DOUBLE * (0.000075::DOUBLE + 0.001868::DOUBLE * cos(g) - 0.032077::DOUBLE * sin(g) - 0.014615::DOUBLE * cos(2 * g) - 0.040849::DOUBLE * sin(2 * g)) AS eq,
        0.006918::DOUBLE - 0.399912::DOUBLE * cos(g) + 0.070257::DOUBLE * sin(g) - 0.006758::DOUBLE * cos(2 * g) + 0.000907::DOUBLE * sin(2 * g) - 0.002697::DOUBLE * cos(3 * g) + 0.00148::DOUBLE * sin(3 * g) AS d FROM g),
h AS (SELECT *, radians((minute + eq - 4 * 73.9656::DOUBLE + 300) / 4 - 180) AS h, radians(40.7826::DOUBLE) AS phi FROM e)
SELECT 2026 AS year, doy, minute, round(degrees(atan2(sin(h), cos(h) * sin(phi) - tan(d) * cos(phi))) + 180, 6) % 360 AS azimuth, round(degrees(asin(greatest(-1, least(1, sin(phi) * sin(d) + cos(phi) * cos(d) * cos(h))))), 6) AS elevation FROM h"""


@query("", _SUN)
def sun_year(v):
    s = _sun(v)
    return s.select("year", "doy", "minute", (F.round("azimuth", 6) % 360).alias("azimuth"), F.round("elevation", 6).alias("elevation"))


@query("", "WITH e AS (SELECT (doy - 1) * 1440 + minute AS i, azimuth AS a, elevation AS h FROM (" + _SUN + ")) SELECT event_id, round((e.a + ((f.a - e.a + 540 + 360) % 360 - 180) * p + 720) % 360, 4) AS azimuth, round(e.h + (f.h - e.h) * p, 4) AS elevation FROM (SELECT event_id, (dayofyear(ts) - 1) * 1440 + hour(ts) * 60 + minute(ts) AS i, extract('microsecond' FROM ts) / 60000000.0::DOUBLE AS p FROM events) t JOIN e ON e.i = least(t.i, 525599) JOIN e f ON f.i = (least(t.i, 525599) + 1) % 525600")
def sun_at_events(v):
    s = _sun(v).select("doy", "minute", (F.round("azimuth", 6) % 360).alias("azimuth"), F.round("elevation", 6).alias("elevation"))
    out = solar.ephemeris_at(v.table("events").select("event_id", F.col("ts").alias("datetime")), s)
    return out.select("event_id", F.round("azimuth", 4).alias("azimuth"), F.round("elevation", 4).alias("elevation"))


@query("", "SELECT event_id, h, CAST(h / 24 AS DOUBLE) AS progress, (h - 6) * 15 AS rough, h >= 5 AND h < 19 AS daytime, lpad(CAST(floor(h) AS INTEGER)::VARCHAR, 2, '0') || ':' || lpad(CAST(floor((h - floor(h)) * 60) AS INTEGER)::VARCHAR, 2, '0') AS clock FROM (SELECT event_id, (event_id % 97) / 4.0::DOUBLE - 24 * floor((event_id % 97) / 96) AS h FROM events)")
def day_times(v):
    raw = (F.col("event_id") % 97) / 4.0
    h = solar.wrapped_hour(raw)
    return v.table("events").select("event_id", h.alias("h"), solar.day_progress(raw).alias("progress"), solar.rough_elevation(h).alias("rough"), solar.is_daytime(raw).alias("daytime"), solar.clock(raw).alias("clock"))


def _day_steps(v):
    """All three-minute steps of midsummer's day."""
    at = F.to_timestamp_ntz(F.lit("2026-06-21 00:00:00")) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("minute"), F.lit(0))
    return _sun(v).where("doy = 172 AND minute % 3 = 0").select(at.alias("datetime"), "azimuth", "elevation")


def _ground(v):
    return v.waypoints().select(F.col("id").alias("sample_point_id"), "x", "y", F.lit(-112.0).alias("z"))


def _boxes(v):
    x, y = F.col("x"), F.col("y")
    return v.trees().select(x.alias("x1"), y.alias("y1"), (x + 20).alias("x2"), (y + 20).alias("y2"), (F.lit(-112.0) + 60 * F.col("shade_norm")).alias("top"))


@query()
def box_shadows(v):
    return exposure.occluded_facts(_ground(v), _day_steps(v), _boxes(v), reach=700.0)


@query()
def mesh_shadows(v):
    """Of each tree's box the two upright triangles of its diagonal."""
    b = _boxes(v)
    corner = lambda x, y, z, i: [F.col(x).alias(f"x{i}"), F.col(y).alias(f"y{i}"), (F.col("top") if z else F.lit(-112.0)).alias(f"z{i}")]
    one = b.select(*corner("x1", "y1", 0, 1), *corner("x2", "y2", 0, 2), *corner("x2", "y2", 1, 3))
    two = b.select(*corner("x1", "y1", 0, 1), *corner("x1", "y1", 1, 2), *corner("x2", "y2", 1, 3))
    return exposure.mesh_facts(_ground(v), _day_steps(v), one.unionByName(two), reach=700.0)


@query()
def lit_paths(v):
    return exposure.lit_along_paths(v.route_points(), 135.0, 40.0, _boxes(v).withColumn("top", F.col("top") + 112), 50.0)


# --- queue ------------------------------------------------------------------------------------------------------------------

_PCT = "CAST(round(CAST(100 * done AS DECIMAL(38, 12)) / nullif(total, 0), 2) AS DOUBLE) AS pct_done"


_NOW = "TIMESTAMP '1997-01-01 00:00:00'"


def _now():
    return F.to_timestamp(F.lit("1997-01-01 00:00:00"))


@query("tasks", f"SELECT * EXCLUDE (hits), {_PCT}, CAST(round(CAST(100 * hits AS DECIMAL(38, 12)) / nullif(done, 0), 1) AS DOUBLE) AS pct_affinity_hit FROM (SELECT run_id, count(*) AS total, count(*) FILTER (state = 'pending') AS pending, count(*) FILTER (state = 'running') AS running, count(*) FILTER (state = 'done') AS done, count(*) FILTER (state = 'failed') AS failed, count(DISTINCT worker_id) FILTER (state = 'running') AS active_workers, CAST(COALESCE(sum(rows_written), 0) AS BIGINT) AS rows_written, CAST(COALESCE(sum(est_raycasts) FILTER (state = 'done'), 0) AS BIGINT) AS raycasts_done, CAST(sum(est_raycasts) AS BIGINT) AS raycasts_total, round(avg(epoch(finished_at - started_at)) FILTER (state = 'done'), 2) AS avg_task_seconds, count(*) FILTER (state = 'done' AND affinity_hit) AS hits FROM tasks GROUP BY run_id)")
def run_progress(v):
    return queue.run_progress(v.tasks())


@query("tasks shards runs", "SELECT t.*, max_tasks_per_shard AS admission_cap, state AS shard_state, CAST(round(CAST(100 * done AS DECIMAL(38, 12)) / nullif(total, 0), 1) AS DOUBLE) AS pct_done FROM (SELECT run_id, shard_index, count(*) AS total, count(*) FILTER (state = 'running') AS running, count(*) FILTER (state = 'done') AS done, count(*) FILTER (state = 'pending') AS pending, count(*) FILTER (state = 'failed') AS failed, CAST(COALESCE(sum(rows_written), 0) AS BIGINT) AS rows_written FROM tasks GROUP BY ALL) t JOIN runs USING (run_id) LEFT JOIN shards USING (shard_index)")
def shard_progress(v):
    return queue.shard_progress(v.tasks(), v.shards(), v.runs())


@query("tasks", "SELECT run_id, task_id, section_id, state, attempts FROM tasks WHERE state <> 'done'")
def run_gaps(v):
    return queue.run_gaps(v.tasks())


_FREE = "free AS (SELECT shard_index, COALESCE(n, 0) AS running, max_tasks_per_shard - COALESCE(n, 0) AS free FROM (SELECT * FROM shards, runs) s LEFT JOIN (SELECT shard_index, count(*) AS n FROM tasks WHERE state = 'running' GROUP BY 1) USING (shard_index) WHERE s.state = 'online' AND max_tasks_per_shard > COALESCE(n, 0))"


def _queue_sql(rest: str) -> str:
    return with_views("tasks shards runs", "").rstrip() + f", {_FREE} {rest}"


@query()
def admissible_shards(v):
    return queue.admissible_shards(v.tasks(), v.shards(), v.runs(), "run")


ORACLES["admissible_shards"] = _queue_sql("SELECT shard_index, running, CAST(free AS BIGINT) AS free FROM free")


@query()
def claim_lpt(v):
    return queue.claimable(v.tasks(), v.shards(), v.runs(), "run")


ORACLES["claim_lpt"] = _queue_sql("SELECT * FROM (SELECT shard_index, CAST(row_number() OVER (PARTITION BY shard_index ORDER BY priority DESC, est_raycasts DESC, task_id) AS INTEGER) AS slot, task_id, priority, est_raycasts FROM tasks WHERE state = 'pending' AND run_id = 'run') JOIN (SELECT shard_index, free FROM free) USING (shard_index) WHERE slot <= free").replace("SELECT * FROM (SELECT shard_index, CAST", "SELECT shard_index, slot, task_id, priority, est_raycasts FROM (SELECT shard_index, CAST")

_CLAIMED = ("task_id", "section_id", "window_index", "attempts", "worker_id", "affinity_hit")


def _claims(v, **hint):
    tasks, mine = queue.claim(v.tasks(), v.shards(), v.runs(), "run", "me", _now(), **hint)
    return mine.select(*_CLAIMED, F.unix_timestamp("lease_expires_at").alias("lease_until"), (F.unix_timestamp("started_at") == F.unix_timestamp(_now())).alias("starts_now"))


def _claim_sql(where: str, hit: str, order: str) -> str:
    return _queue_sql(f"SELECT task_id, section_id, window_index, attempts + 1 AS attempts, 'me' AS worker_id, {hit} AS affinity_hit, CAST(epoch({_NOW}) AS BIGINT) + 120 AS lease_until, true AS starts_now FROM tasks WHERE state = 'pending' AND run_id = 'run' AND shard_index IN (SELECT shard_index FROM free) {where} ORDER BY {order} LIMIT 1")


@query()
def claim_next(v):
    return _claims(v)


@query()
def claim_affinity(v):
    return _claims(v, section=1, window=2)


@query()
def claim_affinity_missed(v):
    return _claims(v, section=-1, window=2)


ORACLES["claim_next"] = _claim_sql("", "false", "priority DESC, est_raycasts DESC, task_id")
ORACLES["claim_affinity"] = _queue_sql(f"SELECT task_id, section_id, window_index, attempts + 1 AS attempts, 'me' AS worker_id, section_id = 1 AND window_index = 2 AS affinity_hit, CAST(epoch({_NOW}) AS BIGINT) + 120 AS lease_until, true AS starts_now FROM tasks WHERE state = 'pending' AND run_id = 'run' AND shard_index IN (SELECT shard_index FROM free) ORDER BY section_id = 1 AND window_index = 2 DESC, CASE WHEN section_id = 1 AND window_index = 2 THEN 0 ELSE priority END DESC, est_raycasts DESC, task_id LIMIT 1")
ORACLES["claim_affinity_missed"] = ORACLES["claim_next"]


def _reports(v, **columns):
    """Every fifth task's report, half of them by a worker that doesn't hold it."""
    worker = F.when(F.col("task_id") % 10 == 0, F.coalesce("worker_id", F.lit("w0"))).otherwise("impostor")
    return v.tasks().where("task_id % 5 = 0").select("task_id", worker.alias("worker_id"), *[c.alias(n) for n, c in columns.items()])


_HELD = "(task_id % 10 = 0 AND state = 'running')"


def _beats(v):
    return _reports(v).withColumn("raycasts_done", F.lit(None).cast("long"))


@query("tasks", f"SELECT task_id, CASE WHEN task_id % 10 = 0 THEN COALESCE(worker_id, 'w0') ELSE 'impostor' END AS worker_id, {_HELD} AS ok FROM tasks WHERE task_id % 5 = 0")
def heartbeat_fencing(v):
    return queue.heartbeat(v.tasks(), _beats(v), _now())[1]


@query("tasks", f"SELECT task_id, CASE WHEN {_HELD} THEN CAST(epoch({_NOW}) AS BIGINT) + 120 ELSE COALESCE(CAST(epoch(lease_expires_at) AS BIGINT), -1) END AS lease_until FROM tasks")
def heartbeat_leases(v):
    return queue.heartbeat(v.tasks(), _beats(v), _now())[0].select("task_id", F.coalesce(F.unix_timestamp("lease_expires_at"), F.lit(-1)).alias("lease_until"))


@query("tasks", f"SELECT task_id, CASE WHEN {_HELD} THEN 'done' ELSE state END AS state, CASE WHEN {_HELD} THEN 7 ELSE COALESCE(rows_written, -1) END AS rows_written, lease_expires_at IS NULL OR {_HELD} AS no_lease, CASE WHEN {_HELD} THEN CAST(epoch({_NOW}) AS BIGINT) ELSE COALESCE(CAST(epoch(finished_at) AS BIGINT), -1) END AS finished FROM tasks")
def complete_tasks(v):
    after = queue.complete(v.tasks(), _beats(v).withColumn("rows_written", F.lit(7).cast("long")), _now())[0]
    return after.select("task_id", "state", F.coalesce("rows_written", F.lit(-1)).alias("rows_written"), F.col("lease_expires_at").isNull().alias("no_lease"), F.coalesce(F.unix_timestamp("finished_at"), F.lit(-1)).alias("finished"))


@query("tasks", f"SELECT task_id, CASE WHEN {_HELD} THEN CASE WHEN attempts >= max_attempts THEN 'failed' ELSE 'pending' END ELSE state END AS state, CASE WHEN NOT {_HELD} THEN worker_id END AS worker_id, CASE WHEN {_HELD} THEN 'lost ' || task_id ELSE last_error END AS last_error, COALESCE(CASE WHEN {_HELD} THEN CASE WHEN attempts >= max_attempts THEN CAST(epoch({_NOW}) AS BIGINT) END ELSE CAST(epoch(finished_at) AS BIGINT) END, -1) AS finished FROM tasks")
def fail_tasks(v):
    error = F.concat(F.lit("lost "), F.col("task_id").cast("string"))
    after = queue.fail(v.tasks(), _reports(v, error=error), _now())[0]
    return after.select("task_id", "state", "worker_id", "last_error", F.coalesce(F.unix_timestamp("finished_at"), F.lit(-1)).alias("finished"))


@query("tasks", f"SELECT task_id, CASE WHEN x THEN CASE WHEN attempts >= max_attempts THEN 'failed' ELSE 'pending' END ELSE state END AS state, CASE WHEN NOT x THEN worker_id END AS worker_id, CASE WHEN x THEN 'lease expired (last heartbeat ' || COALESCE(strftime(heartbeat_at, '%Y-%m-%d %H:%M:%S'), 'never') || ', worker ' || worker_id || ')' ELSE last_error END AS last_error, COALESCE(CAST(epoch(finished_at) AS BIGINT), -1) AS finished FROM (SELECT *, state = 'running' AND lease_expires_at < {_NOW} AS x FROM tasks)")
def reap_expired(v):
    return queue.reap_expired(v.tasks(), _now(), "run").select("task_id", "state", "worker_id", "last_error", F.coalesce(F.unix_timestamp("finished_at"), F.lit(-1)).alias("finished"))


@query("tasks", "SELECT task_id, state, priority, est_raycasts FROM tasks WHERE state <> 'done' ORDER BY priority DESC, est_raycasts DESC, task_id LIMIT 20")
def outstanding_top20(v):
    return v.tasks().where("state <> 'done'").orderBy(F.desc("priority"), F.desc("est_raycasts"), "task_id").limit(20).select("task_id", "state", "priority", "est_raycasts")


@query("tasks", "SELECT task_id, shard_index, section_id, window_index, state, attempts, left(COALESCE(last_error, ''), 70) AS error FROM tasks WHERE state <> 'done' ORDER BY state, shard_index, sim_date, section_id, task_id LIMIT 20")
def outstanding_report(v):
    return queue.outstanding(v.tasks())


@query("tasks", "SELECT task_id, worker_id, section_id, window_index, attempts, CAST(epoch(started_at) AS BIGINT) AS started FROM tasks WHERE state = 'running' ORDER BY started_at, task_id LIMIT 12")
def oldest_running(v):
    return queue.oldest_running(v.tasks()).select("task_id", "worker_id", "section_id", "window_index", "attempts", F.unix_timestamp("started_at").alias("started"))


@query("tasks", "SELECT task_id, section_id, attempts, last_error AS error FROM tasks WHERE state = 'failed' ORDER BY finished_at DESC, task_id LIMIT 8")
def recent_failures(v):
    return queue.recent_failures(v.tasks())


@query("tasks", "SELECT task_id, section_id, window_index, est_raycasts FROM tasks ORDER BY est_raycasts DESC, task_id LIMIT 5")
def dearest_tasks(v):
    return queue.dearest(v.tasks())


@query("tasks", "SELECT min(est_raycasts) AS least, max(est_raycasts) AS greatest, round(CAST(max(est_raycasts) AS DOUBLE) / min(est_raycasts), 2) AS spread FROM tasks")
def cost_spread(v):
    return queue.cost_spread(v.tasks())


@query("tasks", "SELECT run_id, workers, rows, raycasts, wall AS wall_seconds, round(rows / wall, 3) AS rows_per_second, round(rows / wall / greatest(1, workers), 3) AS rows_per_worker, round(raycasts / wall, 3) AS raycasts_per_second, CAST(round(CAST(100 * raycasts AS DECIMAL(38, 12)) / greatest(1, rows), 1) AS DOUBLE) AS raycast_pct FROM (SELECT run_id, count(DISTINCT worker_id) AS workers, CAST(sum(rows_written) AS BIGINT) AS rows, CAST(sum(est_raycasts) AS BIGINT) AS raycasts, CAST(epoch(max(finished_at) - min(started_at)) AS DOUBLE) AS wall FROM tasks WHERE state = 'done' GROUP BY run_id) WHERE wall > 0")
def throughput_report(v):
    return queue.throughput(v.tasks()).drop("first_start", "last_finish")


@query("shards", "SELECT COALESCE(s.shard_index, n.shard_index) AS shard_index, COALESCE(n.host, s.host) AS host, CASE WHEN n.shard_index IS NULL THEN s.port ELSE 5432 END AS port, CASE WHEN n.shard_index IS NULL THEN s.dbname ELSE 'shard_' || n.shard_index END AS dbname, COALESCE(state, 'online') AS state, COALESCE(n.vcpu, s.vcpu, -1) AS vcpu, COALESCE(s.ram_gb, -1) AS ram_gb, n.shard_index IS NOT NULL AS seen FROM shards s FULL JOIN (SELECT n_nationkey AS shard_index, lower(n_name) AS host, CASE WHEN n_nationkey % 2 = 0 THEN 32 END AS vcpu FROM nation WHERE n_nationkey BETWEEN 2 AND 9) n ON n.shard_index = s.shard_index")
def registered_shards(v):
    k = F.col("n_nationkey")
    new = v.table("nation").where(k.between(2, 9)).select(k.alias("shard_index"), F.lower("n_name").alias("host"), F.lit(None).cast("int").alias("port"), F.lit(None).cast("string").alias("dbname"), F.when(k % 2 == 0, 32).alias("vcpu"), F.lit(None).cast("int").alias("ram_gb"))
    out = queue.register_shards(v.shards(), new, _now())
    return out.select("shard_index", "host", "port", "dbname", "state", F.coalesce("vcpu", F.lit(-1)).alias("vcpu"), F.coalesce("ram_gb", F.lit(-1)).alias("ram_gb"), F.col("last_seen_at").isNotNull().alias("seen"))


@query("tasks", "SELECT task_id, section_id, window_index, state FROM tasks UNION ALL SELECT 1000000000 + task_id, section_id, 0, 'pending' FROM tasks t WHERE task_id % 7 = 0 AND NOT EXISTS (SELECT 1 FROM tasks o WHERE o.section_id = t.section_id AND o.sim_date = t.sim_date AND o.window_index = 0)")
def inserted_tasks(v):
    t = v.tasks()
    new = t.where("task_id % 7 = 0").withColumns({"task_id": F.col("task_id") + 1_000_000_000, "window_index": F.lit(0), "state": F.lit("pending")})
    return queue.insert_tasks(t, new).select("task_id", "section_id", "window_index", "state")


# --- topology and space -----------------------------------------------------------------------------------------------------


@query("hilbert", "SELECT CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y, CAST(d AS BIGINT) AS d FROM hilbert")
def hilbert_index(v):
    c = v.spark.range(128 * 128).select((F.col("id") % 128).cast("int").alias("x"), F.expr("cast(id div 128 AS int)").alias("y"))
    return c.withColumn("d", geo.hilbert_index(F.col("x"), F.col("y")))


_SECTION = "CAST(floor(y / 1000) * 128 + floor(x / 1000) AS INTEGER)"


@query("waypoints", f"SELECT id, {_SECTION} AS section_id, {_SECTION} % 128 AS grid_col, CAST({_SECTION} // 128 AS INTEGER) AS grid_row FROM waypoints")
def section_assignment(v):
    s = v.waypoints().withColumn("section_id", geo.section_id(F.col("x"), F.col("y"), 0.0, 0.0, 1000.0))
    return s.select("id", "section_id", geo.section_column(F.col("section_id")).alias("grid_col"), geo.section_row(F.col("section_id")).alias("grid_row"))


@query("waypoints", f"SELECT {_SECTION} AS section_id, count(*) AS edge_count, CAST(sum(id % 50) AS BIGINT) AS sample_count FROM waypoints GROUP BY 1")
def section_weights(v):
    s = v.waypoints().select(geo.section_id(F.col("x"), F.col("y"), 0.0, 0.0, 1000.0).alias("section_id"), (F.col("id") % 50).alias("sample_count"))
    return topology.section_weights(s)


@query("waypoints", "SELECT floor(min(x) / 1000) * 1000 AS origin_x, floor(min(y) / 1000) * 1000 AS origin_y, CAST(floor((max(x) - floor(min(x) / 1000) * 1000) / 1000) + 1 AS INTEGER) AS cols, CAST(floor((max(y) - floor(min(y) / 1000) * 1000) / 1000) + 1 AS INTEGER) AS rows FROM waypoints")
def grid_extent(v):
    return topology.grid_extent(v.waypoints(), 1000.0)


@query("sections", "SELECT shard_index, count(*) AS sections, CAST(sum(sample_count) AS BIGINT) AS samples, round(100.0::DOUBLE * sum(sample_count) / sum(sum(sample_count)) OVER (), 2) AS pct, round(sum(sample_count) / avg(sum(sample_count)) OVER (), 4) AS load_vs_mean FROM sections GROUP BY shard_index")
def shard_balance(v):
    return topology.shard_balance(v.sections())


@query("sections", "SELECT round(max(l) / avg(l), 6) AS imbalance FROM (SELECT sum(sample_count) AS l FROM sections GROUP BY shard_index) WHERE l > 0")
def write_imbalance(v):
    return topology.write_imbalance(v.sections())


@query("sections", "SELECT count(*) AS pairs, count(*) FILTER (a.shard_index = b.shard_index) AS same, round(COALESCE(count(*) FILTER (a.shard_index = b.shard_index)::DOUBLE / nullif(count(*), 0), 1), 6) AS contiguity FROM sections a JOIN sections b ON (b.grid_col = a.grid_col + 1 AND b.grid_row = a.grid_row) OR (b.grid_col = a.grid_col AND b.grid_row = a.grid_row + 1)")
def contiguity(v):
    return topology.contiguity(v.sections())


@query()
def balanced_cut(v):
    return topology.cut_sections(v.sections(), 5)


# The least cap by dynamic programming over the cuts, then as far as the cap allows, again and again.
ORACLES["balanced_cut"] = with_views("sections hilbert", "").rstrip().replace("WITH ", "WITH RECURSIVE ", 1) + """
, o AS (SELECT section_id, sample_count AS w, row_number() OVER (ORDER BY d, section_id) AS i FROM sections JOIN hilbert ON x = grid_col AND y = grid_row WHERE sample_count > 0),
p AS (SELECT 0 AS i, 0 AS s UNION ALL SELECT i, sum(w) OVER (ORDER BY i) FROM o),
b1 AS (SELECT i, s AS c FROM p), b2 AS (SELECT p.i, min(greatest(c, p.s - q.s)) AS c FROM p JOIN p q ON q.i <= p.i JOIN b1 ON b1.i = q.i GROUP BY p.i),
b3 AS (SELECT p.i, min(greatest(c, p.s - q.s)) AS c FROM p JOIN p q ON q.i <= p.i JOIN b2 ON b2.i = q.i GROUP BY p.i), b4 AS (SELECT p.i, min(greatest(c, p.s - q.s)) AS c FROM p JOIN p q ON q.i <= p.i JOIN b3 ON b3.i = q.i GROUP BY p.i),
b5 AS (SELECT p.i, min(greatest(c, p.s - q.s)) AS c FROM p JOIN p q ON q.i <= p.i JOIN b4 ON b4.i = q.i GROUP BY p.i), cap AS (SELECT arg_max(c, i) AS c FROM b5),
walk(start, run) AS (SELECT CAST(0 AS BIGINT), 0 UNION ALL SELECT n.i, run + 1 FROM walk JOIN (SELECT a.i AS f, max(z.i) AS i FROM p a JOIN p z ON z.i > a.i AND z.s - a.s <= (SELECT c FROM cap) GROUP BY a.i) n ON n.f = walk.start WHERE n.i < (SELECT max(i) FROM p))
SELECT section_id, (SELECT max(run) FROM walk WHERE start < o.i) AS shard_index FROM o"""


def _routing(v):
    sections = v.edge_shards().select("edge_id", F.col("shard_index").alias("section_id"), (F.col("shard_index") % 5).alias("shard_index"))
    return topology.edge_routing(sections.select("edge_id", "section_id"), sections.select("section_id", "shard_index").distinct(), v.shards())


_ROUTING = "SELECT edge_id, edge_shards.shard_index AS section_id, edge_shards.shard_index % 5 AS shard_index, host, port, dbname, state AS shard_state FROM edge_shards LEFT JOIN shards ON shards.shard_index = edge_shards.shard_index % 5"


@query("edge_shards shards", _ROUTING)
def edge_routing(v):
    return _routing(v)


@query("edge_shards shards", f"SELECT shard_index, host, port, dbname, count(*) AS edge_count, string_agg(CAST(edge_id AS VARCHAR), ',' ORDER BY edge_id) AS edges FROM ({_ROUTING}) GROUP BY ALL")
def route_plan(v):
    plan = topology.route_plan(v.edge_shards().select("edge_id"), _routing(v).select("edge_id", "shard_index", "host", "port", "dbname"))
    return plan.select("shard_index", "host", "port", "dbname", "edge_count", F.array_join(F.transform("edge_ids", lambda e: e.cast("string")), ",").alias("edges"))


@query("edge_shards", "SELECT shards_touched, count(*) AS routes, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS pct FROM (SELECT seed, count(DISTINCT shard_index) AS shards_touched FROM (SELECT rn AS seed FROM (SELECT row_number() OVER (ORDER BY hilbert_index, edge_id) AS rn, count(*) OVER () AS n FROM edge_shards) WHERE rn % greatest(1, n // 40) = 0 ORDER BY rn LIMIT 40) s JOIN (SELECT row_number() OVER (ORDER BY hilbert_index, edge_id) AS rn, shard_index FROM edge_shards) r ON r.rn >= seed AND r.rn < seed + 12 GROUP BY seed) GROUP BY shards_touched")
def route_locality(v):
    return topology.route_locality(v.edge_shards(), 40, 12)


_MIDDLE = "CAST(floor((ay + b_y) / 2 / 1000) * 128 + floor((ax + bx) / 2 / 1000) AS INTEGER)"


@query("streets points", f"SELECT s.edge_id, {_MIDDLE} AS section_id, COALESCE(n, 0) AS sample_count FROM streets s LEFT JOIN (SELECT edge_id, count(*) AS n FROM points GROUP BY 1) USING (edge_id)")
def edge_sections(v):
    return topology.edge_sections(v.streets(), v.points(), 0.0, 0.0, 1000.0)


@query("streets points sections hilbert", f"SELECT w.section_id, edge_count, samples AS sample_count, w.section_id % 128 AS grid_col, CAST(w.section_id // 128 AS INTEGER) AS grid_row, (w.section_id % 128 + 0.5::DOUBLE) * 1000 AS centre_x, (w.section_id // 128 + 0.5::DOUBLE) * 1000 AS centre_y, CAST(d AS BIGINT) AS hilbert_index, COALESCE(o.shard_index, -1) AS shard_index FROM (SELECT {_MIDDLE} AS section_id, count(*) AS edge_count, CAST(sum(COALESCE(n, 0)) AS BIGINT) AS samples FROM streets LEFT JOIN (SELECT edge_id, count(*) AS n FROM points GROUP BY 1) USING (edge_id) GROUP BY 1) w JOIN hilbert ON x = w.section_id % 128 AND y = w.section_id // 128 LEFT JOIN sections o ON o.section_id = w.section_id")
def rebuilt_sections(v):
    out = topology.rebuilt_sections(topology.edge_sections(v.streets(), v.points(), 0.0, 0.0, 1000.0), v.sections(), 0.0, 0.0, 1000.0)
    return out.withColumn("shard_index", F.coalesce("shard_index", F.lit(-1)))


@query("waypoints", "SELECT floor(min(x) / 1000) * 1000 AS origin_x, floor(min(y) / 1000) * 1000 AS origin_y, CAST(floor((max(x) - floor(min(x) / 1000) * 1000) / 1000) + 1 AS INTEGER) AS cols, CAST(floor((max(y) - floor(min(y) / 1000) * 1000) / 1000) + 1 AS INTEGER) AS rows, 1000.0::DOUBLE AS size FROM waypoints")
def grid_upsert(v):
    old = v.spark.createDataFrame([(0.0, 0.0, 1, 1, 1000.0)], "origin_x double, origin_y double, cols int, rows int, size double")
    return topology.grid_upsert(old, v.waypoints(), 1000.0)


@query("waypoints", "SELECT id, x, y FROM waypoints WHERE (x - 2500) * (x - 2500) + (y - 11000) * (y - 11000) <= 1500 * 1500")
def radius_search(v):
    return joins.around(v.waypoints(), 2500.0, 11000.0, 1500.0)


@query("trees waypoints", "SELECT tree_id AS a, arg_min(id, (sqrt((t.x - w.x) * (t.x - w.x) + (t.y - w.y) * (t.y - w.y)), id)) AS b FROM trees t, waypoints w GROUP BY tree_id")
def nearest_waypoint(v):
    flat = lambda df, k: df.select(F.col(k).alias("id"), "x", "y", F.lit(0.0).alias("z"))
    return joins.connectors(flat(v.trees(), "tree_id"), flat(v.waypoints(), "id"), 100.0)


@query("edges", "SELECT p.a, p.b, e.a * 1000000 + e.b AS edge_id FROM (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM lineitem) p JOIN edges e ON (e.a = p.a AND e.b = p.b) OR (e.a = p.b AND e.b = p.a)")
def edge_lookup(v):
    pairs = v.table("lineitem").select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b")).distinct()
    return joins.edge_between(pairs, v.edges().withColumn("edge_id", F.col("a") * 1_000_000 + F.col("b")))


@query("waypoints trees", "SELECT k AS id, CASE WHEN w.id IS NOT NULL THEN 'waypoints' ELSE 'trees' END AS \"table\", COALESCE(w.x, t.x) AS x, COALESCE(w.y, t.y) AS y FROM (SELECT DISTINCT o_custkey * 2 AS k FROM orders) LEFT JOIN waypoints w ON w.id = k LEFT JOIN trees t ON tree_id = k WHERE w.id IS NOT NULL OR tree_id IS NOT NULL")
def first_match(v):
    keys = v.table("orders").select((F.col("o_custkey") * 2).alias("id"))
    return integrity.first_match(keys, {"waypoints": v.waypoints(), "trees": v.trees().select(F.col("tree_id").alias("id"), "x", "y")})


@query("points", "SELECT sample_point_id, regexp_replace(md5(edge_id || '-' || sequence_index), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS id FROM points")
def sample_uuids(v):
    return v.points().select("sample_point_id", ids.uuid_of(F.col("edge_id"), F.col("sequence_index")).alias("id"))


@query("points trees", "SELECT sample_point_id, edge_id, 0.0::DOUBLE AS tree_value FROM points")
def reset_tree_values(v):
    return exposure.without_tree_values(exposure.tree_values(v.placed_points(), v.trees(), 60.0))


@query("", "SELECT c_custkey, u, regexp_matches(regexp_replace(lower(u), '[{}-]', '', 'g'), '^[0-9a-f]{32}$') AS valid FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN md5(CAST(c_custkey AS VARCHAR)) WHEN 1 THEN '{' || upper(md5(CAST(c_custkey AS VARCHAR))) || '}' ELSE 'x' || md5(CAST(c_custkey AS VARCHAR)) END AS u FROM customer)")
def uuid_filter(v):
    h, k = F.md5(F.col("c_custkey").cast("string").cast("binary")), F.col("c_custkey") % 3
    rows = v.table("customer").select("c_custkey", F.when(k == 0, h).when(k == 1, F.concat(F.lit("{"), F.upper(h), F.lit("}"))).otherwise(F.concat(F.lit("x"), h)).alias("u"))
    return rows.withColumn("valid", integrity.valid_uuid(F.col("u")))


@query("waypoints", "SELECT * FROM waypoints WHERE x BETWEEN 500 AND 2500 AND y BETWEEN 1000 AND 9000")
def bbox_points(v):
    return v.waypoints().where(geo.in_box(F.col("x"), F.col("y"), 2500, 1000, 500, 9000))


@query("edges nodes", "SELECT a, b FROM edges WHERE a IN (SELECT id FROM nodes WHERE x BETWEEN 500 AND 3500) AND b IN (SELECT id FROM nodes WHERE x BETWEEN 500 AND 3500)")
def endpoints_semi(v):
    inside = v.nodes().where("x BETWEEN 500 AND 3500").select("id")
    return v.edges().join(inside.select(F.col("id").alias("a")), "a", "left_semi").join(inside.select(F.col("id").alias("b")), "b", "left_semi")


@query("waypoints", "SELECT id, x, y, round(sqrt((x - 2500.0) * (x - 2500.0) + (y - 11000.0) * (y - 11000.0)), 6) AS dist FROM waypoints ORDER BY dist, id LIMIT 20")
def knn_waypoints(v):
    return joins.nearest(v.waypoints(), 2500.0, 11000.0, 20)


@query("waypoints trees", "SELECT id, tree_id, round(sqrt((w.x - t.x) * (w.x - t.x) + (w.y - t.y) * (w.y - t.y)), 6) AS dist FROM waypoints w JOIN trees t ON (w.x - t.x) * (w.x - t.x) + (w.y - t.y) * (w.y - t.y) <= 2500")
def distance_join(v):
    j = joins.within(v.waypoints(), v.trees().drop("shade_norm"), 50.0)
    return j.select("id", "tree_id", F.round(geo.distance(F.col("x"), F.col("y"), F.col("r_x"), F.col("r_y")), 6).alias("dist"))


# --- graph ------------------------------------------------------------------------------------------------------------------


@query("edges", "SELECT a, b FROM edges")
def edge_dedup(v):
    return v.edges()


@query("edges", "SELECT a AS node, b AS other FROM edges UNION ALL SELECT b, a FROM edges")
def edge_adjacency(v):
    return joins.neighbours(v.edges())


@query("edges", "SELECT node, count(*) AS degree FROM (SELECT a AS node FROM edges UNION ALL SELECT b FROM edges) GROUP BY node")
def node_degrees(v):
    return graph.degrees(v.edges())


_LENGTHS = "l AS (SELECT a, b, round(sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2 + (p.z - q.z) ** 2), 6) AS length, p.x AS ax, p.y AS ay, p.z AS az, q.x AS bx, q.y AS b_y, q.z AS bz FROM edges JOIN nodes p ON p.id = a JOIN nodes q ON q.id = b)"
_SYM = "s AS (SELECT a, b, length FROM l UNION ALL SELECT b, a, length FROM l)"


def _graph_sql(rest: str) -> str:
    return with_views("edges nodes", "").rstrip() + f", {_LENGTHS}, {rest}"


@query()
def edge_lengths(v):
    return graph.edge_lengths(v.edges(), v.nodes()).select("a", "b", "length")


ORACLES["edge_lengths"] = _graph_sql("x AS (SELECT 1) SELECT a, b, length FROM l")


@query()
def redundant_edges(v):
    return graph.redundant_edges(v.edges(), 5.0, v.nodes())


ORACLES["redundant_edges"] = _graph_sql(f"{_SYM} SELECT DISTINCT l.a, l.b FROM l JOIN s p ON p.a = l.a JOIN s q ON q.a = p.b AND q.b = l.b WHERE p.length + q.length <= l.length + 5.0")


@query()
def sample_generation(v):
    return graph.sample_points(graph.edge_lengths(v.edges(), v.nodes()), 1000.0).withColumn("distance_from_start", F.round("distance_from_start", 3))


ORACLES["sample_generation"] = _graph_sql("g AS (SELECT *, greatest(1, CAST(round_even(length / 1000.0, 0) AS INTEGER)) AS n FROM l), e AS (SELECT *, CAST(unnest(range(n)) AS INTEGER) AS sequence_index FROM g), t AS (SELECT *, CASE WHEN n > 1 THEN sequence_index / (n - 1) ELSE 0.0 END AS t FROM e) SELECT a, b, sequence_index, round(t * length, 3) AS distance_from_start, round(ax + (bx - ax) * t, 6) AS x, round(ay + (b_y - ay) * t, 6) AS y, round(az + (bz - az) * t, 6) AS z FROM t")

_REACH = "(WITH RECURSIVE link AS (SELECT a.id AS a, b.id AS b FROM nodes a JOIN nodes b ON a.id <> b.id AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 < 6400), reach(a, b) AS (SELECT id, id FROM nodes UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a) SELECT a AS id, min(b) AS root FROM reach GROUP BY a)"
_GROUPED = f"roots AS MATERIALIZED {_REACH}, placed AS (SELECT id, x, y, z, root, avg(x) OVER r AS mx, avg(y) OVER r AS my, avg(z) OVER r AS mz FROM roots JOIN nodes USING (id) WINDOW r AS (PARTITION BY root)), best AS (SELECT root, arg_min(id, (round((x - mx) ** 2 + (y - my) ** 2 + (z - mz) ** 2, 6), id)) AS representative FROM placed GROUP BY root)"


@query()
def decluster(v):
    return graph.decluster(v.nodes(), 80.0)


ORACLES["decluster"] = with_views("nodes", "").rstrip() + f", {_GROUPED} SELECT id, representative FROM roots JOIN best USING (root)"


@query()
def rewritten_edges(v):
    return graph.rewrite_edges(v.edges(), graph.decluster(v.nodes(), 80.0))


ORACLES["rewritten_edges"] = with_views("edges nodes", "").rstrip() + f", {_GROUPED}, m AS (SELECT id, representative FROM roots JOIN best USING (root)) SELECT DISTINCT least(p.representative, q.representative) AS a, greatest(p.representative, q.representative) AS b FROM edges JOIN m p ON p.id = a JOIN m q ON q.id = b WHERE p.representative <> q.representative"


@query()
def short_edges_removed(v):
    return graph.without_short(graph.edge_lengths(v.edges(), v.nodes()), 2000.0).select("a", "b")


ORACLES["short_edges_removed"] = _graph_sql("x AS (SELECT 1) SELECT a, b FROM l WHERE length >= 2000")


@query()
def reindexed_nodes(v):
    numbered, _ = graph.reindexed(v.nodes(), v.edges().where("a % 2 = 0"))
    return numbered.select("id", "index")


@query()
def reindexed_edges(v):
    return graph.reindexed(v.nodes(), v.edges().where("a % 2 = 0"))[1]


_INDEX = "i AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS index FROM nodes WHERE id IN (SELECT a FROM edges WHERE a % 2 = 0 UNION SELECT b FROM edges WHERE a % 2 = 0))"
ORACLES["reindexed_nodes"] = with_views("edges nodes", "").rstrip() + f", {_INDEX} SELECT id, index FROM i"
ORACLES["reindexed_edges"] = with_views("edges nodes", "").rstrip() + f", {_INDEX} SELECT p.index AS a, q.index AS b FROM edges JOIN i p ON p.id = a JOIN i q ON q.id = b WHERE a % 2 = 0"


def _street_graph(v):
    """(edges, nodes) of streets from each customer's place to that of another with the next key of three, a forest of chains."""
    k = F.col("c_custkey")
    edges = v.table("customer").select(k.alias("a"), (k + 3).alias("b")).where("a % 7 <> 0")
    return edges.join(v.table("customer").select(k.alias("b")), "b", "left_semi").select("a", "b"), v.waypoints()


@query()
def merged_nodes(v):
    nodes, edges = graph.merge_near(v.nodes(), v.edges(), 100.0)
    return nodes.select("id", *[F.round(c, 6).alias(c) for c in "xyz"])


@query()
def short_cycles_removed(v):
    edges, nodes = _street_graph(v)
    more = v.table("customer").select(F.col("c_custkey").alias("a"), (F.col("c_custkey") + 6).alias("b")).join(nodes.select(F.col("id").alias("b")), "b", "left_semi").select("a", "b")
    return graph.without_short_cycles(edges.unionByName(more), nodes, 6)


@query()
def spur_ends(v):
    return graph.spurs(*_street_graph(v)).select("node", "other")


@query()
def dead_end_bridges(v):
    return graph.bridges(*_street_graph(v), 900.0, 40.0)


@query()
def closed_bends(v):
    return graph.closed_bends(*_street_graph(v), 135.0, 600.0)


@query()
def isolated_attached(v):
    return graph.attach_isolated(*_street_graph(v))


@query()
def connected_graph(v):
    return graph.connected(*_street_graph(v))


@query()
def dissolved_edges(v):
    return graph.dissolve_straight(*_street_graph(v))


@query()
def path5(v):
    edges = v.edges()
    return graph.simple_paths(edges, graph.degrees(edges).select("node"), 4)


@query()
def kmeans_blocks(v):
    return graph.kmeans_blocks(v.waypoints(), 20, 20)


@query("waypoints", "SELECT id % 20 AS block, count(*) AS n, min(x) AS min_x, min(y) AS min_y, max(x) AS max_x, max(y) AS max_y, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy FROM waypoints GROUP BY 1")
def block_extents(v):
    return analytics.block_extents(v.waypoints().withColumn("block", F.col("id") % 20))


@query("edges nodes", "SELECT a % 7 AS block, a, b FROM edges WHERE a % 7 = b % 7")
def block_edges(v):
    return graph.block_edges(v.edges(), v.nodes().select("id", (F.col("id") % 7).alias("block")))


def _angle(a: str, b: str, c: str) -> str:
    """Degrees at b between the ways to a and c, in SQL over (x, y)."""
    dot = f"(({a}.x - {b}.x) * ({c}.x - {b}.x) + ({a}.y - {b}.y) * ({c}.y - {b}.y))"
    size = f"(sqrt(({a}.x - {b}.x) ** 2 + ({a}.y - {b}.y) ** 2) * sqrt(({c}.x - {b}.x) ** 2 + ({c}.y - {b}.y) ** 2))"
    return f"degrees(acos(greatest(-1, least(1, {dot} / nullif({size}, 0)))))"


_STREETS = "e AS (SELECT c_custkey AS a, c_custkey + 3 AS b FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey + 3 IN (SELECT c_custkey FROM customer)), adj AS (SELECT a AS node, b AS other FROM e UNION ALL SELECT b, a FROM e), deg AS (SELECT node, count(*) AS d FROM adj GROUP BY 1)"
_TAKERS = """
p AS (SELECT b.id, list(a.id) AS before FROM nodes a JOIN nodes b ON a.id < b.id AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) < 100 GROUP BY b.id),
o AS (SELECT id, before, row_number() OVER (ORDER BY id) AS i FROM nodes LEFT JOIN p USING (id)),
g(i, takers) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL SELECT o.i, CASE WHEN before IS NOT NULL AND list_has_any(takers, before) THEN takers ELSE list_append(takers, id) END FROM g JOIN o ON o.i = g.i + 1),
t AS (SELECT unnest(takers) AS taker FROM (SELECT arg_max(takers, i) AS takers FROM g)),
w AS (SELECT id, CASE WHEN id IN (SELECT taker FROM t) THEN id ELSE (SELECT min(x) FROM (SELECT unnest(before) AS x) WHERE x IN (SELECT taker FROM t)) END AS taker FROM o)
SELECT w.taker AS id, round(round(avg(x), 9), 6) AS x, round(round(avg(y), 9), 6) AS y, round(round(avg(z), 9), 6) AS z FROM w JOIN nodes USING (id) GROUP BY w.taker"""
ORACLES["merged_nodes"] = with_views("nodes", "").rstrip().replace("WITH ", "WITH RECURSIVE ", 1) + ", " + _TAKERS
ORACLES["spur_ends"] = with_views("waypoints", "").rstrip() + f""", {_STREETS}, ends AS (SELECT adj.node, adj.other, o.d FROM adj JOIN deg n ON n.node = adj.node AND n.d = 1 JOIN deg o ON o.node = adj.other)
SELECT node, other FROM ends WHERE d > 2
UNION ALL SELECT ends.node, ends.other FROM ends JOIN adj k ON k.node = ends.other AND k.other <> ends.node JOIN waypoints p ON p.id = ends.node JOIN waypoints q ON q.id = ends.other JOIN waypoints r ON r.id = k.other
WHERE d = 2 AND 180 - {_angle("p", "q", "r")} > 75 AND NOT EXISTS (SELECT 1 FROM waypoints w WHERE w.id NOT IN (ends.node, ends.other) AND (w.x - p.x) ** 2 + (w.y - p.y) ** 2 <= 25 AND 180 - {_angle("q", "p", "w")} < 32)"""
ORACLES["short_cycles_removed"] = with_views("waypoints", "").rstrip().replace("WITH ", "WITH RECURSIVE ", 1) + f""", {_STREETS}, u AS (SELECT a, b FROM e UNION SELECT c_custkey, c_custkey + 6 FROM customer WHERE c_custkey + 6 IN (SELECT c_custkey FROM customer)),
s AS (SELECT a, b, (round(sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2), 6), a, b) AS o FROM u JOIN waypoints p ON p.id = a JOIN waypoints q ON q.id = b), ways AS (SELECT a AS f, b AS t, o FROM s UNION ALL SELECT b, a, o FROM s),
r(a, b, o, v, hops) AS (SELECT a, b, o, a, 0 FROM s UNION SELECT r.a, r.b, r.o, t, hops + 1 FROM r JOIN ways ON f = r.v AND ways.o < r.o WHERE hops < 5)
SELECT a, b FROM s WHERE (a, b) NOT IN (SELECT (a, b) FROM r WHERE v = b)"""
ORACLES["isolated_attached"] = with_views("waypoints", "").rstrip() + f""", {_STREETS}, single AS (SELECT id, x, y, d FROM waypoints LEFT JOIN deg ON node = id WHERE COALESCE(d, 0) < 2),
near AS (SELECT p.id, arg_min(q.id, (sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2), q.id)) AS other FROM single p JOIN single q ON p.id <> q.id WHERE p.d IS NULL GROUP BY p.id)
SELECT DISTINCT least(id, other) AS a, greatest(id, other) AS b FROM near"""


# --- rasters ----------------------------------------------------------------------------------------------------------------

_GROWN = "SELECT cx, cy FROM {0} UNION SELECT cx + i, cy + j FROM {0}, (VALUES (-1), (0), (1)) a(i), (VALUES (-1), (0), (1)) b(j), grid_size WHERE cx + i BETWEEN 1 AND w - 2 AND cy + j BETWEEN 1 AND h - 2"


@query("cells grid_size", f"SELECT * FROM (WITH once AS ({_GROWN.format('cells')}) {_GROWN.format('once')})")
def dilated_cells(v):
    return graph.dilate(v.cells(), *v.grid_size(), 2)


_SQUARES = "d AS (SELECT cx, cy, CASE " + " ".join(f"WHEN n{r} < (least(cx + {r}, w - 1) - greatest(cx - {r}, 0) + 1) * (least(cy + {r}, h - 1) - greatest(cy - {r}, 0) + 1) THEN {r}" for r in range(1, 7)) + " END AS dist FROM (SELECT c.cx, c.cy, w, h, " + ", ".join(f"count(*) FILTER (abs(i) <= {r} AND abs(j) <= {r}) AS n{r}" for r in range(1, 7)) + " FROM cells c, grid_size, (SELECT unnest(range(-6, 7)) AS i) a, (SELECT unnest(range(-6, 7)) AS j) b JOIN cells o ON o.cx = c.cx + i AND o.cy = c.cy + j GROUP BY c.cx, c.cy, w, h))"


@query()
def raster_distance(v):
    return graph.distance_transform(v.cells(), *v.grid_size())


@query()
def raster_ridges(v):
    return graph.ridges(graph.distance_transform(v.cells(), *v.grid_size()), *v.grid_size())


ORACLES["raster_distance"] = with_views("cells grid_size", "").rstrip() + f", {_SQUARES} SELECT cx, cy, dist FROM d"
ORACLES["raster_ridges"] = with_views("cells grid_size", "").rstrip() + f", {_SQUARES} SELECT d.cx, d.cy FROM d, grid_size WHERE d.cx BETWEEN 1 AND w - 2 AND d.cy BETWEEN 1 AND h - 2 AND NOT EXISTS (SELECT 1 FROM d o WHERE o.cx BETWEEN d.cx - 1 AND d.cx + 1 AND o.cy BETWEEN d.cy - 1 AND d.cy + 1 AND o.dist > d.dist)"


@query("cells", "SELECT c.cx AS ax, c.cy AS ay, o.cx AS bx, o.cy AS by FROM cells c JOIN cells o ON (o.cx = c.cx + 1 AND o.cy BETWEEN c.cy - 1 AND c.cy + 1) OR (o.cx = c.cx AND o.cy = c.cy + 1)")
def pixel_graph(v):
    return graph.pixel_graph(v.cells())


def _triangles(v):
    return v.streets().select(*[(F.col(n) / 50).alias(m) for n, m in (("ax", "x1"), ("ay", "y1"), ("bx", "x2"), ("by", "y2"))], ((F.col("ax") + 700) / 50).alias("x3"), ((F.col("ay") + 300) / 50).alias("y3"))


@query("streets", "SELECT DISTINCT cx, cy FROM (SELECT *, CAST(unnest(range(CAST(floor(least(x1, x2, x3)) AS BIGINT), CAST(floor(greatest(x1, x2, x3)) AS BIGINT) + 1)) AS BIGINT) AS cx FROM (SELECT ax / 50 AS x1, ay / 50 AS y1, bx / 50 AS x2, b_y / 50 AS y2, (ax + 700) / 50 AS x3, (ay + 300) / 50 AS y3 FROM streets)) t, LATERAL (SELECT unnest(range(CAST(floor(least(y1, y2, y3)) AS BIGINT), CAST(floor(greatest(y1, y2, y3)) AS BIGINT) + 1)) AS cy) r, LATERAL (SELECT (x2 - x1) * (cy + 0.5::DOUBLE - y1) - (y2 - y1) * (cx + 0.5::DOUBLE - x1) AS s1, (x3 - x2) * (cy + 0.5::DOUBLE - y2) - (y3 - y2) * (cx + 0.5::DOUBLE - x2) AS s2, (x1 - x3) * (cy + 0.5::DOUBLE - y3) - (y1 - y3) * (cx + 0.5::DOUBLE - x3) AS s3) q WHERE least(s1, s2, s3) >= 0 OR greatest(s1, s2, s3) <= 0")
def rasterised_cells(v):
    return graph.rasterise(_triangles(v))


# --- integrity --------------------------------------------------------------------------------------------------------------


def _owned(v):
    return v.table("customer").select(F.col("c_custkey").alias("edge_id"))


@query("rollup", "SELECT 'sunlit_above_samples' AS check_name, count(*) FILTER (sunlit_sum > sample_count) AS violations FROM rollup UNION ALL SELECT 'negative_sunlit', count(*) FILTER (sunlit_sum < 0) FROM rollup UNION ALL SELECT 'no_samples', count(*) FILTER (sample_count <= 0) FROM rollup UNION ALL SELECT 'null_key', count(*) FILTER (edge_id IS NULL OR datetime IS NULL) FROM rollup UNION ALL SELECT 'owned_edge_without_rows', count(*) FROM customer WHERE c_custkey NOT IN (SELECT edge_id FROM rollup)")
def integrity_checks(v):
    return integrity.violations(exposure.edge_rollup(v.samples()), _owned(v))


@query("rollup", "SELECT c_custkey AS edge_id FROM customer WHERE c_custkey NOT IN (SELECT edge_id FROM rollup)")
def owned_without_rows(v):
    return integrity.owned_without_rows(_owned(v), exposure.edge_rollup(v.samples()).select("edge_id"))


_LEAVES = "leaf AS (SELECT section_id, sim_date, window_index, count(*) AS actual FROM tasks WHERE state <> 'running' GROUP BY ALL), due AS (SELECT DISTINCT section_id, sim_date, window_index FROM tasks)"


@query()
def leaf_sizes(v):
    t = v.tasks()
    out = integrity.leaf_sizes(t.where("state <> 'running'"), v.sections().select("section_id", F.expr("sample_count div 30").alias("sample_count")), 1, t.select("section_id", "sim_date", "window_index"))
    return _texts(out, "sim_date")


ORACLES["leaf_sizes"] = with_views("tasks sections", "").rstrip() + f", {_LEAVES} SELECT section_id, CAST(sim_date AS VARCHAR) AS sim_date, window_index, COALESCE(actual, 0) AS actual, sample_count // 30 AS expected, COALESCE(actual, 0) - sample_count // 30 AS delta FROM due LEFT JOIN leaf USING (section_id, sim_date, window_index) JOIN sections USING (section_id) WHERE COALESCE(actual, 0) <> sample_count // 30"


@query("rollup tasks sections", "SELECT (SELECT count(*) FROM sections) AS sections, (SELECT count(*) FROM (SELECT DISTINCT section_id, sim_date, window_index FROM tasks)) AS leaves, (SELECT count(*) FROM rollup) AS edge_rows, (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT edge_id FROM rollup)) AS violations")
def shard_summary(v):
    return integrity.shard_summary(v.sections(), v.tasks(), exposure.edge_rollup(v.samples()), _owned(v))


@query("tasks", "SELECT 'attempts' AS check_name, count(*) FILTER (attempts > max_attempts) AS violations FROM tasks UNION ALL SELECT 'finished', count(*) FILTER (state = 'done' AND finished_at < started_at) FROM tasks UNION ALL SELECT 'cheap', count(*) FILTER (est_raycasts < 100000) FROM tasks")
def check_constraints(v):
    return integrity.broken(v.tasks(), {"attempts": "attempts <= max_attempts", "finished": "state <> 'done' OR finished_at >= started_at", "cheap": "est_raycasts >= 100000"})


@query("tasks", "SELECT DISTINCT 'exposure_s' || section_id || '_' || strftime(sim_date, '%Y%m%d') || '_w' || window_index AS name FROM tasks WHERE state = 'failed' AND (section_id, sim_date, window_index) NOT IN (SELECT (section_id, sim_date, window_index) FROM tasks WHERE state <> 'failed')")
def orphan_leaves(v):
    t = v.tasks().withColumn("name", timegrid.leaf_name(F.col("section_id"), F.col("sim_date"), F.col("window_index")))
    names = t.select("name").unionByName(t.select(F.concat(F.lit("other_"), "name").alias("name"))).distinct()
    return integrity.orphan_leaves(names, t.where("state <> 'failed'"))


@query("tasks", "SELECT section_id, count(*) AS leaves, CAST(sum(n) AS BIGINT) AS rows FROM (SELECT section_id, sim_date, window_index, count(*) AS n FROM tasks GROUP BY ALL) GROUP BY section_id")
def leaf_inventory(v):
    return integrity.leaf_inventory(v.tasks())


# --- capacity -----------------------------------------------------------------------------------------------------------------

_T = "45.0::DOUBLE / {k} + greatest(7886872800.0::DOUBLE / ({w} * (295759.35::DOUBLE * {k})), 7886872800.0::DOUBLE / ({s} * least(12, greatest(1, {w} // {s}) * 2) * (200000.0::DOUBLE * {k}))) + (7886872800.0::DOUBLE / (12000000.0::DOUBLE * {k}) + 144720000.0::DOUBLE / (600000.0::DOUBLE * {k})) / {s} + 30.0::DOUBLE / {k}"
_SHAPES = f"WITH g AS (SELECT w, s, greatest(1, CAST(floor(w * 0.9::DOUBLE) AS BIGINT)) AS lw, greatest(1, s - 1) AS ls FROM range(1, 201) a(w), range(1, 41) b(s)), shapes AS (SELECT w AS workers, s AS shards, w * 8 + s * 16 + 12 AS vcpu, {_T.format(w='w', s='s', k='1.0::DOUBLE')} AS nominal, {_T.format(w='w', s='s', k='0.85::DOUBLE')} AS pessimistic, {_T.format(w='lw', s='ls', k='0.85::DOUBLE')} AS failure, s > 1 AND ls * least(12, greatest(1, w // ls) * 2) * 200000.0::DOUBLE / (w * 295759.35::DOUBLE) - 1 >= 0.1 AS survives, least(12, greatest(1, w // s) * 2) >= 12 AS saturated FROM g) "


@query("", _SHAPES + "SELECT workers, shards, vcpu, round(nominal, 3) AS nominal, round(1 - failure / 900, 6) AS slack FROM shapes WHERE greatest(nominal, pessimistic, failure) <= 900 AND survives AND saturated ORDER BY vcpu, failure, workers, shards LIMIT 1")
def derive_shape(v):
    return capacity.derive_shape(capacity.shapes(v.spark)).select("workers", "shards", "vcpu", F.round("nominal", 3).alias("nominal"), F.round("slack", 6).alias("slack"))


@query("", _SHAPES + "SELECT vcpu, round(nominal, 3) AS nominal, workers, shards FROM (SELECT *, min(nominal) OVER (ORDER BY vcpu ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS f FROM (SELECT vcpu, min(nominal) AS nominal, arg_min(workers, (nominal, workers, shards)) AS workers, arg_min(shards, (nominal, workers, shards)) AS shards FROM shapes GROUP BY vcpu)) WHERE f IS NULL OR nominal < f - 1e-9")
def pareto_frontier(v):
    return capacity.pareto_frontier(capacity.shapes(v.spark)).select("vcpu", F.round("nominal", 3).alias("nominal"), "workers", "shards")


@query("", _SHAPES + "SELECT count(*) FILTER (greatest(nominal, pessimistic, failure) <= 900) AS deadlines, count(*) FILTER (greatest(nominal, pessimistic, failure) <= 900 AND survives AND saturated) AS passing FROM shapes")
def feasible_shapes(v):
    return capacity.shapes(v.spark).agg(F.count_if("deadlines_ok").alias("deadlines"), F.count_if("passes").alias("passing"))


@query("", _SHAPES + "SELECT workers, min(shards) AS shards FROM shapes WHERE shards * least(12, greatest(1, workers // shards) * 2) * 200000.0::DOUBLE >= workers * 295759.35::DOUBLE GROUP BY workers")
def balanced_shards(v):
    return capacity.balanced_shards(capacity.shapes(v.spark))


@query("", _SHAPES + "SELECT workers, shards, vcpu, workers * 16 + shards * 128 + 34 AS ram_gb, round(nominal, 3) AS nominal FROM shapes WHERE nominal <= 900 ORDER BY vcpu, workers, shards LIMIT 1")
def cheapest_nominal(v):
    return capacity.cheapest_nominal(capacity.shapes(v.spark)).select("workers", "shards", "vcpu", "ram_gb", F.round("nominal", 3).alias("nominal"))


_MAP = "greatest(7886872800.0::DOUBLE / (workers * 295759.35::DOUBLE), 7886872800.0::DOUBLE / (shards * least(12, greatest(1, workers // shards) * 2) * 200000.0::DOUBLE))"


@query("", _SHAPES + f"SELECT workers, shards, 90 AS floor, CAST(floor({_MAP} - 60) AS INTEGER) AS ceiling, round(greatest(0, ({_MAP} - 180 - 7886872800.0::DOUBLE / (84 * 60 * 6) / 295759.35::DOUBLE) / {_MAP}), 9) AS coverage FROM shapes WHERE {_MAP} >= 60")
def lease_bounds(v):
    return capacity.leases(capacity.shapes(v.spark)).where("ceiling >= 0").withColumn("coverage", F.round("coverage", 9))


_SWEEP = f"SELECT workers, shards, round(shards * least(12, greatest(1, workers // shards) * 2) * 200000.0::DOUBLE, 3) AS ingest, round({_MAP}, 6) AS map_seconds, round((7886872800.0::DOUBLE / 12000000 + 144720000.0::DOUBLE / 600000) / shards + 30, 6) AS reduce_seconds, round(nominal, 6) AS total_seconds, round(7886872800.0::DOUBLE / 73027 / nominal, 6) AS speedup, CASE WHEN shards * least(12, greatest(1, workers // shards) * 2) * 200000.0::DOUBLE < workers * 295759.35::DOUBLE THEN 'I/O-bound' ELSE 'compute-bound' END AS bound_by FROM shapes"


def _rounded(df):
    return df.withColumns({c: F.round(c, 3 if c == "ingest" else 6) for c in ("ingest", "map_seconds", "reduce_seconds", "total_seconds", "speedup")})


@query("", _SHAPES + _SWEEP + " WHERE workers = 54 AND shards IN (1, 2, 4, 6, 8, 10, 14, 20, 30)")
def shard_sweep(v):
    return _rounded(capacity.shard_sweep(capacity.shapes(v.spark)))


@query("", _SHAPES + _SWEEP + " JOIN (SELECT workers AS bw, min(shards) AS bs FROM shapes WHERE shards * least(12, greatest(1, workers // shards) * 2) * 200000.0::DOUBLE >= workers * 295759.35::DOUBLE GROUP BY workers) ON bw = workers AND bs = shards WHERE workers IN (1, 5, 10, 25, 50, 100, 200)")
def worker_sweep(v):
    return _rounded(capacity.worker_sweep(capacity.shapes(v.spark)))


@query("", "WITH g(t, n) AS (VALUES ('waypoints', 4168), ('edges', 6700), ('sample_points', 365133), ('edge_sections', 6700)), c AS (SELECT * FROM g UNION ALL VALUES ('trees', 1280954), ('tasks', 30240), ('sections', 84), ('shards', 9), ('runs', 1), ('grid', 1)), s AS (SELECT * FROM g UNION ALL VALUES ('exposure_samples', 7886872800 // 9), ('exposure_edges', 144720000 // 9)), a AS (SELECT 'exposure_samples' AS t, 7886872800 AS n UNION ALL VALUES ('exposure_edges', 144720000) UNION ALL SELECT 'geometry', 9 * sum(n) FROM g UNION ALL SELECT 'coordinator', sum(n) FROM c) SELECT place, t AS \"table\", CAST(n AS BIGINT) AS rows FROM (SELECT 'coordinator' AS place, * FROM c UNION ALL SELECT 'shard', * FROM s UNION ALL SELECT 'cluster', * FROM a UNION ALL SELECT 'coordinator', 'total', sum(n) FROM c UNION ALL SELECT 'shard', 'total', sum(n) FROM s UNION ALL SELECT 'cluster', 'total', sum(n) FROM a)")
def inventory(v):
    return capacity.inventory(v.spark)


@query("", "SELECT n_nationkey, CASE WHEN n < 1000 THEN printf('%.0f', n) WHEN n < 1000000 THEN printf('%.0fK', n / 1000) WHEN n < 1000000000 THEN printf('%.0fM', n / 1000000) ELSE printf('%.0fB', n / 1000000000) END AS human, CASE WHEN s >= 3600 THEN printf('%.2f h', s / 3600) WHEN s >= 60 THEN printf('%dm %04.1fs', CAST(floor(s / 60) AS BIGINT), s - 60 * floor(s / 60)) ELSE printf('%.0f s', s) END AS took FROM (SELECT n_nationkey, 7.0::DOUBLE * pow(3, n_nationkey % 18) AS n, 1.3::DOUBLE * pow(2, n_nationkey % 14) AS s FROM nation)")
def formatted_numbers(v):
    k = F.col("n_nationkey")
    return v.table("nation").select(k, report.human(7.0 * F.pow(F.lit(3.0), k % 18)).alias("human"), report.duration(1.3 * F.pow(F.lit(2.0), k % 14)).alias("took"))
