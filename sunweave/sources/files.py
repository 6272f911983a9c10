"""Readers and writers of the engine's files, all with explicit schemas."""

from __future__ import annotations

import struct
import warnings
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunweave.functions.spatial import in_box
from sunweave.operators.prefix import running
from sunweave.sources.shared import delete

TREE_CSV = "unity_x double, unity_z double, shade_norm double"
GRAPH_JSON = "vertices array<struct<id: string, x: double, y: double, z: double>>, edges array<struct<`from`: string, `to`: string, a: string, b: string>>"
ROUTE_CSV = "path string, date string, start_time_hhmm string, exposure double, length_m double"
ELEVATION = -112.0


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything lies at a path or matches its pattern, through the file system it names."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jpath)
    return found is not None and len(found) > 0


def read_trees(spark: SparkSession, path: str) -> DataFrame:
    """(id, x, y, z, shade_norm) from a CSV with a header; ids are hashes of the content, so that reading again agrees.

    A missing file warns and has no trees.
    """
    if not exists(spark, path):
        warnings.warn(f"no trees at {path}", stacklevel=2)
        return spark.createDataFrame([], "id string, x double, y double, z double, shade_norm double")
    rows = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    x, y, s = (F.expr(f"try_cast(`{c}` AS double)") for c in ("unity_x", "unity_z", "shade_norm"))
    rows = rows.select(x.alias("x"), y.alias("y"), F.lit(ELEVATION).alias("z"), s.alias("shade_norm")).where("x IS NOT NULL AND y IS NOT NULL")
    return rows.select(F.md5(F.concat_ws("|", "x", "y", "shade_norm").cast("binary")).alias("id"), "x", "y", "z", "shade_norm")


def read_graph(spark: SparkSession, *paths: str, box: tuple[float, float, float, float] | None = None) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of the first of the paths that exists; stored plane coordinates swap the world's axes (x, z).

    A box (x1, y1, x2, y2) leaves the nodes inside and the edges both of whose ends are.
    """
    path = next((p for p in paths if exists(spark, p)), None)
    if path is None:
        raise FileNotFoundError(f"no graph at any of {paths}")
    nodes, edges = _graph(spark, path)
    if box is None:
        return nodes, edges
    nodes = nodes.where(in_box(F.col("x"), F.col("y"), *box))
    for k in ("a", "b"):
        edges = edges.join(nodes.select(F.col("id").alias(k)), k, "left_semi")
    return nodes, edges.select("a", "b")


def _graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    doc = spark.read.schema(GRAPH_JSON).option("multiLine", True).json(path)
    v = doc.select(F.explode("vertices").alias("v"))
    nodes = v.select("v.id", F.col("v.x").alias("x"), F.col("v.z").alias("y"), F.col("v.y").alias("z"))
    e = doc.select(F.explode("edges").alias("e"))
    return nodes, e.select(F.coalesce("e.from", "e.a").alias("a"), F.coalesce("e.to", "e.b").alias("b"))


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """One graph document, as ``read_graph`` reads it: the vertices a line each, then the edges, with the commas between.

    Lines are made and ordered by ranges; one task joins the parts to one file, without holding them.
    """
    n, e = F.to_json(F.struct(F.col("id").cast("string").alias("id"), "x", F.col("z").alias("y"), F.col("y").alias("z"))), F.to_json(F.struct(F.col("a").cast("string").alias("from"), F.col("b").cast("string").alias("to")))
    part = lambda df, kind, line, *order: df.select(F.lit(kind).alias("kind"), F.concat_ws("/", *[F.col(c).cast("string") for c in order]).alias("key"), line.alias("line"))
    z = nodes if "z" in nodes.columns else nodes.withColumn("z", F.lit(0.0))
    lines = part(z, 1, n, "id").unionByName(part(edges, 3, e, "a", "b"))
    lines = running(lines, [F.col("kind"), F.col("key")], "rank")
    firsts = lines.groupBy(F.col("kind").alias("k")).agg(F.min("rank").alias("first"))
    lines = lines.join(F.broadcast(firsts), F.col("kind") == F.col("k"))  # two rows
    body = lines.select("kind", "rank", F.concat(F.when(F.col("rank") == F.col("first"), "").otherwise(","), F.col("line")).alias("value"))
    frame = nodes.sparkSession.createDataFrame([(0, -1, '{"vertices":['), (2, -1, '],"edges":['), (4, -1, "]}")], "kind int, rank long, value string")
    frame.unionByName(body).orderBy("kind", "rank").select("value").coalesce(1).write.mode("overwrite").text(path)


def write_points_csv(points: DataFrame, path: str) -> None:
    """point_id, x, y, z with four places and a header; stored plane coordinates swap the world's axes."""
    place = lambda c: F.format_string("%.4f", F.col(c).cast("double"))
    points.select(F.col("id").alias("point_id"), place("x").alias("x"), place("z").alias("y"), place("y").alias("z")).write.mode("overwrite").option("header", True).csv(path)


def read_routes(spark: SparkSession, path: str, waypoints: DataFrame) -> DataFrame:
    """(path_id, date, start, exposure, length_m, position, id, x, y): one row a waypoint of each route.

    path, date and start_time_hhmm must be named in the header, wherever they stand; exposure and length_m are 0 where they
    are missing or no number. Rows without one of the three go, and so do ids that no waypoint has.
    """
    rows = spark.read.option("header", True).option("quote", '"').option("mode", "PERMISSIVE").csv(path)
    if missing := {"path", "date", "start_time_hhmm"} - set(rows.columns):
        raise ValueError(f"no column {', '.join(sorted(missing))} in {path}")
    number = lambda c: F.coalesce(F.expr(f"try_cast(`{c}` AS double)") if c in rows.columns else F.lit(None).cast("double"), F.lit(0.0))
    rows = rows.where("path IS NOT NULL AND date IS NOT NULL AND start_time_hhmm IS NOT NULL").withColumns({"exposure": number("exposure"), "length_m": number("length_m")})
    rows = rows.withColumn("path_id", F.md5(F.concat_ws("|", "date", "start_time_hhmm", "path").cast("binary")))
    each = rows.select("path_id", "date", F.col("start_time_hhmm").alias("start"), "exposure", "length_m", F.posexplode(F.split("path", ",")).alias("position", "id"))
    each = each.withColumn("id", F.trim("id")).where(~F.col("id").isin("START", "END"))
    return each.join(waypoints.select("id", "x", "y"), "id").select("path_id", "date", "start", "exposure", "length_m", "position", "id", "x", "y")


_MAGIC = b"SLRD"


def read_ephemeris(spark: SparkSession, path: str) -> DataFrame:
    """(year, doy, minute, azimuth, elevation) from binary files: a 16-byte header, then pairs of 32-bit floats."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content").to_pylist():
                magic, version, year, count, _ = struct.unpack_from("<4shhii", data)
                if magic != _MAGIC or version != 1:
                    raise ValueError("not an ephemeris of version 1")
                count = min(count, (len(data) - 16) // 8)
                if count <= 0:
                    raise ValueError("an ephemeris without entries")
                values = np.frombuffer(data, "<f4", 2 * count, 16).reshape(-1, 2)
                i = np.arange(count)
                yield pa.RecordBatch.from_pydict({"year": pa.array(np.full(count, year, np.int32)), "doy": pa.array((i // 1440 + 1).astype(np.int32)), "minute": pa.array((i % 1440).astype(np.int32)), "azimuth": pa.array(values[:, 0]), "elevation": pa.array(values[:, 1])})

    return files.mapInArrow(run, "year int, doy int, minute int, azimuth float, elevation float")


def ephemeris_bytes(year: int, rows: list[tuple[float, float]] | np.ndarray) -> bytes:
    """The binary form of one year's (azimuth, elevation) by minute; a year has half a million, whatever the data."""
    return struct.pack("<4shhii", _MAGIC, 1, year, len(rows), 0) + np.array(rows, "<f4").tobytes()


def write_ephemeris(rows: DataFrame, path: str) -> None:
    """A file ephemeris-<year>.bin a year of (year, doy, minute, azimuth, elevation), written by the task that has the year.

    Minutes follow each other from the first of January on; a missing one takes the values before it, as does a null.
    """
    spark = rows.sparkSession
    names = ("azimuth", "elevation")
    index = (F.col("doy") - 1) * 1440 + F.col("minute")
    years = rows.groupBy("year").agg(F.max(index).alias("last"))
    every = years.select("year", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("i"))
    told = rows.select("year", index.alias("i"), *[F.col(c).cast("double") for c in names])
    before = Window.partitionBy("year").orderBy("i")
    whole = every.join(told, ["year", "i"], "left").select("year", "i", *[F.coalesce(F.last(c, ignorenulls=True).over(before), F.lit(0.0)).alias(c) for c in names])

    def put(table: pa.Table) -> pa.Table:
        import pyarrow.fs

        table = table.sort_by("i")
        year = table.column("year")[0].as_py()
        fs, base = pyarrow.fs.FileSystem.from_uri(path)
        fs.create_dir(base, recursive=True)
        values = np.column_stack([table.column(c).to_numpy() for c in names])
        with fs.open_output_stream(f"{base}/ephemeris-{year}.bin") as out:
            out.write(ephemeris_bytes(year, values))
        return pa.table({"year": pa.array([year], pa.int32()), "minutes": pa.array([len(values)], pa.int64())})

    # A year has half a million minutes at most, whatever the data.
    whole.groupBy("year").applyInArrow(put, "year int, minutes long").write.format("noop").mode("overwrite").save()
    if not exists(spark, f"{path}/*.bin"):
        raise ValueError("an ephemeris without entries")


def read_ephemeris_csv(spark: SparkSession, path: str) -> DataFrame:
    """(i, datetime, azimuth, elevation) from a CSV; unreadable values take the last readable ones before them."""
    rows = spark.read.schema("datetime string, azimuth string, apparent_elevation string").option("header", True).csv(path)
    rows = rows.withColumn("i", F.monotonically_increasing_id())
    year = Window.partitionBy(F.substring("datetime", 1, 4)).orderBy("i")
    fill = lambda c: F.last(F.expr(f"try_cast({c} AS double)"), ignorenulls=True).over(year)
    return rows.select("i", "datetime", fill("azimuth").alias("azimuth"), fill("apparent_elevation").alias("elevation"))


def convert_ephemeris(spark: SparkSession, source: str, path: str) -> None:
    """CSV to binary: rows in order are the minutes of their year."""
    rows = read_ephemeris_csv(spark, source).withColumn("year", F.substring("datetime", 1, 4).cast("int"))
    n = F.row_number().over(Window.partitionBy("year").orderBy("i")) - 1
    write_ephemeris(rows.select("year", (F.floor(n / 1440) + 1).cast("int").alias("doy"), (n % 1440).cast("int").alias("minute"), "azimuth", "elevation"), path)


def write_ephemeris_csv(rows: DataFrame, path: str) -> None:
    """datetime, azimuth, apparent_elevation with a header, in order."""
    day = F.make_date("year", F.lit(1), F.lit(1)).cast("timestamp_ntz")
    at = day + F.make_dt_interval(F.col("doy") - 1, F.lit(0), F.col("minute"), F.lit(0))
    out = rows.select(F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("datetime"), "azimuth", F.col("elevation").alias("apparent_elevation"))
    out.orderBy("datetime").write.mode("overwrite").option("header", True).csv(path)


def make_ephemeris(spark: SparkSession, year: int, latitude: float, longitude: float, utc_offset_hours: float) -> DataFrame:
    """(year, doy, minute, azimuth, elevation) of each minute of a year in a fixed offset, by column expressions."""
    from sunweave.functions.solar import sun_position

    days = 366 if year % 4 == 0 and (year % 100 or year % 400 == 0) else 365
    rows = spark.range(days * 1440).select(F.lit(year).alias("year"), (F.expr("id div 1440") + 1).cast("int").alias("doy"), (F.col("id") % 1440).cast("int").alias("minute"))
    return rows.withColumn("s", sun_position(F.col("doy"), F.col("minute"), latitude, longitude, utc_offset_hours)).select("year", "doy", "minute", "s.azimuth", "s.elevation")


def read_od(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, day_type, hour, trips, min_exposure, max_exposure) from wide files with a column for each type and hour."""
    rows = spark.read.option("header", True).csv(paths).withColumn("file", F.col("_metadata.file_name"))
    value = lambda c: F.expr(f"try_cast(`{c}` AS double)") if c in rows.columns else F.lit(None).cast("double")
    each = [F.struct(F.lit(t).alias("day_type"), F.lit(h).alias("hour"), value(f"{t}_{h}").alias("trips"), value(f"min_{t}_{h}").alias("min_exposure"), value(f"max_{t}_{h}").alias("max_exposure")) for t in ("wkdy", "wknd") for h in range(3, 21)]
    return rows.select("file", F.inline(F.array(*each)))


def write_facts(facts: DataFrame, path: str) -> None:
    """Replaces exactly the leaves that facts has rows of; a leaf becomes visible whole."""
    leaves = facts.repartition("section_id", "sim_date", "window_index").sortWithinPartitions("section_id", "sim_date", "window_index", "datetime", "sample_point_id")
    leaves.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("section_id", "sim_date", "window_index").parquet(path)


def read_facts(spark: SparkSession, path: str, section: int | None = None, day: object = None, windows: list[int] | None = None) -> DataFrame:
    """The facts, with predicates on the partition columns, which prune whole leaves where timestamps alone wouldn't."""
    df = spark.read.parquet(path)
    for name, value in (("section_id", section), ("sim_date", day)):
        df = df.where(F.col(name) == F.lit(value)) if value is not None else df
    return df.where(F.col("window_index").isin(windows)) if windows is not None else df


def append_facts(facts: DataFrame, path: str) -> None:
    """Rows (sample_point_id, datetime, is_sunlit) as text, added to what is there; blocks that come twice stay twice."""
    facts.select("sample_point_id", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"), F.when(F.col("is_sunlit"), "t").otherwise("f").alias("is_sunlit")).write.mode("append").csv(path, sep="\t")


def read_appended_facts(spark: SparkSession, path: str, id_type: str = "string") -> DataFrame:
    rows = spark.read.schema(f"sample_point_id {id_type}, datetime timestamp_ntz, state string").option("sep", "\t").csv(path)
    return rows.select("sample_point_id", "datetime", (F.col("state") == "t").alias("is_sunlit"))


def missing_facts(wanted: DataFrame, path: str) -> DataFrame:
    """Rows of wanted (sample_point_id, datetime) that no appended fact is there for, all of them where there is none."""
    spark = wanted.sparkSession
    if not exists(spark, path):
        return wanted
    there = read_appended_facts(spark, path, wanted.schema["sample_point_id"].dataType.simpleString())
    return wanted.join(there.select("sample_point_id", "datetime"), ["sample_point_id", "datetime"], "left_anti")


def delete_leaves(spark: SparkSession, path: str, leaves: list[tuple[int, object, int]]) -> None:
    """Removes the folders of (section, date, window) leaves, those that aren't there too."""
    for section, day, window in leaves:
        delete(spark, f"{path}/section_id={section}/sim_date={day}/window_index={window}")


def sweep_unfinished(spark: SparkSession, path: str) -> list[str]:
    """Removes what writers that died left beside the leaves, and returns the folders: names that start with _ or a dot."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath().toString() for f in (fs.listStatus(fs_path) if fs.exists(fs_path) else []) if f.isDirectory() and f.getPath().getName()[:1] in "_."]
    for folder in found:
        delete(spark, folder)
    return found


def point_wkt(x: Column, y: Column, z: Column) -> Column:
    return F.format_string("POINT Z (%s %s %s)", x.cast("string"), y.cast("string"), z.cast("string"))


def line_wkt(*points: tuple[Column, Column, Column]) -> Column:
    texts = [F.concat_ws(" ", *[c.cast("string") for c in p]) for p in points]
    return F.concat(F.lit("LINESTRING Z ("), F.concat_ws(", ", *texts), F.lit(")"))


_SQL_TYPES = {"tinyint": "SMALLINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT", "float": "REAL", "double": "DOUBLE PRECISION", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP", "binary": "BYTEA"}


def create_statement(df: DataFrame, table: str) -> str:
    """CREATE TABLE for the columns of df; decimals keep their digits, what SQL has no type for is text."""
    kind = lambda t: t.upper() if t.startswith("decimal") else _SQL_TYPES.get(t, "TEXT")
    return f"CREATE TABLE {table} (" + ", ".join(f"{f.name} {kind(f.dataType.simpleString())}" for f in df.schema) + ");"


def insert_statements(df: DataFrame, table: str) -> DataFrame:
    """One INSERT statement a row, with NULL, booleans and quotes as SQL has them."""
    quote = lambda c: F.concat(F.lit("'"), F.replace(F.col(c).cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))
    value = lambda f: F.coalesce(F.upper(F.col(f.name).cast("string")) if f.dataType.simpleString() == "boolean" else quote(f.name) if f.dataType.simpleString() in ("string", "date", "timestamp", "timestamp_ntz") else F.col(f.name).cast("string"), F.lit("NULL"))
    values = F.concat_ws(", ", *[value(f) for f in df.schema])
    return df.select(F.concat(F.lit(f"INSERT INTO {table} VALUES ("), values, F.lit(");")).alias("statement"))


def dump_script(tables: dict[str, DataFrame], path: str) -> None:
    """A folder a table of its CREATE statement and, after it, an INSERT a row."""
    for name, df in tables.items():
        create = df.sparkSession.createDataFrame([(create_statement(df, name),)], "statement string")
        create.coalesce(1).write.mode("overwrite").text(f"{path}/{name}")
        insert_statements(df, name).write.mode("append").text(f"{path}/{name}")


def dump_tables(tables: dict[str, DataFrame], path: str, kind: str = "csv") -> None:
    """Every table to a folder of its own: csv to look at, parquet as a backup that ``restore_tables`` reads."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).format(kind).save(f"{path}/{name}")


def restore_tables(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path}/{n}") for n in names}


def cached(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at path, made and written there first where it isn't yet: an aggregate that is computed once."""
    if not exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").json(path)
    return spark.read.json(path)
