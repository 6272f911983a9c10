"""What tables there are: names, columns, leaves and sizes, read from the file system and the session's catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunweave.functions.timegrid import leaf_name


def tables(spark: SparkSession, folder: str) -> DataFrame:
    """(table, bytes) of the folders and files of a warehouse folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    rows = [(f.getPath().getName().removesuffix(".parquet"), fs.getContentSummary(f.getPath()).getLength()) for f in fs.listStatus(path) if f.getPath().getName()[:1] not in "._"]
    return spark.createDataFrame(rows, "table string, bytes long")


def columns(tables_: dict[str, DataFrame]) -> DataFrame:
    """(table, position, column, type, nullable) of named tables."""
    rows = [(n, i, f.name, f.dataType.simpleString(), f.nullable) for n, df in tables_.items() for i, f in enumerate(df.schema)]
    return next(iter(tables_.values())).sparkSession.createDataFrame(rows, "table string, position int, column string, type string, nullable boolean")


def leaves(facts: DataFrame) -> DataFrame:
    """(section_id, sim_date, window_index, name, files, rows, bytes) of stored facts; only footers of the files are read for rows."""
    keys = ["section_id", "sim_date", "window_index"]
    rows = facts.groupBy(*keys, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).agg(F.count("*").alias("n"))
    out = rows.groupBy(*keys).agg(F.count("*").alias("files"), F.sum("n").alias("rows"), F.sum("size").alias("bytes"))
    return out.select(*keys, leaf_name(F.col("section_id"), F.col("sim_date").cast("date"), F.col("window_index")).alias("name"), "files", "rows", "bytes")


def tree_size(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path, 0 where there is none."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(jpath).getLength() if fs.exists(jpath) else 0
