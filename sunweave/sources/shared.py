"""Tables written between the steps of a job, in the folder all executors share.

A written table cuts lineage, so that losing an executor costs one task's work and not the whole plan. The folder is
the one the cluster names in ``spark.checkpoint.dir``; only where that is unset and the executors are threads of the
driver (tests, notebooks) a local one is made, and a cluster without one is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_written: list[tuple[str, object]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session, without a trailing slash."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that the executors of {master} share")
        where = "file://" + tempfile.mkdtemp(prefix="sunweave-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/sunweave/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or folder, through the file system its path names."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def sweep(spark: SparkSession) -> None:
    """Deletes the written tables that no plan can reach any more."""
    for entry in list(_written):
        if entry[1].get() is None:
            _written.remove(entry)
            delete(spark, entry[0])


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it again: each row is computed once.

    The files live as long as a plan that reads them: a weak reference to the relation tells when they can go.
    """
    spark = df.sparkSession
    sweep(spark)
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    again = spark.read.schema(df.schema).parquet(path)
    held_by(again, path)
    return again


def held_by(table: DataFrame, path: str) -> None:
    """Has path deleted when no plan that reads the written table is left; for files that such a table names."""
    relation = table._jdf.queryExecution().analyzed().relation().location()
    _written.append((path, table.sparkSession._jvm.java.lang.ref.WeakReference(relation)))


def row_key(df: DataFrame) -> Column:
    """128 bits of hashes of all columns, nulls told apart by place: equal for repeated rows only. Maps can't be hashed."""
    every = [*(F.col(f"`{c}`") for c in df.columns), *(F.col(f"`{c}`").isNull() for c in df.columns)]
    return F.concat_ws("-", *(F.hex(F.xxhash64(F.lit(i), *every)) for i in (1, 2)))


def one_of_repeated(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """df with one of the rows of each key that keys has more than once; only those rows are dealt out by key."""
    many = written(keys.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key), "repeated")
    if many.isEmpty():
        return df
    return df.join(many, key, "left_anti").unionByName(df.join(many, key, "left_semi").dropDuplicates([key]))
