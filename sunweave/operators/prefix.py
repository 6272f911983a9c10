"""Ranks and running sums over all rows of a table, without a window that gathers them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunweave.sources.shared import written


def running(df: DataFrame, order: list[Column], rank: str | None = None, sums: dict[str, str] | None = None) -> DataFrame:
    """df with its rank from 0 in a total order and, by name, the sums of columns over all rows before.

    Rows are dealt out by ranges of the order; each range counts its own, and of each range one row is summed up. Equal
    rows of the order share a range but get ranks of their own. Columns named _range or _first are taken for the work.
    """
    sums = sums or {}
    rows = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id()), "ordered")
    every = rows.groupBy("_range").agg(F.count("*").alias("_n"), *[F.sum(c).alias(n) for n, c in sums.items()])
    ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    nothing = {n: F.lit(0) for n in ("_n", *sums)}
    before = every.select("_range", F.struct(*[F.coalesce(F.sum(n).over(ranges), z).alias(n) for n, z in nothing.items()]).alias("_first"))
    own = Window.partitionBy("_range").orderBy(*order)
    rows = rows.join(F.broadcast(before), "_range")  # a row for each range
    if rank:
        rows = rows.withColumn(rank, F.col("_first._n") + F.row_number().over(own) - 1)
    for n, c in sums.items():
        rows = rows.withColumn(n, F.col("_first")[n] + F.coalesce(F.sum(c).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return rows.drop("_range", "_first")
