"""Texts of reports: numbers and durations for people, and the report of partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def human(n: Column) -> Column:
    """A count without places in the largest unit that leaves it below a thousand; beyond billions, trillions with one place."""
    v, out = n.cast("double"), F.format_string("%.1fT", n.cast("double") / 1e12)
    for power, sign in ((9, "B"), (6, "M"), (3, "K"), (0, "")):
        unit = float(10**power)
        out = F.when(F.abs(v) < 1000 * unit, F.format_string(f"%.0f{sign}", v / unit)).otherwise(out)
    return out


def duration(seconds: Column) -> Column:
    """Hours from one hour on, minutes and seconds from one minute on, else seconds."""
    s = seconds.cast("double")
    minutes = F.format_string("%dm %04.1fs", F.floor(s / 60).cast("long"), s - 60 * F.floor(s / 60))
    return F.when(s >= 3600, F.format_string("%.2f h", s / 3600)).when(s >= 60, minutes).otherwise(F.format_string("%.0f s", s))


def bar(part: Column, width: int = 20) -> Column:
    """A share of 0 to 1 as a bar of so many signs."""
    full = F.greatest(F.lit(0), F.least(F.lit(width), F.rint(part * width).cast("int")))
    return F.concat(F.repeat(F.lit("#"), full), F.repeat(F.lit("."), width - full))


def partition_lines(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """(block, line): a line a block with its size, box, centre and, if one was found, its path.

    blocks: (block, n, min_x, min_y, max_x, max_y, cx, cy); paths: (block, path array).
    """
    j = blocks.join(paths, "block", "left")
    path = F.coalesce(F.array_join("path", " -> "), F.lit("no path"))
    at = lambda *c: F.format_string("(%.1f, %.1f)", *[F.col(x).cast("double") for x in c])
    line = F.concat(F.lit("block "), F.col("block").cast("string"), F.lit(": "), F.col("n").cast("string"), F.lit(" nodes, "), at("min_x", "min_y"), F.lit(" to "), at("max_x", "max_y"), F.lit(", centre "), at("cx", "cy"), F.lit("; "), path)
    return j.select("block", line.alias("line"))
