"""Checks of the stored facts and rollups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def leaf_sizes(facts: DataFrame, sections: DataFrame, steps: int, leaves: DataFrame | None = None) -> DataFrame:
    """Leaves whose rows differ from samples times steps. facts have section_id, sim_date and window_index.

    leaves: those that should be there, (section_id, sim_date, window_index); without it, those that have a row.
    """
    keys = ["section_id", "sim_date", "window_index"]
    actual = facts.groupBy(*keys).agg(F.count("*").alias("actual"))
    if leaves is not None:
        actual = leaves.select(*keys).distinct().join(actual, keys, "full").withColumn("actual", F.coalesce("actual", F.lit(0)))
    j = actual.join(sections.select("section_id", (F.col("sample_count") * steps).alias("expected")), "section_id", "left")
    j = j.withColumn("expected", F.coalesce("expected", F.lit(0)))
    return j.withColumn("delta", F.col("actual") - F.col("expected")).where("delta <> 0").select(*keys, "actual", "expected", "delta")


def leaf_inventory(facts: DataFrame) -> DataFrame:
    leaves = facts.groupBy("section_id", "sim_date", "window_index").agg(F.count("*").alias("n"))
    return leaves.groupBy("section_id").agg(F.count("*").alias("leaves"), F.sum("n").alias("rows"))


def violations(rollup: DataFrame, owned_edges: DataFrame) -> DataFrame:
    """(check_name, violations): all counters of one pass over the rollup, and owned edges without rows."""
    checks = {
        "sunlit_above_samples": F.col("sunlit_sum") > F.col("sample_count"),
        "negative_sunlit": F.col("sunlit_sum") < 0,
        "no_samples": F.col("sample_count") <= 0,
        "null_key": F.col("edge_id").isNull() | F.col("datetime").isNull(),
    }
    one = rollup.agg(*[F.count_if(c).alias(n) for n, c in checks.items()])
    rows = one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("violations")) for n in checks])))
    missing = owned_edges.join(rollup.select("edge_id").distinct(), "edge_id", "left_anti").agg(F.count("*").alias("violations"))
    return rows.unionByName(missing.select(F.lit("owned_edge_without_rows").alias("check_name"), "violations"))


def owned_without_rows(owned_edges: DataFrame, rollup: DataFrame) -> DataFrame:
    return owned_edges.join(rollup, "edge_id", "left_anti")


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """(side, rows): rows of either side that the other lacks, counted with repeats; 0 and 0 prove equality."""
    sides = [x.exceptAll(y).agg(F.count("*").alias("rows")).select(F.lit(n).alias("side"), "rows") for n, x, y in (("left", a, b), ("right", b, a))]
    return reduce(DataFrame.unionByName, sides)


def orphan_leaves(names: DataFrame, attached: DataFrame) -> DataFrame:
    """Names of leaves, by their pattern (an underscore is one), that no attached leaf has."""
    leaf = F.col("name").like(r"exposure\_s%\_w%")
    return names.where(leaf).join(attached.select("name").distinct(), "name", "left_anti").select("name")


def valid_uuid(c: Column) -> Column:
    """Whether a text is a UUID, with or without dashes, braces or the urn prefix; null for null."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(c), "^urn:uuid:", ""), "[{}-]", "")
    return bare.rlike("^[0-9a-f]{32}$")


def first_match(keys: DataFrame, tables: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """(key, table, ...) of the first named table that has each key; tables have the same columns, keys unique in each."""
    each = [t.withColumn("table", F.lit(n)).withColumn("_order", F.lit(i)) for i, (n, t) in enumerate(tables.items())]
    columns = [c for c in next(iter(tables.values())).columns if c != key]
    found = reduce(DataFrame.unionByName, each).join(keys.select(key).distinct(), key, "left_semi")
    best = found.groupBy(key).agg(F.min(F.struct("_order", "table", *columns)).alias("b"))
    return best.select(key, "b.table", *[F.col("b")[c].alias(c) for c in columns])


#: What the tables of a deployment must satisfy, by name: a row that fails makes the write fail.
CHECKS = {
    "grid": "origin_x IS NOT NULL AND origin_y IS NOT NULL AND size > 0",
    "run": "max_tasks_per_shard > 0 AND section_count > 0",
    "window": "start_minute < end_minute AND step_minute > 0",
    "leaf": "lo < hi",
}


def checked(df: DataFrame, check: str) -> DataFrame:
    """df, of which a row that breaks the condition raises when it is read."""
    good = F.expr(check)
    guard = F.when(F.coalesce(good, F.lit(True)), F.lit(True)).otherwise(F.raise_error(F.lit(f"check failed: {check}")).cast("boolean"))
    return df.where(guard)


def broken(df: DataFrame, checks: dict[str, str]) -> DataFrame:
    """(check_name, violations): rows that break each condition; like constraints, null doesn't."""
    one = df.agg(*[F.count_if(~F.coalesce(F.expr(c), F.lit(True))).alias(n) for n, c in checks.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("violations")) for n in checks])))


def require_shard(tables: DataFrame, shard: int) -> None:
    """Raises unless all rows (shard_index) are of the shard."""
    other = tables.where(~F.col("shard_index").eqNullSafe(F.lit(shard))).limit(1).collect()
    require(not other, f"rows of shard {other[0]['shard_index'] if other else ''} instead of {shard}")


def require(condition_holds: bool, message: str) -> None:
    """A precondition on the driver."""
    if not condition_holds:
        raise ValueError(message)


def shard_summary(sections: DataFrame, facts: DataFrame, rollup: DataFrame, owned_edges: DataFrame) -> DataFrame:
    """One row: sections, leaves, rows of the rollup and broken checks of all."""
    leaves = facts.select("section_id", "sim_date", "window_index").distinct().agg(F.count("*").alias("leaves"))
    rows = rollup.agg(F.count("*").alias("edge_rows"))
    bad = violations(rollup, owned_edges).agg(F.sum("violations").alias("violations"))
    return sections.agg(F.count("*").alias("sections")).join(leaves).join(rows).join(bad)  # one row each


def summary(facts: DataFrame) -> DataFrame:
    return facts.agg(F.count("*").alias("rows"), F.min("datetime").alias("first"), F.max("datetime").alias("last"), F.count_distinct("edge_id").alias("edges"))
