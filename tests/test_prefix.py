"""Ranks and running sums against Python."""

import random

from pyspark.sql import functions as F

from sunweave.operators.prefix import running


def test_running(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, "a", "b", "é", f"s{i % 50}"]), rng.randrange(9)) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, s string, n long").repartition(5)
    got = running(df, [F.col("s").asc_nulls_last(), F.col("id").desc()], "rank", {"before": "n"})
    assert got.columns == ["id", "s", "n", "rank", "before"]
    total = 0
    for k, (i, s, n) in enumerate(sorted(rows, key=lambda r: (r[1] is None, r[1] or "", -r[0]))):
        rows[i] = (i, s, n, k, total)
        total += n
    assert sorted(tuple(r) for r in got.collect()) == sorted(rows, key=lambda r: r[0])
    assert running(df.limit(0), [F.col("id")], "rank").collect() == []


def test_running_makes_no_single_partition_window(spark):
    plan = running(spark.range(100), [F.col("id")], "rank")._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(_range" in plan.replace("`", "")
