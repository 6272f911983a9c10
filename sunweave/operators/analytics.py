"""City-wide analytics over facts and rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole, rounded half away from zero; null where whole is 0."""
    return F.round(F.lit(100).cast("decimal(20,0)") * part / F.nullif(whole, F.lit(0)), places).cast("double")


def network_snapshot(rollup: DataFrame, at: Column, sections: DataFrame) -> DataFrame:
    """Edges, samples, lit samples and their percentage at one instant, and how many shards own a section."""
    s = rollup.where(F.col("datetime") == at)
    one = s.agg(F.count_distinct("edge_id").alias("edges"), F.coalesce(F.sum("sample_count"), F.lit(0)).alias("samples"), F.coalesce(F.sum("sunlit_sum"), F.lit(0)).alias("sunlit")).withColumn("pct_sun", percent(F.col("sunlit"), F.col("samples"), 3))
    return one.join(sections.agg(F.count_distinct("shard_index").alias("shards_read")))  # one row each


def month_hour_profile(facts: DataFrame) -> DataFrame:
    """Month by hour, from the steps exactly on an hour of 3 to 21."""
    rows = facts.where((F.minute("datetime") == 0) & (F.second("datetime") == 0) & F.hour("datetime").between(3, 21))
    out = rows.groupBy(F.month("datetime").alias("month"), F.hour("datetime").alias("hour")).agg(F.count_if("is_sunlit").alias("sunlit_count"), F.count("*").alias("total_count"))
    return out.withColumn("percentage", percent(F.col("sunlit_count"), F.col("total_count")))


def monthly_totals(facts: DataFrame) -> DataFrame:
    return facts.groupBy(F.date_format("datetime", "yyyy-MM").alias("month")).agg(F.count("*").alias("rows"), F.count_if("is_sunlit").alias("sunlit"))


def month_ranks(profile: DataFrame) -> DataFrame:
    """Months by mean percentage, 0 the lowest; ties by month."""
    means = profile.groupBy("month").agg(F.round(F.avg("percentage"), 6).alias("mean_pct"))
    return means.withColumn("rank", F.row_number().over(Window.orderBy("mean_pct", "month")) - 1)


def timestep_counts(facts: DataFrame) -> DataFrame:
    return facts.groupBy("datetime").agg(F.count_if("is_sunlit").alias("sunlit"))


def sunrise_spikes(counts: DataFrame, look: int = 14, drop: int = 1000) -> DataFrame:
    """(date, datetime): positive steps before the dip, where the morning's first positive count falls by more than drop.

    counts: (datetime, sunlit). Steps up to noon count; the dip is the first least one among the first and look more.
    """
    day = F.to_date("datetime")
    m = counts.where(F.hour("datetime") * 3600 + F.minute("datetime") * 60 + F.second("datetime") <= 43200).withColumn("date", day)
    m = m.withColumn("i", F.row_number().over(Window.partitionBy("date").orderBy("datetime")))
    w = Window.partitionBy("date")
    m = m.withColumn("first", F.min(F.when(F.col("sunlit") > 0, F.col("i"))).over(w))
    near = F.col("i").between(F.col("first"), F.col("first") + look)
    m = m.withColumn("dip", F.min(F.when(near, F.struct("sunlit", "i"))).over(w)).withColumn("start", F.max(F.when(F.col("i") == F.col("first"), F.col("sunlit"))).over(w))
    return m.where((F.col("start") - F.col("dip.sunlit") > drop) & (F.col("i") >= F.col("first")) & (F.col("i") < F.col("dip.i")) & (F.col("sunlit") > 0)).select("date", "datetime")


def sunset_spikes(counts: DataFrame) -> DataFrame:
    """(date, datetime): steps from 14:00 on with more than the step before, and any."""
    late = counts.where(F.hour("datetime") >= 14).withColumn("date", F.to_date("datetime"))
    late = late.withColumn("before", F.lag("sunlit").over(Window.partitionBy("date").orderBy("datetime")))
    return late.where((F.col("sunlit") > F.col("before")) & (F.col("sunlit") > 0)).select("date", "datetime")


def corrected_facts(facts: DataFrame, spikes: DataFrame) -> DataFrame:
    """Facts with the spikes' steps dark; spikes are a few steps a day at most."""
    s = spikes.select("datetime").distinct().withColumn("spike", F.lit(True))
    out = facts.join(s, "datetime", "left").withColumn("is_sunlit", F.when(F.col("spike"), F.lit(False)).otherwise(F.col("is_sunlit")))
    return out.select(*facts.columns)


def corrected_rollup(rollup: DataFrame, spikes: DataFrame) -> DataFrame:
    s = spikes.select("datetime").distinct().withColumn("spike", F.lit(True))
    return rollup.join(s, "datetime", "left").withColumn("sunlit_sum", F.when(F.col("spike"), 0).otherwise(F.col("sunlit_sum"))).select(*rollup.columns)


def weighted_od_mean(od: DataFrame) -> DataFrame:
    """(day_type, hour, mean_min, mean_max): means by trips of rows with any and both values; 0 where there are none.

    od: (day_type, hour, trips, min_exposure, max_exposure).
    """
    good = (F.col("trips") != 0) & F.col("min_exposure").isNotNull() & F.col("max_exposure").isNotNull()
    w = F.when(good, F.col("trips"))
    mean = lambda c: F.round(F.coalesce(F.sum(w * F.col(c)) / F.nullif(F.sum(w), F.lit(0.0)), F.lit(0.0)), 4)
    return od.groupBy("day_type", "hour").agg(mean("min_exposure").alias("mean_min"), mean("max_exposure").alias("mean_max"))


def shadow_barcode(segments: DataFrame) -> DataFrame:
    """(segment, barcode): ten characters, as many ones as tenths of the samples are shaded (halves to even)."""
    out = segments.groupBy("segment").agg(F.count_if(~F.col("is_sunlit")).alias("shadow"), F.count("*").alias("total"), F.min("position").alias("position"))
    ones = F.rint(10.0 * F.col("shadow") / F.col("total")).cast("int")
    return out.select("segment", "position", F.rpad(F.repeat(F.lit("1"), ones), 10, "0").alias("barcode"))


def path_lengths(path_points: DataFrame) -> DataFrame:
    """(path_id, length_m): consecutive distances summed. path_points: (path_id, position, x, y)."""
    w = Window.partitionBy("path_id").orderBy("position")
    dx, dy = F.lead("x").over(w) - F.col("x"), F.lead("y").over(w) - F.col("y")
    return path_points.withColumn("leg", F.sqrt(dx * dx + dy * dy)).groupBy("path_id").agg(F.round(F.coalesce(F.sum("leg"), F.lit(0.0)), 6).alias("length_m"))


def path_fractions(path_points: DataFrame, fractions: list[float]) -> DataFrame:
    """(path_id, t, x, y): the places at fractions of each path's length."""
    w = Window.partitionBy("path_id").orderBy("position")
    rows = path_points.withColumn("nx", F.lead("x").over(w)).withColumn("ny", F.lead("y").over(w))
    rows = rows.withColumn("leg", F.coalesce(F.sqrt((F.col("nx") - F.col("x")) ** 2 + (F.col("ny") - F.col("y")) ** 2), F.lit(0.0)))
    rows = rows.withColumn("upto", F.sum("leg").over(w)).withColumn("from", F.coalesce(F.lag("upto").over(w), F.lit(0.0)))
    rows = rows.withColumn("total", F.max("upto").over(Window.partitionBy("path_id")))
    rows = rows.withColumn("t", F.explode(F.array(*map(F.lit, fractions)))).withColumn("at", F.col("t") * F.col("total"))
    rows = rows.where("nx IS NOT NULL AND at >= `from` AND at <= upto")
    part = F.when(F.col("leg") > 0, (F.col("at") - F.col("from")) / F.col("leg")).otherwise(0.0)
    place = F.min(F.struct("position", (F.col("x") + (F.col("nx") - F.col("x")) * part).alias("px"), (F.col("y") + (F.col("ny") - F.col("y")) * part).alias("py")))
    return rows.groupBy("path_id", "t").agg(place.alias("p")).select("path_id", "t", F.round("p.px", 6).alias("x"), F.round("p.py", 6).alias("y"))


def points_along(path_points: DataFrame, spacing: float) -> DataFrame:
    """(path_id, sequence_index, x, y): max(1, length / spacing rounded half to even) places, the ends included.

    A leg lists the places that may lie on it and keeps those from its start up to, but not at, its end; the last point of
    a path has the last place, and the only one of a path without length.
    """
    w = Window.partitionBy("path_id").orderBy("position")
    rows = path_points.withColumn("nx", F.lead("x").over(w)).withColumn("ny", F.lead("y").over(w))
    rows = rows.withColumn("leg", F.coalesce(F.sqrt((F.col("nx") - F.col("x")) ** 2 + (F.col("ny") - F.col("y")) ** 2), F.lit(0.0)))
    rows = rows.withColumn("end", F.sum("leg").over(w)).withColumn("start", F.coalesce(F.lag("end").over(w), F.lit(0.0)))
    rows = rows.withColumn("total", F.max("end").over(Window.partitionBy("path_id")))
    rows = rows.withColumn("n", F.greatest(F.lit(1), F.rint(F.col("total") / max(0.01, spacing)).cast("int")))
    n, total = F.col("n"), F.col("total")
    about = lambda c, round_: round_(F.col(c) / total * (n - 1)).cast("int")
    near = F.sequence(F.greatest(F.lit(0), about("start", F.floor) - 1), F.least(n - 1, about("end", F.ceil) + 1))
    last = F.col("nx").isNull()
    whole = F.when(last, F.when((n > 1) | (total == 0), F.array(n - 1))).when(F.col("leg") > 0, near)
    rows = rows.withColumn("sequence_index", F.explode(whole))
    i = F.col("sequence_index")
    at = F.when(n > 1, i / (n - 1)).otherwise(0.0) * total
    rows = rows.where(last | (at >= F.col("start")) & (at < F.col("end")) & ((i < n - 1) | (n == 1)))
    part = F.when(last, 0.0).otherwise((at - F.col("start")) / F.col("leg"))
    place = lambda k: F.round(F.col(k) + F.coalesce((F.col("n" + k) - F.col(k)) * part, F.lit(0.0)), 6).alias(k)
    return rows.select("path_id", "sequence_index", place("x"), place("y"))


def block_extents(blocks: DataFrame) -> DataFrame:
    """(block, n, min_x, min_y, max_x, max_y, cx, cy) of points with their block: size, box and centre of each."""
    box = [f(c).alias(f"{n}_{c}") for n, f in (("min", F.min), ("max", F.max)) for c in ("x", "y")]
    return blocks.groupBy("block").agg(F.count("*").alias("n"), *box, F.round(F.avg("x"), 6).alias("cx"), F.round(F.avg("y"), 6).alias("cy"))


def month_hour_document(profile: DataFrame) -> DataFrame:
    """The profile as one nested JSON text: months, in each the hours with their counts and percentage (24 by 12 at most)."""
    entry = F.struct("sunlit_count", "total_count", "percentage")
    months = profile.groupBy("month").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("hour").cast("string"), entry)))).alias("hours"))
    lines = months.select(F.concat(F.lit('"'), F.col("month").cast("string"), F.lit('":'), F.to_json("hours")).alias("line"))
    return lines.agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list("line")), ","), F.lit("}")).alias("document"))
