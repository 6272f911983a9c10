"""The day's grid of three-minute steps and its windows, as column expressions.

A day has the minutes [180, 1260) in steps of 3: 360 steps, in 6 half-open windows of 180 minutes (60 steps each).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

START, END, STEP, WINDOWS = 180, 1260, 3, 6
SPAN = (END - START) // WINDOWS
LAST_STEP = (END - START) // STEP - 1


def _plus_minutes(day: Column, minutes: Column) -> Column:
    return day + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"), F.lit(0))


def day_start(ts: Column) -> Column:
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def minute_of_day(ts: Column) -> Column:
    """Minutes since midnight, with fractions."""
    return F.hour(ts) * 60 + F.minute(ts) + F.extract(F.lit("SECOND"), ts).cast("double") / 60


def snap_timestep(ts: Column) -> Column:
    """The nearest step's timestamp; halves go to the even step, and steps are clamped to those of the day."""
    step = F.rint((minute_of_day(ts) - START) / STEP)
    return _plus_minutes(day_start(ts), START + STEP * F.greatest(F.lit(0.0), F.least(F.lit(float(LAST_STEP)), step)))


def floor_timestep(ts: Column) -> Column:
    """The step begun at or before ts, not clamped (overlays use this one)."""
    return _plus_minutes(day_start(ts), F.floor(minute_of_day(ts) / STEP) * STEP)


def window_index(ts: Column) -> Column:
    """The window of ts, null outside the day's grid."""
    m = minute_of_day(ts)
    return F.when((m >= START) & (m < END), F.floor((m - START) / SPAN).cast("int"))


def window_bounds(day: Column, window: Column, start: int = START, end: int = END, windows: int = WINDOWS) -> Column:
    """struct(lo, hi, first_minute, last_minute) of a window of a date; raises if the windows don't tile the day."""
    if windows <= 0 or (end - start) % windows:
        raise ValueError(f"{windows} windows don't divide {end - start} minutes")
    span = (end - start) // windows
    good = F.when((window < 0) | (window >= windows), F.raise_error(F.lit("window index out of range")).cast("int")).otherwise(window)
    first = start + good * span
    midnight = day.cast("timestamp_ntz")
    return F.struct(_plus_minutes(midnight, first).alias("lo"), _plus_minutes(midnight, first + span).alias("hi"), first.cast("int").alias("first_minute"), (first + span - 1).cast("int").alias("last_minute"))


def leaf_name(section: Column, day: Column, window: Column) -> Column:
    """The name of a (section, date, window) leaf of the fact table."""
    return F.format_string("exposure_s%s_%s_w%s", section.cast("string"), F.date_format(day, "yyyyMMdd"), window.cast("string"))


def section_parent_name(section: Column) -> Column:
    """The name of all leaves of a section together."""
    return F.format_string("exposure_s%s", section.cast("string"))


def nearest_date(day: Column, dates: list) -> Column:
    """The listed date with the fewest days to the given one, the first on ties; without a list day 1 or 15 of its month."""
    if not dates:
        return F.make_date(F.year(day), F.month(day), F.when(F.dayofmonth(day) < 8, 1).otherwise(15))
    ranked = F.array(*[F.struct(F.abs(F.datediff(day, F.lit(d))).alias("gap"), F.lit(i).alias("at"), F.lit(d).alias("d")) for i, d in enumerate(dates)])
    return F.array_min(ranked)["d"]
