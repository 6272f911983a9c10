"""Daylight, live steps and the sun's position, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LATITUDE = 40.7826
GUARD_MINUTES = 20
NOON_MINUTE = 716
HORIZON_DEGREES = 5.0


def daylight_hours(day_of_year: Column, latitude: float = LATITUDE) -> Column:
    """Hours of daylight by the declination of the day (Cooper)."""
    declination = F.radians(F.lit(23.45) * F.sin(F.radians(F.lit(360.0) * (day_of_year + 284) / 365)))
    cosine = -F.lit(math.tan(math.radians(latitude))) * F.tan(declination)
    return 2 * F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))) / 15


def live_steps(day_of_year: Column, lo: Column, hi: Column, latitude: float = LATITUDE) -> Column:
    """Three-minute steps of [lo, hi) in which the sun stands above the guard."""
    half = daylight_hours(day_of_year, latitude) * 60 / 2
    overlap = F.least(hi.cast("double"), NOON_MINUTE + half - GUARD_MINUTES) - F.greatest(lo.cast("double"), NOON_MINUTE - half + GUARD_MINUTES)
    return F.floor(F.greatest(F.lit(0.0), overlap) / 3).cast("int")


def below_guard(elevation: Column, guard: float = HORIZON_DEGREES) -> Column:
    """Steps at which everything counts as shaded without a look at any caster."""
    e = F.pmod(elevation, F.lit(360.0))
    return (e <= guard) | (e >= 180 - guard)


def sun_position(day_of_year: Column, minute: Column, latitude: float, longitude: float, utc_offset_hours: float) -> Column:
    """struct(azimuth, elevation) in degrees: Fourier series of declination and equation of time, to some 0.3 degrees."""
    g = F.lit(2 * math.pi / 365) * (day_of_year - 1 + (minute / 60 - 12) / 24)
    equation = F.lit(229.18) * (F.lit(0.000075) + 0.001868 * F.cos(g) - 0.032077 * F.sin(g) - 0.014615 * F.cos(2 * g) - 0.040849 * F.sin(2 * g))
    d = F.lit(0.006918) - 0.399912 * F.cos(g) + 0.070257 * F.sin(g) - 0.006758 * F.cos(2 * g) + 0.000907 * F.sin(2 * g) - 0.002697 * F.cos(3 * g) + 0.00148 * F.sin(3 * g)
    hour_angle = F.radians((minute + equation + 4 * longitude - 60 * utc_offset_hours) / 4 - 180)
    phi = math.radians(latitude)
    sine = F.lit(math.sin(phi)) * F.sin(d) + F.lit(math.cos(phi)) * F.cos(d) * F.cos(hour_angle)
    azimuth = F.degrees(F.atan2(F.sin(hour_angle), F.cos(hour_angle) * math.sin(phi) - F.tan(d) * math.cos(phi))) + 180
    return F.struct(F.pmod(azimuth, F.lit(360.0)).alias("azimuth"), F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sine)))).alias("elevation"))


def shortest_arc(a: Column, b: Column, t: Column) -> Column:
    """Between two directions in degrees, the short way round."""
    return F.pmod(a + (F.pmod(b - a + 540, F.lit(360.0)) - 180) * t, F.lit(360.0))


def ephemeris_at(times: DataFrame, ephemeris: DataFrame, interpolate: bool = True) -> DataFrame:
    """times (with a column datetime) with azimuth and elevation from an ephemeris of one year, (doy, minute, azimuth, elevation).

    Looked up at (day of year, minute); between minutes the azimuth goes the short way round and the elevation straight,
    the minute after the last of the year being its first. Minutes beyond the ephemeris take its last one. Without any
    ephemeris the sun is at (0, -90).
    """
    index = (F.col("doy") - 1) * 1440 + F.col("minute")
    rows = ephemeris.select(index.alias("i"), "azimuth", "elevation")
    n = (rows.agg(F.max("i").alias("n")).first()["n"] or 0) + 1
    at = F.least((F.dayofyear("datetime") - 1) * 1440 + F.hour("datetime") * 60 + F.minute("datetime"), F.lit(n - 1))
    now = rows.select(F.col("i").alias("i0"), F.col("azimuth").alias("a0"), F.col("elevation").alias("e0"))
    then = rows.select(F.col("i").alias("i1"), F.col("azimuth").alias("a1"), F.col("elevation").alias("e1"))
    part = F.extract(F.lit("SECOND"), F.col("datetime")).cast("double") / 60 if interpolate else F.lit(0.0)
    t = times.withColumns({"_at": at, "_next": F.pmod(at + 1, F.lit(n)), "_part": part})
    j = t.join(now, F.col("_at") == F.col("i0"), "left").join(then, F.col("_next") == F.col("i1"), "left")
    azimuth = F.coalesce(shortest_arc(F.col("a0"), F.col("a1"), F.col("_part")), F.lit(0.0))
    elevation = F.coalesce(F.col("e0") + (F.col("e1") - F.col("e0")) * F.col("_part"), F.lit(-90.0))
    return j.select(*times.columns, azimuth.alias("azimuth"), elevation.alias("elevation"))


# --- hours of a day as numbers ------------------------------------------------------------------------------------------


def wrapped_hour(hour: Column) -> Column:
    return F.pmod(hour, F.lit(24.0))


def day_progress(hour: Column) -> Column:
    """0 at midnight, 0.5 at noon."""
    return wrapped_hour(hour) / 24


def rough_elevation(hour: Column) -> Column:
    """Fifteen degrees an hour from six o'clock on, for sketches only."""
    return (hour - 6) * 15


def is_daytime(hour: Column) -> Column:
    return (wrapped_hour(hour) >= 5) & (wrapped_hour(hour) < 19)


def clock(hour: Column) -> Column:
    """HH:MM of an hour with fractions."""
    h = wrapped_hour(hour)
    return F.format_string("%02d:%02d", F.floor(h).cast("int"), F.floor((h - F.floor(h)) * 60).cast("int"))


def blended_angle(elevation: Column, blend: float = 5.0, parked: float = -90.0) -> Column:
    """The light's angle: parked from blend degrees up, the elevation from blend degrees below on, blended between."""
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (blend - elevation) / (2 * blend)))
    return parked + (elevation - parked) * t


def sun_vector(azimuth: Column, elevation: Column) -> Column:
    """struct(x, y, z) of the way to the sun, x east, y north, z up, of length one."""
    a, e = F.radians(azimuth), F.radians(elevation)
    return F.struct((F.sin(a) * F.cos(e)).alias("x"), (F.cos(a) * F.cos(e)).alias("y"), F.sin(e).alias("z"))
