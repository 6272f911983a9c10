"""Identifiers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uuid_of(*parts: Column) -> Column:
    """The md5 of the parts, joined by a dash, in the form of a UUID: the same for the same parts, wherever it is made."""
    h = F.md5(F.concat_ws("-", *[p.cast("string") for p in parts]).cast("binary"))
    return F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
