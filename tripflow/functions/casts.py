"""Casts that turn unusable text into NULL instead of failing under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WALL_CLOCK = "yyyy-MM-dd HH:mm:ss"


def to_double(col: Column) -> Column:
    return col.try_cast("double")


def to_int(col: Column) -> Column:
    """Whole part of a number written as text: ``"1.0"`` is 1, ``""`` and ``"abc"`` are NULL."""
    return col.try_cast("double").try_cast("int")


def parse_ts(col: Column, fmt: str = WALL_CLOCK) -> Column:
    """A time of the given form, or else a date and a time with a fraction or without seconds."""
    dated = F.when(col.rlike(r"^\d{4}-\d\d-\d\d[ T]\d"), col).try_cast("timestamp")
    return F.coalesce(F.try_to_timestamp(col, F.lit(fmt)), dated)
