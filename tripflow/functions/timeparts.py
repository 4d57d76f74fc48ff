"""Calendar and clock parts of a pickup time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.casts import parse_ts


def day_of(ts: Column) -> Column:
    """Midnight of the day."""
    return F.date_trunc("day", ts)


def day_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def month_key(ts: Column) -> Column:
    """``yyyy-MM`` of a timestamp, or of text that starts with a date."""
    return F.substring(ts.cast("string"), 1, 7)


def month_label(key: Column) -> Column:
    """``yyyy-MM-00``: a sortable label, not a date."""
    return F.concat(key, F.lit("-00"))


def weekday_name(ts: Column, legacy: bool = False) -> Column:
    """Full English weekday name.

    ``legacy`` gives the name that results when the month is read as minutes, i.e. the
    weekday of that day of **January** in the same year.
    """
    day = F.make_date(F.year(ts), F.lit(1), F.dayofmonth(ts)) if legacy else ts
    return F.date_format(day, "EEEE")


def calendar_parts(df: DataFrame, day: str = "Pickup_DateDay", legacy_dow: bool = False) -> DataFrame:
    """Adds ``Month``, ``Day`` and ``DOW`` of a day column."""
    ts = F.col(day)
    return df.withColumns(
        {"Month": F.month(ts), "Day": F.dayofmonth(ts), "DOW": weekday_name(ts, legacy_dow)}
    )


def bucket_ts(ts: Column, minutes: int = 10) -> Column:
    """Start of the clock-aligned bucket a timestamp falls into; keeps the timestamp type."""
    if not 0 < minutes <= 60 or 60 % minutes:
        raise ValueError("minutes must divide an hour")
    into_bucket = F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(ts) % minutes, F.extract(F.lit("SECOND"), ts)
    )
    return ts - into_bucket


def grouped_time(df: DataFrame, ts: str, unit: str) -> Column:
    """What to group by for a ``month`` or ``ten_minutes`` key: text by its prefix, a time by its start.

    Formatting the few groups afterwards gives the same keys as formatting every row.
    """
    c = F.col(ts)
    if dict(df.dtypes)[ts] == "string":
        return month_key(c) if unit == "month" else bucket_key15(c)
    return F.date_trunc("month", c) if unit == "month" else bucket_ts(c)


def bucket_key15(ts: Column) -> Column:
    """Ten-minute bucket as its first 15 characters: ``2015-12-05 14:3`` for 14:39:59."""
    return F.substring(ts.cast("string"), 1, 15)


def heat_parts(df: DataFrame, col: str = "pickup_datetime", legacy_dow: bool = False) -> DataFrame:
    """Adds year, month, day, dow, hour, ten and ten_mins, all as text."""
    text = F.col(col).cast("string")
    moment = F.col(col)
    if dict(df.dtypes)[col] == "string":
        moment = parse_ts(F.substring(text, 1, 19))
    ten = F.substring(text, 15, 1)
    return df.withColumns(
        {
            "year": F.substring(text, 1, 4),
            "month": F.substring(text, 6, 2),
            "day": F.substring(text, 9, 2),
            "dow": weekday_name(moment, legacy_dow),
            "hour": F.substring(text, 12, 2),
            "ten": ten,
            "ten_mins": F.concat(ten, F.lit("0")),
        }
    )


def month_parts(df: DataFrame, key: str = "year_month_day") -> DataFrame:
    """Adds ``year`` (text) and ``month`` (int) of a ``yyyy-MM`` key."""
    text = F.col(key)
    return df.withColumns(
        {"year": F.substring(text, 1, 4), "month": F.substring(text, 6, 2).try_cast("int")}
    )


def shift_year(df: DataFrame, frm: str, to: str, col: str = "pickup_datetime") -> DataFrame:
    """Relabels the leading year of a text time, to lay one year over another."""
    return df.withColumn(col, F.regexp_replace(F.col(col), f"^{frm}", to))
