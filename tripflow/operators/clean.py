"""Row filters and the typed fact projection.

Predicates on text keep the string comparisons under which the published figures were
made; ``numeric=True`` gives the comparison that was meant. A NULL never passes a
predicate, negated ones included.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.casts import parse_ts, to_double, to_int
from tripflow.sources.schemas import METERED, TOTAL


def year_guard(df: DataFrame, year: int, col: str = "Pickup_date", mode: str = "contains") -> DataFrame:
    """Rows of one year.

    ``contains`` and ``prefix`` test the text; ``range`` is a half-open range on a
    timestamp column, which reaches the parquet scan as a pushed filter.
    """
    c = F.col(col)
    if mode == "contains":
        return df.where(c.contains(str(year)))
    if mode == "prefix":
        return df.where(c.startswith(str(year)))
    if mode == "range":
        return df.where((c >= _moment(df, col, date(year, 1, 1))) & (c < _moment(df, col, date(year + 1, 1, 1))))
    raise ValueError(f"unknown mode {mode}")


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a value in every column; each test can be pushed to the scan."""
    for c in cols:
        df = df.where(F.col(c).isNotNull())
    return df


def drop_unknown_zone(
    df: DataFrame,
    zone: str = "zone",
    service_zone: str | None = "service_zone",
    zone_marks: Sequence[str] = ("NV", "NA"),
    service_marks: Sequence[str] = ("N/A",),
) -> DataFrame:
    """Drops zones that are NULL or carry one of the marks for "unknown"."""
    for mark in zone_marks:
        df = df.where(~F.col(zone).contains(mark))
    if service_zone:
        for mark in service_marks:
            df = df.where(~F.col(service_zone).contains(mark))
    return df


def drop_unreasonable(df: DataFrame, numeric: bool = False) -> DataFrame:
    """Drops trips without passengers, with a negative fare or at coordinate zero."""
    passengers, fare, lon, lat = (
        F.col(c) for c in ("Passenger_count", "Fare_amount", "Pickup_longitude", "Pickup_latitude")
    )
    if numeric:
        return df.where(
            (to_double(passengers) != 0) & (to_double(fare) >= 0)
            & (to_double(lon) != 0) & (to_double(lat) != 0)
        )
    return df.where((passengers != "0") & ~fare.startswith("-") & (lon != "0") & (lat != "0"))


def valid_metered(
    df: DataFrame,
    coords: bool = True,
    numeric: bool = False,
    not_null: Sequence[str] = ("vendor_id", "pickup_datetime", "passenger_count"),
) -> DataFrame:
    """Green and yellow trips with usable fare, distance and position.

    ``coords=False`` is for the years whose source carries zone ids in place of
    coordinates: requiring these would drop every row.
    """
    position = ["pickup_latitude", "pickup_longitude"] if coords else []
    df = require(df, list(not_null))
    if numeric:
        for c in ["fare_amount", "trip_distance"]:
            df = df.where(to_double(F.col(c)) > 0)
        for c in position:
            df = df.where(to_double(F.col(c)) != 0)
        return df
    df = df.where(~F.col("fare_amount").startswith("-"))
    for c in ["fare_amount", "trip_distance", *position]:
        df = df.where(F.col(c) != "0.0")
    return df


def located(df: DataFrame, numeric: bool = False) -> DataFrame:
    """Trips with a time and a position; on text a longitude starting with 0 is none."""
    df = require(df, ["pickup_datetime", "pickup_longitude", "pickup_latitude"])
    lon = F.col("pickup_longitude")
    return df.where(to_double(lon) != 0 if numeric else ~lon.startswith("0"))


def priceable(
    df: DataFrame, fare: str = "fare_amount", distance: str = "trip_distance", numeric: bool = False
) -> DataFrame:
    """Trips whose fare and distance are positive; on text 0.5 counts as zero too."""
    for c in (F.col(fare), F.col(distance)):
        df = df.where(to_double(c) > 0 if numeric else ~c.startswith("0") & ~c.startswith("-"))
    return df


def in_period(df: DataFrame, lo: datetime | date, hi: datetime | date, col: str = "Pickup_datetime") -> DataFrame:
    """Rows between two moments, both included, as typed literals a scan can use."""
    return df.where(F.col(col).between(_moment(df, col, lo), _moment(df, col, hi)))


def one_day(df: DataFrame, day: date, col: str = "pickup_datetime") -> DataFrame:
    """Rows of one day of a timestamp column, or of text in ``yyyy-MM-dd ...`` form."""
    c = F.col(col)
    if dict(df.dtypes)[col] == "string":
        return df.where(c.startswith(day.isoformat()))
    return df.where((c >= _moment(df, col, day)) & (c < _moment(df, col, day + timedelta(days=1))))


def metered_only(df: DataFrame, types: Sequence[str] = METERED, col: str = "taxi_type") -> DataFrame:
    return df.where(F.col(col).isin(*types))


def valid_geo(df: DataFrame) -> DataFrame:
    """Typed trips in the north-western quarter with passengers and a fare."""
    return df.where(
        (F.col("Pickup_longitude") < 0) & (F.col("Pickup_latitude") > 0)
        & (F.col("Passenger_count") > 0) & (F.col("Fare_amount") > 0)
    )


def regression_input(
    df: DataFrame,
    lo: datetime | date,
    hi: datetime | date,
    types: Sequence[str] = METERED,
    above: float = 1.0,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Type, fare and distance (and ``keep``) of metered trips of a period above a bound."""
    df = in_period(metered_only(df, types), lo, hi)
    df = df.where((F.col("Trip_distance") > above) & (F.col("Fare_amount") > above))
    return df.select("taxi_type", "Fare_amount", "Trip_distance", *keep)


def type_fact(df: DataFrame) -> DataFrame:
    """Canonical text plus ``borough`` as the typed fact table; bad text becomes NULL."""
    casts = {"integer": to_int, "double": to_double}
    df = df.withColumns({"Pickup_datetime": parse_ts(F.col("Pickup_date")), "Count": F.lit("1")})
    columns = []
    for field in TOTAL.fields:
        cast = casts.get(field.dataType.typeName())
        columns.append(cast(F.col(field.name)).alias(field.name) if cast else F.col(field.name))
    return df.select(*columns)


def _moment(df: DataFrame, col: str, value: datetime | date) -> Column:
    """A literal of the column's own timestamp type, so that no cast sits on the column."""
    return F.lit(str(value)).cast(df.schema[col].dataType)
