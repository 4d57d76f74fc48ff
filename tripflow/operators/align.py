"""Bringing differently shaped trip tables to one shape."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripflow.sources.schemas import CANONICAL, CITY, layout_for

# Columns of the warehouse tables.
FHV_COLUMNS = ["location_id", "pickup_datetime", "borough", "zone", "service_zone"]
METERED_COLUMNS = [
    "vendor_id",
    "pickup_datetime",
    "pickup_longitude",
    "pickup_latitude",
    "trip_distance",
    "passenger_count",
    "fare_amount",
    "pickup_location_id",
]


def trim_headers(df: DataFrame) -> DataFrame:
    """Column names without leading and trailing blanks."""
    return df.toDF(*[c.strip() for c in df.columns])


def fold_headers(df: DataFrame) -> DataFrame:
    """Column names trimmed and in lower case; two that become equal are an error."""
    names = [c.strip().lower() for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"column names clash after folding: {df.columns}")
    return df.toDF(*names)


def tag(df: DataFrame, **constants: object) -> DataFrame:
    """Adds constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def _pick(df: DataFrame, name: str | None) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def align_year(df: DataFrame, taxi_type: str, year: int) -> DataFrame:
    """A raw table of one type and year in the canonical columns, still as text.

    Fields the year does not carry become NULL; a field it should carry but does not
    is an error.
    """
    folded = fold_headers(df)
    sources = layout_for(taxi_type, year).sources()
    absent = {s for s in sources.values() if s} - set(folded.columns)
    if absent:
        raise ValueError(f"{taxi_type} {year} lacks {sorted(absent)}")
    fields = [_pick(folded, source).alias(name) for name, source in sources.items()]
    constants = [F.lit(CITY).alias("City"), F.lit(taxi_type).alias("taxi_type")]
    return to_canonical(folded.select(*fields, *constants))


def to_canonical(df: DataFrame) -> DataFrame:
    return df.select(*CANONICAL)


def project_fhv(df: DataFrame) -> DataFrame:
    """Warehouse columns of hired vehicles, keys and times as text."""
    return df.select(
        *[F.col(c).cast("string") if c in FHV_COLUMNS[:2] else F.col(c) for c in FHV_COLUMNS]
    )


def project_metered(df: DataFrame, numeric: bool = False) -> DataFrame:
    """Warehouse columns of green and yellow trips as text; NULL where a year has none.

    ``numeric`` keeps the time as it is and brings the measures to doubles, on which a scan
    can use a filter: a double column is passed through without a cast.
    """
    if not numeric:
        return df.select(*[_pick(df, c).cast("string").alias(c) for c in METERED_COLUMNS])
    measures = {"pickup_longitude", "pickup_latitude", "trip_distance", "passenger_count", "fare_amount"}
    columns = []
    for c in METERED_COLUMNS:
        column = _pick(df, c)
        if c in measures:
            column = column if dict(df.dtypes).get(c) == "double" else column.try_cast("double")
        elif c != "pickup_datetime":
            column = column.cast("string")
        columns.append(column.alias(c))
    return df.select(*columns)


def union_all(
    frames: Sequence[DataFrame],
    fold_case: bool = True,
    cast_to: str | None = None,
    spark: SparkSession | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """``UNION ALL`` by name of tables that share some columns or none.

    Columns come in first-seen order and are NULL where a table lacks them. Columns of
    one name but different types are an error unless ``cast_to`` brings every column to
    one type first. An empty list gives an empty table of ``schema``.
    """
    if not frames:
        if spark is None or schema is None:
            raise ValueError("an empty union needs spark and schema")
        return spark.createDataFrame([], schema)
    if fold_case:
        frames = [fold_headers(df) for df in frames]
    if cast_to:
        frames = [df.select(*[F.col(f"`{c}`").cast(cast_to).alias(c) for c in df.columns]) for df in frames]
    seen: dict[str, object] = {}
    for df in frames:
        for field in df.schema.fields:
            if seen.setdefault(field.name, field.dataType) != field.dataType:
                raise TypeError(f"column {field.name} is {seen[field.name]} and {field.dataType}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
