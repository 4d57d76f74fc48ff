"""Trip counts and average prices.

Every aggregate here is algebraic, so tasks combine their own rows before the shuffle
and a hot group reaches its reducer as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.casts import to_double
from tripflow.functions.timeparts import bucket_key15, calendar_parts, grouped_time, month_key, month_label, month_parts
from tripflow.sources.schemas import BOROUGHS, DAILY, MONTHLY, PRICES


def daily_business(
    df: DataFrame, ts: str = "Pickup_datetime", legacy_dow: bool = False, count_type: str = "int"
) -> DataFrame:
    """Trips per day, borough and taxi type, with calendar parts of the day.

    The published table has an ``int`` count. A group beyond its range fails under ANSI
    mode rather than wrapping round; ``count_type="bigint"`` has room for it.
    """
    counts = (
        df.groupBy(F.to_date(ts).alias("day"), "borough", "taxi_type")
        .agg(F.count("*").alias("n"))
        .withColumn("Pickup_DateDay", F.col("day").cast("timestamp"))
        .withColumn("Count", F.col("n").cast(count_type))
    )
    return calendar_parts(counts, legacy_dow=legacy_dow).select(*DAILY.fieldNames())


def monthly_business(
    df: DataFrame, ts: str = "pickup_datetime", zone: str = "zone_name", taxi_type: str = "taxi_type"
) -> DataFrame:
    """Trips per month, zone and taxi type in one aggregation over all types."""
    counts = (
        df.groupBy(
            grouped_time(df, ts, "month").alias("month_start"),
            F.col(zone).alias("zone_name"),
            F.col(taxi_type).alias("taxi_type"),
        )
        .agg(F.count("*").alias("count"))
        .withColumn("year_month_day", month_key(F.col("month_start")))
        .withColumn("year_month_day_new", month_label(F.col("year_month_day")))
    )
    return month_parts(counts).select(*MONTHLY.fieldNames())


def bucket_prices(
    df: DataFrame,
    ts: str = "pickup_datetime",
    fare: str = "fare_amount",
    distance: str = "trip_distance",
    boroughs: Sequence[str] = BOROUGHS,
) -> DataFrame:
    """Mean fare and distance per ten minutes, borough and taxi type.

    One scan and one aggregation serve all boroughs and types.
    """
    return (
        df.where(F.col("borough").isin(*boroughs))
        .groupBy(grouped_time(df, ts, "ten_minutes").alias("bucket"), "borough", "taxi_type")
        .agg(
            F.avg(to_double(F.col(fare))).alias("fare_amount_avg"),
            F.avg(to_double(F.col(distance))).alias("trip_distance_avg"),
        )
        .withColumn("pickup_datetime", bucket_key15(F.col("bucket")))
        .select(*PRICES.fieldNames())
    )
