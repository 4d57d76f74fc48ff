from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.plans import plan
from tripflow.operators.aggregate import bucket_prices, daily_business, monthly_business
from tripflow.sources.schemas import BOROUGHS, DAILY, MONTHLY, PRICES


def same_types(df, schema):
    return [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


@pytest.fixture(scope="module")
def fact(spark):
    rows = [
        ("2016-03-31 09:07:00", "Bronx", "Astoria", "green", 10.0, 2.0),
        ("2016-03-31 09:01:00", "Bronx", "Astoria", "green", 20.0, 4.0),
        ("2016-03-31 23:59:59", "Bronx", "Hills", "green", 30.0, 6.0),
        ("2016-03-31 10:00:00", None, "Hills", "yellow", 5.0, 1.0),
        ("2016-04-01 00:00:00", None, "Hills", "yellow", 5.0, 1.0),
        (None, None, "Hills", "yellow", 5.0, 1.0),
    ]
    df = spark.createDataFrame(rows, "t string, borough string, zone_name string, taxi_type string, fare_amount double, trip_distance double")
    return df.withColumns({"Pickup_datetime": F.col("t").cast("timestamp"), "pickup_text": F.col("t")})


def test_daily(fact, rows):
    df = daily_business(fact)
    assert same_types(df, DAILY)
    day, next_day = datetime(2016, 3, 31), datetime(2016, 4, 1)
    assert rows(df) == sorted(
        [
            (day, "Bronx", "green", 3, 3, 31, "Thursday"),
            (day, None, "yellow", 1, 3, 31, "Thursday"),
            (next_day, None, "yellow", 1, 4, 1, "Friday"),
            (None, None, "yellow", 1, None, None, None),
        ],
        key=str,
    )
    assert daily_business(fact).agg(F.sum("Count")).first()[0] == fact.count()
    assert daily_business(fact, count_type="bigint").schema["Count"].dataType.typeName() == "long"


def test_monthly(fact, rows):
    df = monthly_business(fact.dropna(subset=["t"]), ts="pickup_text")
    assert same_types(df, MONTHLY)
    assert rows(df) == sorted(
        [
            ("2016-03", "Astoria", 2, "green", "2016", 3, "2016-03-00"),
            ("2016-03", "Hills", 1, "green", "2016", 3, "2016-03-00"),
            ("2016-03", "Hills", 1, "yellow", "2016", 3, "2016-03-00"),
            ("2016-04", "Hills", 1, "yellow", "2016", 4, "2016-04-00"),
        ],
        key=str,
    )


def test_bucket_prices_equal_one_run_per_borough(fact, rows):
    known = fact.withColumn("borough", F.coalesce("borough", F.lit("Queens")))
    df = bucket_prices(known, "Pickup_datetime")
    assert same_types(df, PRICES)
    single = [
        bucket_prices(known.where((F.col("borough") == b) & (F.col("taxi_type") == t)), "Pickup_datetime")
        for b in BOROUGHS
        for t in ("green", "yellow")
    ]
    union = single[0]
    for part in single[1:]:
        union = union.unionByName(part)
    assert rows(df) == rows(union)
    assert ("2016-03-31 09:0", "Bronx", "green", 15.0, 3.0) in rows(df)


def test_prices_take_one_scan_and_one_shuffle(spark, data):
    events = spark.read.parquet(f"{data}/events.parquet").selectExpr(
        "ts AS pickup_datetime", "'Bronx' AS borough", "event_type AS taxi_type", "value AS fare_amount", "value AS trip_distance"
    )
    text = plan(bucket_prices(events))
    tree = text.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and tree.count("Exchange") == 1 and tree.count("HashAggregate") == 2
    assert "props" not in text and "user_id" not in text


def test_counts_combine_before_the_shuffle(spark, data):
    """A hot day reaches its reducer as one row per task."""
    events = spark.read.parquet(f"{data}/events.parquet").selectExpr(
        "ts AS Pickup_datetime", "'Bronx' AS borough", "'green' AS taxi_type"
    )
    assert "partial_count" in plan(daily_business(events))
