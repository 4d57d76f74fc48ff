from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tripflow.operators import clean
from tripflow.sources.schemas import TOTAL


def kept(df, column):
    return [r[0] for r in df.select(column).collect()]


def metered(spark, **columns):
    """Valid metered rows in which the given columns take the given values."""
    base = {
        "vendor_id": "1", "pickup_datetime": "2016-03-31 09:07:00", "pickup_longitude": "-73.9", "pickup_latitude": "40.7",
        "trip_distance": "2.5", "passenger_count": "1", "fare_amount": "9.5",
    }
    (name, values), = columns.items()
    rows = [tuple({**base, name: v}.values()) for v in values]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in base))


def test_drop_unreasonable(spark):
    def df(passengers):
        return spark.createDataFrame(
            [(p, "5.0", "-73.9", "40.7") for p in passengers],
            "Passenger_count string, Fare_amount string, Pickup_longitude string, Pickup_latitude string",
        )

    assert kept(clean.drop_unreasonable(df(["0", "1", None])), "Passenger_count") == ["1"]
    assert kept(clean.drop_unreasonable(df(["0.0", "1", None]), numeric=True), "Passenger_count") == ["1"]


def test_valid_metered_text_and_numeric(spark):
    fares = ["-2.5", "0.0", "0", "0.00", "3.5", None]
    df = metered(spark, fare_amount=fares)
    assert kept(clean.valid_metered(df), "fare_amount") == ["0", "0.00", "3.5"]
    assert kept(clean.valid_metered(df, numeric=True), "fare_amount") == ["3.5"]


def test_valid_metered_without_coordinates(spark):
    df = metered(spark, pickup_longitude=["-73.9", "0.0", None])
    assert kept(clean.valid_metered(df), "pickup_longitude") == ["-73.9"]
    assert clean.valid_metered(df, coords=False).count() == 3


def test_priceable(spark):
    df = metered(spark, fare_amount=["0.8", "-1", "8.0", None])
    assert kept(clean.priceable(df), "fare_amount") == ["8.0"]
    assert kept(clean.priceable(df, numeric=True), "fare_amount") == ["0.8", "8.0"]


def test_located(spark):
    df = metered(spark, pickup_longitude=["-73.9", "0", "0.0", "0.5", None])
    assert kept(clean.located(df), "pickup_longitude") == ["-73.9"]
    assert kept(clean.located(df, numeric=True), "pickup_longitude") == ["-73.9", "0.5"]


def test_unknown_zone(spark):
    df = spark.createDataFrame(
        [("NV", "x"), ("NA", "x"), ("Astoria", "x"), ("Astoria", "N/A"), (None, "x"), ("Astoria", None)],
        "zone string, service_zone string",
    )
    assert [tuple(r) for r in clean.drop_unknown_zone(df).collect()] == [("Astoria", "x")]


def test_period_includes_both_ends(spark):
    moments = ["2015-11-30 23:59:59", "2015-12-01 00:00:00", "2016-01-01 00:00:00", "2016-01-01 00:00:01"]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame([(m,) for m in moments], "t string")
        df = df.withColumn("Pickup_datetime", F.col("t").cast(kind))
        got = kept(clean.in_period(df, datetime(2015, 12, 1), datetime(2016, 1, 1)), "t")
        assert got == moments[1:3]


def test_period_2019_ends_at_the_last_midnight(spark):
    df = spark.createDataFrame([("2019-12-31 00:00:00",), ("2019-12-31 00:00:01",)], "t string")
    df = df.withColumn("Pickup_datetime", F.col("t").cast("timestamp"))
    assert kept(clean.in_period(df, date(2019, 1, 1), date(2019, 12, 31)), "t") == ["2019-12-31 00:00:00"]


@pytest.mark.parametrize("kind", ["string", "timestamp"])
def test_one_day(spark, kind):
    df = spark.createDataFrame([("2016-03-30 23:59:59",), ("2016-03-31 00:00:00",), ("2016-03-31 23:59:59",), ("2016-04-01 00:00:00",)], "t string")
    df = df.withColumn("pickup_datetime", F.col("t").cast(kind))
    assert kept(clean.one_day(df, date(2016, 3, 31)), "t") == ["2016-03-31 00:00:00", "2016-03-31 23:59:59"]


def test_year_guard(spark):
    df = spark.createDataFrame([("2015-01-01 00:00:00",), ("x 2015",), ("2016-01-01 00:00:00",), (None,)], "Pickup_date string")
    assert clean.year_guard(df, 2015).count() == 2
    assert clean.year_guard(df, 2015, mode="prefix").count() == 1
    with pytest.raises(ValueError):
        clean.year_guard(df, 2015, mode="other")


def test_type_fact(spark):
    df = spark.createDataFrame(
        [("2015-12-05 14:39:59", "3", "New York", "green", "-73.9", "", "1.0", "abc", "9.5", "Bronx")],
        "Pickup_date string, locationID string, City string, taxi_type string, Pickup_longitude string, "
        "Pickup_latitude string, Passenger_count string, Trip_distance string, Fare_amount string, borough string",
    )
    fact = clean.type_fact(df)
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in TOTAL]
    assert tuple(fact.first()) == (
        datetime(2015, 12, 5, 14, 39, 59), 3, "New York", "green", -73.9, None, 1, None, 9.5, "Bronx", 1,
    )


def test_regression_input_and_valid_geo(spark):
    df = spark.createDataFrame(
        [
            ("2019-05-05", "green", 1.0, 9.0), ("2019-05-05", "green", 1.1, 9.0),
            ("2019-05-05", "fhv", 2.0, 9.0), ("2018-05-05", "green", 2.0, 9.0), ("2019-05-05", "yellow", 2.0, None),
        ],
        "t string, taxi_type string, Trip_distance double, Fare_amount double",
    ).withColumn("Pickup_datetime", F.col("t").cast("timestamp"))
    got = clean.regression_input(df, date(2019, 1, 1), date(2019, 12, 31))
    assert [tuple(r) for r in got.collect()] == [("green", 9.0, 1.1)]
    geo = spark.createDataFrame(
        [(-73.9, 40.7, 1, 5.0), (0.0, 40.7, 1, 5.0), (-73.9, None, 1, 5.0), (-73.9, 40.7, 0, 5.0), (-73.9, 40.7, 1, 0.0)],
        "Pickup_longitude double, Pickup_latitude double, Passenger_count int, Fare_amount double",
    )
    assert clean.valid_geo(geo).count() == 1
