from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripflow.functions.casts import parse_ts, to_double, to_int
from tripflow.functions.timeparts import (
    bucket_key15,
    bucket_ts,
    heat_parts,
    month_label,
    month_parts,
    shift_year,
    weekday_name,
)


def one(spark, column, value, kind="timestamp"):
    df = spark.createDataFrame([(value,)], "t string").withColumn("t", F.col("t").cast(kind))
    return df.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize(
    "day, true, legacy",
    [("2016-03-31", "Thursday", "Sunday"), ("2018-03-31", "Saturday", "Wednesday"), (None, None, None)],
)
def test_weekday(spark, day, true, legacy, kind):
    assert one(spark, weekday_name(F.col("t")), day, kind) == true
    assert one(spark, weekday_name(F.col("t"), legacy=True), day, kind) == legacy


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_bucket(spark, kind):
    text = "2015-12-05 14:39:59.999999"
    assert one(spark, bucket_ts(F.col("t")), text, kind) == datetime(2015, 12, 5, 14, 30)
    assert one(spark, bucket_ts(F.col("t"), 15), text, kind) == datetime(2015, 12, 5, 14, 30)
    assert one(spark, bucket_ts(F.col("t"), 60), text, kind) == datetime(2015, 12, 5, 14)
    assert one(spark, bucket_key15(F.col("t")), text, kind) == "2015-12-05 14:3"
    assert one(spark, bucket_ts(F.col("t")), None, kind) is None


def test_bucket_is_at_or_before_and_within_width(spark):
    times = spark.range(5000).select(F.timestamp_seconds(F.col("id") * 7919).alias("t"))
    for minutes in (1, 5, 10, 30):
        start = bucket_ts(F.col("t"), minutes)
        seconds = F.unix_timestamp("t") - F.unix_timestamp(start)
        wrong = times.where((seconds < 0) | (seconds >= minutes * 60) | (F.unix_timestamp(start) % (minutes * 60) != 0))
        assert wrong.count() == 0


def test_bucket_width_must_divide_an_hour():
    with pytest.raises(ValueError):
        bucket_ts(F.lit(None), 7)


@pytest.mark.parametrize("kind", ["string", "timestamp", "timestamp_ntz"])
def test_heat_parts(spark, kind):
    df = spark.createDataFrame([("2016-03-31 09:07:00",)], "t string").withColumn("t", F.col("t").cast(kind))
    assert heat_parts(df, "t").drop("t").first().asDict() == {
        "year": "2016", "month": "03", "day": "31", "dow": "Thursday", "hour": "09", "ten": "0", "ten_mins": "00",
    }
    assert heat_parts(df, "t", legacy_dow=True).first()["dow"] == "Sunday"


def test_month_parts_and_label(spark):
    df = month_parts(spark.createDataFrame([("2018-03",)], "year_month_day string"))
    assert df.first().asDict() == {"year_month_day": "2018-03", "year": "2018", "month": 3}
    assert df.select(month_label(F.col("year_month_day"))).first()[0] == "2018-03-00"


def test_shift_year_touches_the_leading_year_only(spark):
    df = spark.createDataFrame([("2017-06-02 20:17:00",), ("2016-01-01 20:17:20.172017",)], "pickup_datetime string")
    got = [r[0] for r in shift_year(df, "2017", "2018").collect()]
    assert got == ["2018-06-02 20:17:00", "2016-01-01 20:17:20.172017"]


def test_casts_never_fail(spark):
    df = spark.createDataFrame([("",), ("abc",), ("1.0",), ("3",), ("1e12",), (None,)], "v string")
    assert [r[0] for r in df.select(to_int(F.col("v"))).collect()] == [None, None, 1, 3, None, None]
    assert [r[0] for r in df.select(to_double(F.col("v"))).collect()] == [None, None, 1.0, 3.0, 1e12, None]
    times = spark.createDataFrame([("2015-12-05 14:39:59",), ("2014-02-29 00:00:00",), ("",), ("x",)], "v string")
    assert [r[0] for r in times.select(parse_ts(F.col("v"))).collect()] == [datetime(2015, 12, 5, 14, 39, 59), None, None, None]
