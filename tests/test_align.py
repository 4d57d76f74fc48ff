import pytest
from pyspark.sql.types import StructType

from tripflow.operators.align import align_year, fold_headers, project_fhv, project_metered, tag, trim_headers, union_all
from tripflow.sources.schemas import CANONICAL, LAYOUTS

# Raw headers as the yearly files carry them.
FHV_2015 = "Dispatching_base_num,Pickup_date,locationID"
FHV_2017 = "Dispatching_base_num,Pickup_DateTime,DropOff_datetime,PUlocationID,DOlocationID"
FHVHV = "hvfhs_license_num,dispatching_base_num,pickup_datetime,dropoff_datetime,PULocationID,DOLocationID,SR_Flag"
GREEN_2013 = (
    "VendorID,lpep_pickup_datetime,Lpep_dropoff_datetime,Store_and_fwd_flag,RateCodeID,Pickup_longitude,Pickup_latitude,"
    "Dropoff_longitude,Dropoff_latitude,Passenger_count,Trip_distance,Fare_amount,Extra,MTA_tax,Tip_amount,Tolls_amount,"
    "Ehail_fee,Total_amount,Payment_type,Trip_type "
)
GREEN_2017 = (
    "VendorID,lpep_pickup_datetime,lpep_dropoff_datetime,store_and_fwd_flag,RatecodeID,PULocationID,DOLocationID,"
    "passenger_count,trip_distance,fare_amount,extra,mta_tax,tip_amount,tolls_amount,ehail_fee,improvement_surcharge,"
    "total_amount,payment_type,trip_type"
)
YELLOW_2009 = (
    "vendor_name,Trip_Pickup_DateTime,Trip_Dropoff_DateTime,Passenger_Count,Trip_Distance,Start_Lon,Start_Lat,Rate_Code,"
    "store_and_forward,End_Lon,End_Lat,Payment_Type,Fare_Amt,surcharge,mta_tax,Tip_Amt,Tolls_Amt,Total_Amt"
)
YELLOW_2010 = (
    "vendor_id,pickup_datetime,dropoff_datetime,passenger_count,trip_distance,pickup_longitude,pickup_latitude,rate_code,"
    "store_and_fwd_flag,dropoff_longitude,dropoff_latitude,payment_type,fare_amount,surcharge,mta_tax,tip_amount,"
    "tolls_amount,total_amount"
)
YELLOW_2015 = (
    "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,pickup_longitude,pickup_latitude,"
    "RateCodeID,store_and_fwd_flag,dropoff_longitude,dropoff_latitude,payment_type,fare_amount,extra,mta_tax,tip_amount,"
    "tolls_amount,improvement_surcharge,total_amount"
)
YELLOW_2017 = (
    "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,RatecodeID,store_and_fwd_flag,"
    "PULocationID,DOLocationID,payment_type,fare_amount,extra,mta_tax,tip_amount,tolls_amount,improvement_surcharge,"
    "total_amount"
)


def raw_header(taxi_type, year):
    if taxi_type == "fhv":
        return FHV_2015 if year < 2017 else FHV_2017
    if taxi_type == "fhvhv":
        return FHVHV
    if taxi_type == "green":
        base = GREEN_2013 if year < 2017 else GREEN_2017
        if year in (2015, 2016):
            base = base.replace("Ehail_fee", "Ehail_fee,improvement_surcharge")
    elif year == 2009:
        return YELLOW_2009
    elif year < 2015:
        return YELLOW_2010 if year < 2014 else YELLOW_2010.replace(",", ", ")
    else:
        base = YELLOW_2015 if year < 2017 else YELLOW_2017
        if year == 2016:
            base = base.replace("RateCodeID", "RatecodeID")
    return base + ",congestion_surcharge" if year == 2019 else base


def raw(spark, taxi_type, year):
    """One row whose values are the header's own names, folded."""
    names = raw_header(taxi_type, year).split(",")
    schema = StructType()
    for n in names:
        schema = schema.add(n, "string")
    return spark.createDataFrame([tuple(n.strip().lower() for n in names)], schema)


def test_there_are_22_layouts():
    assert len(LAYOUTS) == 22


@pytest.mark.parametrize("taxi_type, year", sorted(LAYOUTS))
def test_every_raw_header_aligns(spark, taxi_type, year):
    df = align_year(raw(spark, taxi_type, year), taxi_type, year)
    assert df.columns == CANONICAL
    row = df.first().asDict()
    assert row["City"] == "New York" and row["taxi_type"] == taxi_type
    assert "pickup" in row["Pickup_date"]
    metered = taxi_type in ("green", "yellow")
    has_coords = metered and year < 2017
    if metered:
        assert "passenger" in row["Passenger_count"] and "distance" in row["Trip_distance"] and "fare" in row["Fare_amount"]
    else:
        assert row["Passenger_count"] is row["Trip_distance"] is row["Fare_amount"] is None
    assert (row["Pickup_longitude"] is not None) == (row["Pickup_latitude"] is not None) == has_coords
    if has_coords:
        assert "lon" in row["Pickup_longitude"] and "lat" in row["Pickup_latitude"]
        assert row["locationID"] is None
    else:
        assert row["locationID"] in ("locationid", "pulocationid")


def test_missing_field_and_unknown_year_are_errors(spark):
    with pytest.raises(ValueError, match="lacks"):
        align_year(spark.createDataFrame([("a",)], "Pickup_date string"), "fhv", 2015)
    with pytest.raises(ValueError, match="no raw layout"):
        align_year(spark.createDataFrame([("a",)], "Pickup_date string"), "fhv", 2008)


def test_trim_and_fold(spark):
    df = spark.createDataFrame([(1, 2)], "` A` int, `b ` int")
    assert trim_headers(df).columns == ["A", "b"]
    assert fold_headers(df).columns == ["a", "b"]
    with pytest.raises(ValueError, match="clash"):
        fold_headers(spark.createDataFrame([(1, 2)], "`a` int, ` A` int"))


def test_union_all_folds_fills_and_keeps_order(spark, rows):
    a = spark.createDataFrame([("1",)], "a string")
    ba = spark.createDataFrame([("2", "3")], "B string, a string")
    b = spark.createDataFrame([("4",)], "b string")
    df = union_all([a, ba, b])
    assert df.columns == ["a", "b"]
    assert rows(df) == sorted([("1", None), ("3", "2"), (None, "4")], key=str)


def test_union_all_type_conflict_and_empty(spark):
    frames = [spark.createDataFrame([("1",)], "a string"), spark.createDataFrame([(2,)], "a int")]
    with pytest.raises(TypeError):
        union_all(frames)
    assert [r[0] for r in union_all(frames, cast_to="string").collect()] == ["1", "2"]
    empty = union_all([], spark=spark, schema=frames[0].schema)
    assert empty.count() == 0 and empty.columns == ["a"]
    with pytest.raises(ValueError):
        union_all([])


def test_union_all_count_is_the_sum(spark):
    frames = [spark.range(n).withColumnRenamed("id", name) for n, name in ((3, "a"), (5, "b"), (7, "A"))]
    df = union_all(frames)
    assert df.count() == 15 and set(df.columns) == {"a", "b"}


def test_warehouse_projections(spark):
    fhv = spark.createDataFrame([(1, "t", "b", "z", "s", 9)], "location_id int, pickup_datetime string, borough string, zone string, service_zone string, other int")
    assert project_fhv(fhv).dtypes[0] == ("location_id", "string")
    early = spark.createDataFrame([("1", "t", 1.5)], "vendor_id string, pickup_datetime string, fare_amount double")
    row = project_metered(early).first().asDict()
    assert row["fare_amount"] == "1.5" and row["pickup_location_id"] is None and row["pickup_longitude"] is None
    assert tag(early, Count=1, City="New York").columns[-2:] == ["Count", "City"]
