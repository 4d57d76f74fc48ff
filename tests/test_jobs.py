import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.plans import plan
from tests.test_align import raw_header
from tripflow.plans import jobs
from tripflow.sources.readers import read_table, read_trips_csv
from tripflow.sources.schemas import HEAT, LAYOUTS, MONTH_MAP, TOTAL
from tripflow.sources.writers import write_table


def same_types(df, schema):
    return [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


@pytest.fixture(scope="module")
def raw_files(tmp_path_factory):
    """Two files for each of the 22 types and years, with every raw column.

    Four rows each: two good ones, one of another year, one without a zone.
    """
    base, paths = tmp_path_factory.mktemp("trip data"), {}
    for taxi_type, year in LAYOUTS:
        header = raw_header(taxi_type, year)
        for month in (1, 2):
            lines = [header]
            for day, zone, stated in ((5, "56", year), (6, "57", year), (7, "56", year - 1), (8, "", year)):
                fields = []
                for name in header.split(","):
                    n = name.strip().lower()
                    fields.append(
                        f"{stated}-{month:02}-{day:02} 10:11:12" if "pickup_date" in n
                        else zone if n in ("locationid", "pulocationid")
                        else "-73.9" if n in ("pickup_longitude", "start_lon")
                        else "40.7" if n in ("pickup_latitude", "start_lat")
                        else "1" if n == "passenger_count"
                        else "2.5" if n == "trip_distance"
                        else "9.5" if n in ("fare_amount", "fare_amt")
                        else ""
                    )
                lines.append(",".join(fields))
            with open(base / f"{taxi_type}_tripdata_{year}-{month:02}.csv", "w") as f:
                f.write("\n".join(lines) + "\n")
        paths[(taxi_type, year)] = f"{base}/{taxi_type}_tripdata_{year}*"
    return paths


@pytest.fixture(scope="module")
def zones(spark):
    rows = [("56", "Corona", "Queens"), ("56", "Corona", "Queens"), ("3", "Allerton", "Bronx")]
    return spark.createDataFrame(rows, "zone_id string, zone_name string, borough string")


def test_unify_all_years(spark, raw_files, zones, tmp_path):
    total = jobs.unify_trips(spark, raw_files, zones)
    assert same_types(total, TOTAL)
    path = str(tmp_path / "total")
    write_table(jobs.with_year(total), path, partition_by=["taxi_type", "year"])
    assert len(os.listdir(f"{path}/taxi_type=yellow")) == 11

    stored = read_table(spark, path)
    by_type = {r["taxi_type"]: r["count"] for r in stored.groupBy("taxi_type").count().collect()}
    # Two files a year; metered rows keep those without a zone, hired ones do not.
    assert by_type == {"green": 7 * 6, "yellow": 11 * 6, "fhv": 3 * 4, "fhvhv": 4}
    assert stored.where("year(Pickup_datetime) <> year").count() == 0
    boroughs = {r["borough"] for r in stored.where("locationID = 56").select("borough").distinct().collect()}
    assert boroughs == {"Queens"} and stored.where("locationID = 57 AND borough IS NOT NULL").count() == 0
    with_place = stored.where("Pickup_longitude = -73.9 AND Pickup_latitude = 40.7")
    assert {r["year"] for r in with_place.where("taxi_type = 'yellow'").select("year").distinct().collect()} == set(range(2009, 2017))
    assert stored.where("taxi_type IN ('green','yellow') AND (Trip_distance <> 2.5 OR Fare_amount <> 9.5 OR Passenger_count <> 1)").count() == 0
    one_year = read_table(spark, path).where("taxi_type = 'green' AND year = 2015")
    assert "PartitionFilters: [isnotnull" in plan(jobs.daily_counts(one_year))

    february = jobs.month_map(stored, datetime(2015, 2, 1), datetime(2015, 3, 1))
    assert february.count() == 6  # the February file of both metered types holds three rows of 2015 each
    partition_filters = plan(february).split("PartitionFilters: ")[1].split("\n")[0]
    assert "year#" in partition_filters and "taxi_type#" in partition_filters

    kept = jobs.unify_trips(spark, {("fhv", 2016): raw_files[("fhv", 2016)]}, zones, dedup_dim=False)
    assert kept.where("locationID = 56").count() == 4  # two trips, each twice


def test_unify_plan_shuffles_no_trip(spark, raw_files, zones):
    tree = plan(jobs.unify_trips(spark, raw_files, zones, dedup_dim=False)).split("\n\n")[0]
    assert "Exchange hash" not in tree and "SortMergeJoin" not in tree and tree.count("Scan csv") == 22


def test_month_map(spark):
    df = spark.createDataFrame(
        [
            ("2015-12-05 14:39:59", "green", -73.9, 40.7, 1, 9.0), ("2016-01-01 00:00:00", "yellow", -73.9, 40.7, 1, 9.0),
            ("2016-01-01 00:00:01", "yellow", -73.9, 40.7, 1, 9.0), ("2015-12-05 14:39:59", "fhv", -73.9, 40.7, 1, 9.0),
            ("2015-12-05 14:39:59", "green", 0.0, 40.7, 1, 9.0),
        ],
        "t string, taxi_type string, Pickup_longitude double, Pickup_latitude double, Passenger_count int, Fare_amount double",
    ).selectExpr("*", "cast(t AS timestamp) AS Pickup_datetime", "'New York' AS City", "2.0D AS Trip_distance", "1 AS Count")
    got = jobs.month_map(df)
    assert same_types(got, MONTH_MAP)
    assert sorted(r["Pickup_DataTimeTenMins"] for r in got.collect()) == [datetime(2015, 12, 5, 14, 30), datetime(2016, 1, 1)]


def test_typed_period_reaches_the_scan(spark, data, tmp_path):
    events = spark.read.parquet(f"{data}/events.parquet").selectExpr("ts AS Pickup_datetime", "event_type AS taxi_type", "value AS Fare_amount", "value AS Trip_distance")
    text = plan(jobs.regression_input(events, date(2024, 1, 5), date(2024, 1, 15), ["view", "click"]))
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in pushed and "In(event_type, [click,view])" in pushed
    assert "struct<ts:timestamp_ntz,event_type:string,value:double>" in text


METERED = (
    "vendor_id string, pickup_datetime timestamp, pickup_longitude double, pickup_latitude double, trip_distance double, "
    "passenger_count int, fare_amount double, pickup_location_id int"
)


def metered(spark, *rows):
    return spark.createDataFrame([("1", datetime.fromisoformat(t), lon, lat, d, 1, fare, zone) for t, lon, lat, d, fare, zone in rows], METERED)


def test_monthly_zone_counts(spark, zones, rows):
    fhv = spark.createDataFrame(
        [
            (56, "2017-06-02 20:17:00", "Queens", "Corona", "Boro Zone"), (56, "2017-06-03 20:17:00", "Queens", "NV", "Boro Zone"),
            (56, "2016-06-03 20:17:00", "Queens", "Corona", "Boro Zone"), (99, "2017-06-02 20:17:00", "Queens", "Corona", "Boro Zone"),
        ],
        "location_id int, pickup_datetime string, borough string, zone string, service_zone string",
    )
    green = {
        2016: metered(spark, ("2016-03-31 09:07:00", -73.9, 40.7, 2.5, 9.5, None)).drop("pickup_location_id"),
        2017: metered(spark, ("2017-03-31 09:07:00", None, None, 2.5, 9.5, 56)),
        2018: metered(spark, ("2018-03-31 09:07:00", None, None, 2.5, 9.5, 56), ("2018-03-31 09:07:00", None, None, 0.0, 9.5, 56)).drop("pickup_longitude", "pickup_latitude"),
    }
    args = ({2017: fhv}, green, {2018: green[2018]}, zones)
    shown = {"fhv_year": "2017", "relabel_fhv_to": "2018"}
    with pytest.raises(TypeError):  # which years of hired vehicles count is never left unsaid
        jobs.monthly_zone_counts(*args)
    with pytest.raises(ValueError, match="name it"):
        jobs.monthly_zone_counts(*args, fhv_year=None, relabel_fhv_to="2018")
    found = {(r["taxi_type"], r["year_month_day"], r["zone_name"], r["count"]) for r in jobs.monthly_zone_counts(*args, **shown).collect()}
    assert found == {("FHV", "2018-06", "Corona", 1), ("Green", "2017-03", "Corona", 1), ("Green", "2018-03", "Corona", 1), ("Yellow", "2018-03", "Corona", 1)}
    legacy = {(r["taxi_type"], r["year_month_day"]) for r in jobs.monthly_zone_counts(*args, **shown, legacy=True).collect()}
    assert ("Green", "2017-03") not in legacy and ("Green", "2018-03") in legacy
    true_years = {(r["taxi_type"], r["year_month_day"]) for r in jobs.monthly_zone_counts(*args, fhv_year=None, relabel_fhv_to=None).collect()}
    assert {("FHV", "2017-06"), ("FHV", "2016-06")} <= true_years
    tree = plan(jobs.monthly_zone_counts(*args, **shown)).split("\n\n")[0]
    assert tree.count("BroadcastHashJoin") == 1 and tree.count("HashAggregate") == 2


def test_heat_one_day(spark, rows):
    green = metered(spark, ("2016-03-31 09:07:00", -73.9, 40.7, 2.5, 9.5, None), ("2016-03-30 09:07:00", -73.9, 40.7, 2.5, 9.5, None))
    yellow = metered(spark, ("2016-03-31 23:59:59", 0.0, 0.0, 2.5, 9.5, None), ("2016-03-31 10:45:00", -73.9, 40.7, 2.5, 9.5, None))
    df = jobs.heat_one_day(green, yellow)
    assert same_types(df, HEAT)
    assert rows(df) == [
        ("1", "2016-03-31 09:07:00", "-73.9", "40.7", "2016", "03", "31", "Thursday", "09", "00", "Green", 1, "New York"),
        ("1", "2016-03-31 10:45:00", "-73.9", "40.7", "2016", "03", "31", "Thursday", "10", "40", "Yellow", 1, "New York"),
    ]
    assert {r["dow"] for r in jobs.heat_one_day(green, yellow, legacy_dow=True).collect()} == {"Sunday"}


def test_borough_prices_and_warehouse_regression(spark, zones, rows):
    trips = [("2018-03-31 09:07:00", None, None, 2.0 + i, 10.0 + 3 * i, 56) for i in range(6)]
    clean = jobs.clean_metered({2018: metered(spark, *trips, ("2018-03-31 09:07:00", None, None, 0.5, 9.0, 56), ("2018-03-31 09:07:00", None, None, 5.0, 9.0, 57))}, "green")
    got = jobs.borough_prices(clean, clean, zones)
    assert rows(got) == [("2018-03-31 09:0", "Queens", "Green", 17.5, 4.5), ("2018-03-31 09:0", "Queens", "Yellow", 17.5, 4.5)]
    twice = jobs.borough_prices(clean, clean, zones, dedup_dim=False)
    assert rows(twice) == rows(got)  # repeats multiply trips but not their mean
    models = jobs.warehouse_regression(clean, clean).collect()
    assert {m["taxi_type"] for m in models} == {"Green", "Yellow"} and {m["n"] for m in models} == {7}


def test_price_regression_ways(spark, tmp_path):
    total = spark.range(0, 6000, 1, 5).selectExpr(
        "id", "CASE WHEN id % 2 = 0 THEN 'green' ELSE 'yellow' END AS taxi_type",
        "timestamp'2019-02-01' + make_dt_interval(cast(id % 300 AS int)) AS Pickup_datetime",
        "2D + (id % 50) / 10 AS Trip_distance", "5D + 3 * (2 + (id % 50) / 10) AS Fare_amount",
    )
    everything = {r["taxi_type"]: r for r in jobs.price_regression(total, fraction=None).collect()}
    assert {t: r["n"] for t, r in everything.items()} == {"green": 3000, "yellow": 3000}
    hashed = jobs.price_regression(total, sample_key=["id"]).collect()
    via_csv = jobs.price_regression(total, sample_key=["id"], via_csv=str(tmp_path)).collect()
    for a, b in zip(sorted(hashed), sorted(via_csv)):
        assert a["taxi_type"] == b["taxi_type"] and tuple(a)[1:] == pytest.approx(tuple(b)[1:])
    assert sorted(p for p in os.listdir(tmp_path) if "=" in p) == ["taxi_type=green", "taxi_type=yellow"]
    drawn = jobs.price_regression(total).collect()
    for r in [*hashed, *drawn]:
        assert 200 < r["n"] < 400 and r["slope"] == pytest.approx(3 - 0.24 / 1.44, abs=0.2) and r["r2"] > 0.95


def test_default_sample_is_drawn_once(spark, tmp_path):
    path = str(tmp_path / "total")
    spark.range(0, 3000, 1, 4).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'green' ELSE 'yellow' END AS taxi_type", "timestamp'2019-02-01' AS Pickup_datetime",
        "2D + id % 50 AS Trip_distance", "5D + id % 70 AS Fare_amount",
    ).write.parquet(path)
    models = jobs.price_regression(read_table(spark, path), fraction=0.5)
    assert path not in plan(models)  # the fit reads the stored sample, not the source again
    with_tag = jobs.price_regression(read_table(spark, path), fraction=None)
    assert path in plan(with_tag)


def test_typed_tests_reach_the_warehouse_scan(spark, zones, tmp_path):
    def pushed(df):
        return " ".join(line for line in plan(df).splitlines() if line.startswith("PushedFilters"))

    for name, df in {"metered": metered(spark, ("2018-03-31 09:07:00", None, None, 2.5, 9.5, 56)), "fhv": spark.createDataFrame([(56, datetime(2017, 6, 2), "Queens", "Corona", "Boro")], "location_id int, pickup_datetime timestamp, borough string, zone string, service_zone string")}.items():
        df.write.parquet(str(tmp_path / name))
    trips, hired = (read_table(spark, str(tmp_path / n)) for n in ("metered", "fhv"))
    typed = jobs.clean_metered({2018: trips}, "green", numeric=True)
    text = pushed(typed)
    assert "GreaterThan(fare_amount,0.0)" in text and "GreaterThan(trip_distance,0.0)" in text
    assert "GreaterThan(fare_amount" not in pushed(jobs.clean_metered({2018: trips}, "green"))
    prices = jobs.borough_prices(typed, typed, zones, numeric=True)
    assert "GreaterThan(fare_amount,0.0)" in pushed(prices) and prices.count() == 2
    counts = jobs.monthly_zone_counts({2017: hired}, {2018: trips}, {2018: trips}, zones, fhv_year="2017", relabel_fhv_to=None, numeric=True)
    assert "GreaterThanOrEqual(pickup_datetime,2017-01-01" in pushed(counts)
    assert {r["taxi_type"] for r in counts.collect()} == {"FHV", "Green", "Yellow"}


def test_header_lookup_does_not_grow_with_the_files(spark, tmp_path):
    def jobs_for(files):
        folder = tmp_path / f"raw{files}"
        folder.mkdir()
        for i in range(files):
            (folder / f"{i:03}.csv").write_text("a,b\n1,2\n" if i % 2 else "b,a\n2,1\n")
        group = f"headers-{files}"
        spark.sparkContext.setJobGroup(group, group)
        df = read_trips_csv(spark, str(folder))
        started = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        assert [tuple(r) for r in df.select("a", "b").distinct().collect()] == [("1", "2")] and df.count() == files
        return started

    assert jobs_for(30) == jobs_for(4)


def test_correlations_job(spark, data):
    events = spark.read.parquet(f"{data}/events.parquet").selectExpr(
        "value AS Fare_amount", "value * 2 AS Trip_distance", "-value AS Pickup_latitude", "cast(user_id AS double) AS Pickup_longitude"
    )
    got = {r["feature"]: r for r in jobs.correlations(events).collect()}
    assert got["Trip_distance"]["spearman"] == pytest.approx(1) and got["Pickup_latitude"]["spearman"] == pytest.approx(-1)
    assert abs(got["Pickup_longitude"]["pearson"]) < 0.2
