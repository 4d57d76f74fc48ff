"""

The tables hold orders and events rather than trips, so three views stand in:

* ``trips``   lineitem with its order and customer: date, zone, type, measures
* ``pings``   events with their customer: trips with a time of day and a position
* ``orders``  alone, cut into slices that carry the headers of the raw yearly files

Each view covers its whole tables. Every query is paired with the SQL that states the
same result, for ``bernoulli_sample`` the properties of one.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripflow.functions.casts import parse_ts, to_double, to_int
from tripflow.functions.timeparts import (
    bucket_key15,
    bucket_ts,
    calendar_parts,
    day_key,
    day_of,
    heat_parts,
    month_key,
    month_label,
    month_parts,
    shift_year,
    weekday_name,
)
from tripflow.operators.aggregate import bucket_prices, daily_business, monthly_business
from tripflow.operators.align import align_year, tag, trim_headers, union_all
from tripflow.operators.clean import (
    drop_unknown_zone,
    drop_unreasonable,
    in_period,
    located,
    metered_only,
    one_day,
    priceable,
    regression_input,
    require,
    type_fact,
    valid_geo,
    valid_metered,
    year_guard,
)
from tripflow.operators.enrich import enrich_zone
from tripflow.operators.regress import fit_price, fit_price_ml, model_metrics
from tripflow.operators.sample import hash_sample, sample_rows
from tripflow.operators.stats import correlate, correlation_screen
from tripflow.plans import jobs
from tripflow.session import scratch_path
from tripflow.sources.readers import read_pairs_csv, read_table, read_trips_csv, read_warehouse
from tripflow.sources.schemas import DAILY, MONTH_MAP
from tripflow.sources.writers import preview, publish_table, stored, write_pairs_csv, write_table, write_warehouse

SMOKE_DIR = "/root/testdata/sf0.001"
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


# --- views over the given tables ----------------------------------------------------


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, f"{d}/{name}.parquet")


def zones(spark: SparkSession, d: str) -> DataFrame:
    nation, region = _table(spark, d, "nation"), _table(spark, d, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("zone_id"), F.col("n_name").alias("zone_name"), F.col("r_name").alias("borough")
    )


def trips(spark: SparkSession, d: str) -> DataFrame:
    # Orders meet customers first: the wide lineitem side then moves only once.
    orders, customer = _table(spark, d, "orders"), _table(spark, d, "customer")
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    status = F.col("o_orderstatus")
    return (
        _table(spark, d, "lineitem")
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "l_orderkey",
            F.col("o_orderdate").alias("Pickup_datetime"),
            F.col("c_nationkey").alias("locationID"),
            F.when(status == "F", "green").when(status == "O", "yellow").otherwise("fhv").alias("taxi_type"),
            F.col("l_linenumber").alias("Passenger_count"),
            F.col("l_quantity").alias("Trip_distance"),
            F.col("l_extendedprice").alias("Fare_amount"),
        )
    )


_TRIPS = """
zones AS (
  SELECT n_nationkey AS zone_id, n_name AS zone_name, r_name AS borough
  FROM nation JOIN region ON n_regionkey = r_regionkey),
trips AS (
  SELECT l_orderkey, o_orderdate AS pickup_ts, c_nationkey AS location_id,
    CASE o_orderstatus WHEN 'F' THEN 'green' WHEN 'O' THEN 'yellow' ELSE 'fhv' END AS taxi_type,
    l_linenumber AS passenger_count, l_quantity AS trip_distance, l_extendedprice AS fare_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
"""


def pings(spark: SparkSession, d: str) -> DataFrame:
    events, customer = _table(spark, d, "events"), _table(spark, d, "customer")
    kind = F.col("event_type")
    return events.join(customer, F.col("user_id") == F.col("c_custkey")).select(
        "event_id",
        F.col("ts").alias("Pickup_datetime"),
        F.col("c_nationkey").alias("locationID"),
        F.lit("New York").alias("City"),
        F.when(kind == "click", "green").when(kind == "view", "yellow").otherwise("fhv").alias("taxi_type"),
        (-(F.col("user_id") % 180) / 4.0).alias("Pickup_longitude"),
        ((F.col("user_id") % 90) / 8.0).alias("Pickup_latitude"),
        (F.col("event_id") % 7).cast("int").alias("Passenger_count"),
        (F.col("value") / 2.5).alias("Trip_distance"),
        F.col("value").alias("Fare_amount"),
        F.lit(1).alias("Count"),
    )


_PINGS = """
zones AS (
  SELECT n_nationkey AS zone_id, n_name AS zone_name, r_name AS borough
  FROM nation JOIN region ON n_regionkey = r_regionkey),
pings AS (
  SELECT event_id, ts, c_nationkey AS location_id, 'New York' AS city,
    CASE event_type WHEN 'click' THEN 'green' WHEN 'view' THEN 'yellow' ELSE 'fhv' END AS taxi_type,
    CAST(-(user_id % 180) AS DOUBLE) / 4 AS lon, CAST(user_id % 90 AS DOUBLE) / 8 AS lat,
    CAST(event_id % 7 AS INTEGER) AS passenger_count, value / 2.5 AS trip_distance, value AS fare_amount
  FROM events JOIN customer ON user_id = c_custkey)
"""


def _warehouse_pings(spark: SparkSession, d: str, taxi_type: str) -> DataFrame:
    """Pings of one type with warehouse column names; the zone id is the customer's."""
    return (
        metered_only(pings(spark, d), [taxi_type])
        .withColumnsRenamed(
            {
                "Pickup_datetime": "pickup_datetime",
                "Pickup_longitude": "pickup_longitude",
                "Pickup_latitude": "pickup_latitude",
                "Trip_distance": "trip_distance",
                "Fare_amount": "fare_amount",
                "Passenger_count": "passenger_count",
                "locationID": "pickup_location_id",
            }
        )
        .withColumn("vendor_id", (F.col("event_id") % 2).cast("string"))
    )


# Each order belongs to one slice: (taxi type, layout year, condition). A slice has the
# header of its raw files, and its dates carry the layout's year.
_SLICES = [
    ("yellow", 2009, "o_orderstatus = 'O' AND o_orderdate < '1997-01-01'"),
    ("yellow", 2014, "o_orderstatus = 'O' AND o_orderdate >= '1997-01-01' AND o_orderdate < '1999-01-01'"),
    ("yellow", 2015, "o_orderstatus = 'O' AND o_orderdate >= '1999-01-01' AND o_orderdate < '2000-01-01'"),
    ("yellow", 2017, "o_orderstatus = 'O' AND o_orderdate >= '2000-01-01'"),
    ("green", 2013, "o_orderstatus = 'F' AND o_orderdate < '1998-01-01'"),
    ("green", 2019, "o_orderstatus = 'F' AND o_orderdate >= '1998-01-01'"),
    ("fhv", 2015, "o_orderstatus = 'P' AND o_orderdate < '1997-01-01'"),
    ("fhv", 2017, "o_orderstatus = 'P' AND o_orderdate >= '1997-01-01' AND o_orderdate < '1999-01-01'"),
    ("fhvhv", 2019, "o_orderstatus = 'P' AND o_orderdate >= '1999-01-01'"),
]

# Header of each raw layout, in the order pickup, longitude, latitude,
# passengers, distance, fare, zone as far as the layout has them.
_HEADERS = {
    ("yellow", 2009): ["Trip_Pickup_DateTime", "Start_Lon", "Start_Lat", "Passenger_Count", "Trip_Distance", "Fare_Amt"],
    ("yellow", 2014): [
        " pickup_datetime", " pickup_longitude", " pickup_latitude", " passenger_count", " trip_distance", " fare_amount",
    ],
    ("yellow", 2015): [
        "tpep_pickup_datetime", "pickup_longitude", "pickup_latitude", "passenger_count", "trip_distance", "fare_amount",
    ],
    ("yellow", 2017): ["tpep_pickup_datetime", "passenger_count", "trip_distance", "fare_amount", "PULocationID"],
    ("green", 2013): [
        "lpep_pickup_datetime", "Pickup_longitude", "Pickup_latitude", "Passenger_count", "Trip_distance", "Fare_amount",
    ],
    ("green", 2019): ["lpep_pickup_datetime", "passenger_count", "trip_distance", "fare_amount", "PULocationID"],
    ("fhv", 2015): ["Pickup_date", "locationID"],
    ("fhv", 2017): ["Pickup_DateTime", "PUlocationID"],
    ("fhvhv", 2019): ["pickup_datetime", "PULocationID"],
}
_FIELDS = {
    "pickup": "concat(%d, substring(cast(o_orderdate AS string), 5, 15))",
    "lon": "cast(-(o_custkey % 180) AS string)",
    "lat": "cast(o_custkey % 90 AS string)",
    "passengers": "concat(o_orderkey % 7, '.0')",
    "distance": "cast((o_custkey % 300) / 10 AS string)",
    "fare": "CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE cast(o_totalprice AS string) END",
    "zone": "CASE WHEN o_custkey % 31 < 30 THEN cast(o_custkey % 31 AS string) END",
}


def _raw_slices(spark: SparkSession, d: str) -> dict[tuple[str, int], DataFrame]:
    orders, raw = _table(spark, d, "orders"), {}
    for taxi_type, year, condition in _SLICES:
        header = _HEADERS[(taxi_type, year)]
        fields = ["pickup"]
        fields += ["lon", "lat"] if len(header) == 6 else []
        fields += ["passengers", "distance", "fare"] if len(header) > 2 else []
        fields += ["zone"] if len(header) != 6 else []
        columns = [
            F.expr(_FIELDS[f].replace("%d", f"'{year}'")).alias(name) for f, name in zip(fields, header)
        ]
        raw[(taxi_type, year)] = orders.where(condition).select(*columns)
    return raw


_SLICED = """
cut AS (
  SELECT *,
    CASE WHEN o_orderstatus = 'O' THEN 'yellow' WHEN o_orderstatus = 'F' THEN 'green'
         WHEN year(o_orderdate) < 1999 THEN 'fhv' ELSE 'fhvhv' END AS taxi_type,
    CASE WHEN o_orderstatus = 'O' THEN
           CASE WHEN year(o_orderdate) < 1997 THEN 2009 WHEN year(o_orderdate) < 1999 THEN 2014
                WHEN year(o_orderdate) < 2000 THEN 2015 ELSE 2017 END
         WHEN o_orderstatus = 'F' THEN CASE WHEN year(o_orderdate) < 1998 THEN 2013 ELSE 2019 END
         WHEN year(o_orderdate) < 1997 THEN 2015 WHEN year(o_orderdate) < 1999 THEN 2017 ELSE 2019 END AS y
  FROM orders),
sliced AS (
  SELECT CAST(y AS VARCHAR) || strftime(o_orderdate, '-%m-%d %H:%M:%S') AS pickup,
    taxi_type,
    taxi_type IN ('green', 'yellow') AS metered,
    taxi_type IN ('green', 'yellow') AND y < 2017 AS has_coords,
    o_custkey, o_orderkey, o_orderpriority, o_totalprice
  FROM cut),
canon AS (
  SELECT pickup AS Pickup_date,
    CASE WHEN has_coords THEN CAST(-(o_custkey % 180) AS VARCHAR) END AS Pickup_longitude,
    CASE WHEN has_coords THEN CAST(o_custkey % 90 AS VARCHAR) END AS Pickup_latitude,
    CASE WHEN metered THEN CAST(o_orderkey % 7 AS VARCHAR) || '.0' END AS Passenger_count,
    CASE WHEN metered THEN CAST(CAST((o_custkey % 300) / 10 AS DOUBLE) AS VARCHAR) END AS Trip_distance,
    CASE WHEN NOT metered THEN NULL WHEN o_orderpriority = '5-LOW' THEN 'n/a'
         ELSE CAST(o_totalprice AS VARCHAR) END AS Fare_amount,
    'New York' AS City, taxi_type,
    CASE WHEN NOT has_coords AND o_custkey % 31 < 30 THEN CAST(o_custkey % 31 AS VARCHAR) END AS locationID
  FROM sliced)
"""


# --- queries ------------------------------------------------------------------------

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def _rounded(df: DataFrame, *cols: str, places: int = 4) -> DataFrame:
    """Rounds by way of nine exact decimals, so that a tie is a tie in both engines."""
    exact = {c: F.col(c).cast("decimal(24,9)") for c in cols}
    return df.withColumns({c: F.round(v, places).cast("double") for c, v in exact.items()})


def _round(expression: str, places: int = 4) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(24, 9)), {places}) AS DOUBLE)"


_DAILY_SQL = f"""
WITH {_TRIPS}
SELECT CAST(CAST(pickup_ts AS DATE) AS TIMESTAMP) AS "Pickup_DateDay", borough, taxi_type,
  CAST(count(*) AS INTEGER) AS "Count",
  CAST(month(CAST(pickup_ts AS DATE)) AS INTEGER) AS "Month",
  CAST(day(CAST(pickup_ts AS DATE)) AS INTEGER) AS "Day",
  dayname(CAST(pickup_ts AS DATE)) AS "DOW"
FROM trips LEFT JOIN zones ON location_id = zone_id
GROUP BY CAST(pickup_ts AS DATE), borough, taxi_type
"""


_DAILY_LEGACY_SQL = _DAILY_SQL.replace(
    "dayname(CAST(pickup_ts AS DATE))", "dayname(make_date(year(CAST(pickup_ts AS DATE)), 1, day(CAST(pickup_ts AS DATE))))"
)


@_query("daily_legacy_dow", _DAILY_LEGACY_SQL)
def q_daily_legacy_dow(spark, d):
    return jobs.daily_counts(enrich_zone(trips(spark, d), zones(spark, d)), legacy_dow=True)


@_query("daily_bigint", _DAILY_SQL.replace("CAST(count(*) AS INTEGER)", "count(*)"))
def q_daily_bigint(spark, d):
    return jobs.daily_counts(enrich_zone(trips(spark, d), zones(spark, d)), count_type="bigint")


@_query("daily_business", _DAILY_SQL)
def q_daily_business(spark, d):
    return daily_business(enrich_zone(trips(spark, d), zones(spark, d)))


@_query(
    "monthly_business",
    f"""
WITH {_TRIPS}, m AS (
  SELECT strftime(pickup_ts, '%Y-%m') AS k, zone_name, taxi_type, count(*) AS n
  FROM trips JOIN zones ON location_id = zone_id GROUP BY 1, 2, 3)
SELECT k AS year_month_day, zone_name, n AS "count", taxi_type, substr(k, 1, 4) AS year,
  CAST(substr(k, 6, 2) AS INTEGER) AS month, k || '-00' AS year_month_day_new
FROM m""",
)
def q_monthly_business(spark, d):
    named = enrich_zone(trips(spark, d), zones(spark, d), how="inner", columns=["zone_name"])
    return monthly_business(named, ts="Pickup_datetime")


@_query(
    "total_fact",
    f"""
WITH {_TRIPS}
SELECT pickup_ts AS "Pickup_datetime", location_id AS "locationID", 'New York' AS "City", taxi_type,
  CAST(NULL AS DOUBLE) AS "Pickup_longitude", CAST(NULL AS DOUBLE) AS "Pickup_latitude",
  passenger_count AS "Passenger_count", trip_distance AS "Trip_distance", fare_amount AS "Fare_amount",
  borough, CAST(1 AS INTEGER) AS "Count"
FROM trips LEFT JOIN zones ON location_id = zone_id""",
)
def q_total_fact(spark, d):
    typed = trips(spark, d)
    text = typed.select(
        F.date_format("Pickup_datetime", "yyyy-MM-dd HH:mm:ss").alias("Pickup_date"),
        F.lit(None).cast("string").alias("Pickup_longitude"),
        F.lit(None).cast("string").alias("Pickup_latitude"),
        F.lit("New York").alias("City"),
        "taxi_type",
        *[F.col(c).cast("string") for c in ("locationID", "Passenger_count", "Trip_distance", "Fare_amount")],
    )
    return type_fact(enrich_zone(text, zones(spark, d)))


@_query(
    "left_missing_zone",
    f"""
WITH {_TRIPS}
SELECT location_id AS "locationID", borough, count(*) AS n
FROM trips LEFT JOIN (SELECT * FROM zones WHERE borough <> 'ASIA') z ON location_id = zone_id
GROUP BY 1, 2""",
)
def q_left_missing_zone(spark, d):
    known = zones(spark, d).where("borough <> 'ASIA'")
    return enrich_zone(trips(spark, d), known).groupBy("locationID", "borough").agg(F.count("*").alias("n"))


@_query(
    "zone_fanout",
    f"""
WITH {_TRIPS}, repeated AS (
  SELECT zone_id, borough FROM zones UNION ALL
  SELECT zone_id, borough FROM zones WHERE borough IN ('ASIA', 'EUROPE') UNION ALL
  SELECT zone_id, borough FROM zones WHERE borough = 'ASIA')
SELECT 'kept' AS repeats, borough, count(*) AS n
FROM trips LEFT JOIN repeated ON location_id = zone_id GROUP BY borough
UNION ALL
SELECT 'dropped', borough, count(*)
FROM trips LEFT JOIN (SELECT DISTINCT * FROM repeated) ON location_id = zone_id GROUP BY borough""",
)
def q_zone_fanout(spark, d):
    base = zones(spark, d).select("zone_id", "borough")
    repeated = base.unionByName(base.where("borough IN ('ASIA', 'EUROPE')")).unionByName(base.where("borough = 'ASIA'"))
    parts = []
    for label, dedup in (("kept", False), ("dropped", True)):
        joined = enrich_zone(trips(spark, d), repeated, dedup_dim=dedup)
        parts.append(tag(joined.groupBy("borough").agg(F.count("*").alias("n")), repeats=label))
    return union_all(parts)


_MONTH_MAP_SQL = f"""
WITH {_PINGS}
SELECT city AS "City", taxi_type, lon AS "Pickup_longitude", lat AS "Pickup_latitude",
  passenger_count AS "Passenger_count", trip_distance AS "Trip_distance", fare_amount AS "Fare_amount",
  CAST(1 AS INTEGER) AS "Count", time_bucket(INTERVAL 10 MINUTE, ts) AS "Pickup_DataTimeTenMins"
FROM pings
WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-15' AND taxi_type IN ('green', 'yellow')
  AND lon < 0 AND lat > 0 AND passenger_count > 0 AND fare_amount > 0"""


@_query("month_map", _MONTH_MAP_SQL)
def q_month_map(spark, d):
    return jobs.month_map(pings(spark, d), datetime(2024, 1, 5), datetime(2024, 1, 15))


def _heat_sql(dow: str) -> str:
    return f"""
WITH {_PINGS}, t AS (
  SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS text FROM pings
  WHERE CAST(ts AS DATE) = DATE '2024-01-30' AND taxi_type IN ('green', 'yellow')
    AND NOT starts_with(CAST(lon AS VARCHAR), '0'))
SELECT CAST(event_id % 2 AS VARCHAR) AS vendor_id, CAST(ts AS VARCHAR) AS pickup_datetime,
  CAST(lon AS VARCHAR) AS pickup_longitude, CAST(lat AS VARCHAR) AS pickup_latitude,
  strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, {dow} AS dow,
  strftime(ts, '%H') AS hour, substr(text, 15, 1) || '0' AS ten_mins,
  CASE taxi_type WHEN 'green' THEN 'Green' ELSE 'Yellow' END AS taxi_type,
  CAST(1 AS INTEGER) AS "Count", city AS "City"
FROM t"""


@_query("heat_one_day", _heat_sql("dayname(ts)"))
def q_heat_one_day(spark, d):
    green, yellow = (_warehouse_pings(spark, d, t) for t in ("green", "yellow"))
    return jobs.heat_one_day(green, yellow, date(2024, 1, 30))


@_query("heat_legacy_dow", _heat_sql("dayname(make_date(year(ts), 1, day(ts)))"))
def q_heat_legacy_dow(spark, d):
    green, yellow = (_warehouse_pings(spark, d, t) for t in ("green", "yellow"))
    return jobs.heat_one_day(green, yellow, date(2024, 1, 30), legacy_dow=True)


@_query(
    "bucket_prices",
    f"""
WITH {_PINGS}
SELECT substr(strftime(ts, '%Y-%m-%d %H:%M'), 1, 15) AS pickup_datetime, borough, taxi_type,
  {_round('avg(fare_amount)')} AS fare_amount_avg, {_round('avg(trip_distance)')} AS trip_distance_avg
FROM pings JOIN zones ON location_id = zone_id
GROUP BY 1, 2, 3""",
)
def q_bucket_prices(spark, d):
    located_pings = enrich_zone(pings(spark, d), zones(spark, d), how="inner")
    return _rounded(
        bucket_prices(located_pings, "Pickup_datetime", "Fare_amount", "Trip_distance", REGIONS),
        "fare_amount_avg",
        "trip_distance_avg",
    )


def _borough_sql(usable: str) -> str:
    return f"""
WITH {_PINGS}
SELECT substr(strftime(ts, '%Y-%m-%d %H:%M'), 1, 15) AS pickup_datetime, borough,
  CASE taxi_type WHEN 'green' THEN 'Green' ELSE 'Yellow' END AS taxi_type,
  {_round('avg(fare_amount)')} AS fare_amount_avg, {_round('avg(trip_distance)')} AS trip_distance_avg
FROM pings JOIN (SELECT zone_id, CASE borough WHEN 'ASIA' THEN 'Queens' WHEN 'AFRICA' THEN 'Bronx' ELSE 'Brooklyn' END AS borough
                 FROM zones) ON location_id = zone_id
WHERE taxi_type IN ('green', 'yellow') AND {usable}
GROUP BY 1, 2, 3"""


def _borough_prices(spark: SparkSession, d: str, numeric: bool) -> DataFrame:
    renamed = zones(spark, d).withColumn(
        "borough", F.expr("CASE borough WHEN 'ASIA' THEN 'Queens' WHEN 'AFRICA' THEN 'Bronx' ELSE 'Brooklyn' END")
    )
    green, yellow = (
        jobs.clean_metered({2018: _warehouse_pings(spark, d, t)}, t, numeric=numeric) for t in ("green", "yellow")
    )
    return _rounded(jobs.borough_prices(green, yellow, renamed, numeric), "fare_amount_avg", "trip_distance_avg")


@_query("borough_prices", _borough_sql("fare_amount >= 1 AND trip_distance >= 1"))
def q_borough_prices(spark, d):
    return _borough_prices(spark, d, False)


@_query("borough_prices_numeric", _borough_sql("fare_amount > 0 AND trip_distance > 0"))
def q_borough_prices_numeric(spark, d):
    return _borough_prices(spark, d, True)


def _zone_counts_sql(late: str, hired: str = "year(o_orderdate) = 1997", relabel: str = "replace(k, '1997', '1998')") -> str:
    return f"""
WITH z AS (SELECT CAST(n_nationkey AS VARCHAR) AS zone_id, n_name AS zone_name FROM nation),
o AS (
  SELECT o_orderstatus AS s, CAST(year(o_orderdate) AS INTEGER) AS y, strftime(o_orderdate, '%Y-%m') AS k,
    CAST(o_custkey % 31 AS VARCHAR) AS zone
  FROM orders WHERE o_totalprice <> 0 AND o_custkey % 300 <> 0),
t AS (
  SELECT {relabel} AS k, zone, 'FHV' AS taxi_type
  FROM (SELECT strftime(o_orderdate, '%Y-%m') AS k, CAST(o_custkey % 31 AS VARCHAR) AS zone FROM orders
        WHERE o_orderstatus = 'P' AND {hired} AND o_orderpriority <> '5-LOW')
  UNION ALL SELECT k, zone, 'Green' FROM o WHERE s = 'F' AND {late}
  UNION ALL SELECT k, zone, 'Yellow' FROM o WHERE s = 'O' AND {late}),
m AS (SELECT k, zone_name, taxi_type, count(*) AS n FROM t JOIN z ON zone = zone_id GROUP BY 1, 2, 3)
SELECT k AS year_month_day, zone_name, n AS "count", taxi_type, substr(k, 1, 4) AS year,
  CAST(substr(k, 6, 2) AS INTEGER) AS month, k || '-00' AS year_month_day_new
FROM m"""


def _zone_counts(spark: SparkSession, d: str, late_year: int = 2018, **options) -> DataFrame:
    orders = _table(spark, d, "orders").withColumns(
        {
            "pickup_datetime": F.col("o_orderdate"),
            "zone_no": F.col("o_custkey") % 31,
            "vendor_id": F.lit("1"),
            "trip_distance": (F.col("o_custkey") % 300) / 10,
            "fare_amount": F.col("o_totalprice"),
            "passenger_count": F.col("o_orderkey") % 7,
        }
    )
    base = ["vendor_id", "pickup_datetime", "trip_distance", "fare_amount", "passenger_count"]
    hired = orders.where("o_orderstatus = 'P'").select(
        F.col("zone_no").alias("location_id"),
        "pickup_datetime",
        F.lit("any").alias("borough"),
        F.when(F.col("o_orderpriority") == "5-LOW", "NV").otherwise("zone").alias("zone"),
        F.lit("Boro Zone").alias("service_zone"),
    )

    def metered(status: str) -> dict[int, DataFrame]:
        mine = orders.where(F.col("o_orderstatus") == status)
        early, late = mine.where("o_orderdate < '1998-01-01'"), mine.where("o_orderdate >= '1998-01-01'")
        with_coords = early.select(
            *base, F.lit(-73.9).alias("pickup_longitude"), F.lit(40.7).alias("pickup_latitude")
        )
        with_zone = late.select(*base, F.col("zone_no").alias("pickup_location_id"))
        return {2016: with_coords, late_year: with_zone}

    options = {"fhv_year": "1997", "relabel_fhv_to": "1998"} | options
    return jobs.monthly_zone_counts({2017: hired}, metered("F"), metered("O"), zones(spark, d), **options)


@_query("monthly_zone_counts", _zone_counts_sql("y >= 1998"))
def q_monthly_zone_counts(spark, d):
    return _zone_counts(spark, d)


@_query("monthly_zone_counts_numeric", _zone_counts_sql("y >= 1998"))
def q_monthly_zone_counts_numeric(spark, d):
    return _zone_counts(spark, d, numeric=True)


# The compatible mode asks coordinates of 2017, which has none: only the hired vehicles are left.
@_query("monthly_zone_counts_legacy", _zone_counts_sql("false"))
def q_monthly_zone_counts_legacy(spark, d):
    return _zone_counts(spark, d, late_year=2017, legacy=True)


@_query("monthly_zone_counts_all_years", _zone_counts_sql("y >= 1998", hired="true", relabel="k"))
def q_monthly_zone_counts_all_years(spark, d):
    return _zone_counts(spark, d, fhv_year=None, relabel_fhv_to=None)


@_query(
    "union_by_name",
    """
SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment,
  CAST(NULL AS VARCHAR) AS brand FROM customer
UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL, NULL FROM supplier
UNION ALL SELECT p_name, NULL, NULL, NULL, p_brand FROM part""",
)
def q_union_by_name(spark, d):
    customer = _table(spark, d, "customer").selectExpr(
        "c_name AS Name", "c_nationkey AS nation", "c_acctbal AS balance", "c_mktsegment AS segment"
    )
    supplier = _table(spark, d, "supplier").selectExpr("s_acctbal AS `Balance `", "s_name AS name", "s_nationkey AS NATION")
    part = _table(spark, d, "part").selectExpr("p_brand AS ` brand`", "p_name AS name")
    return union_all([customer, supplier, part])


@_query("empty_union", "SELECT s_suppkey AS id, s_name AS name FROM supplier")
def q_empty_union(spark, d):
    suppliers = _table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    seed = union_all([], spark=spark, schema=suppliers.schema)
    return union_all([seed, suppliers], fold_case=False)


@_query("align_years", f"WITH {_SLICED} SELECT * FROM canon")
def q_align_years(spark, d):
    return union_all([align_year(df, t, y) for (t, y), df in _raw_slices(spark, d).items()], fold_case=False)


@_query(
    "unify_trips",
    f"""
WITH {_SLICED}
SELECT TRY_CAST("Pickup_date" AS TIMESTAMP) AS "Pickup_datetime", CAST("locationID" AS INTEGER) AS "locationID",
  "City", taxi_type, CAST("Pickup_longitude" AS DOUBLE) AS "Pickup_longitude",
  CAST("Pickup_latitude" AS DOUBLE) AS "Pickup_latitude",
  CAST(CAST("Passenger_count" AS DOUBLE) AS INTEGER) AS "Passenger_count",
  CAST("Trip_distance" AS DOUBLE) AS "Trip_distance", TRY_CAST("Fare_amount" AS DOUBLE) AS "Fare_amount",
  r_name AS borough, CAST(1 AS INTEGER) AS "Count"
FROM canon LEFT JOIN nation ON TRY_CAST("locationID" AS INTEGER) = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
WHERE taxi_type IN ('green', 'yellow') OR "locationID" IS NOT NULL""",
)
def q_unify_trips(spark, d):
    folder, paths = scratch_path(spark, "raw"), {}
    for (taxi_type, year), df in _raw_slices(spark, d).items():
        paths[(taxi_type, year)] = f"{folder}/{taxi_type}_tripdata_{year}"
        writer = df.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
        writer.option("ignoreTrailingWhiteSpace", False).csv(paths[(taxi_type, year)])
    # Some years declare their header, the others are looked at.
    declared = {
        key: StructType([StructField(c, StringType()) for c in header]) for key, header in _HEADERS.items() if key[1] > 2014
    }
    return jobs.unify_trips(spark, paths, zones(spark, d), schemas=declared)


@_query(
    "glob_list",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS "key", CAST(o_custkey AS VARCHAR) AS cust FROM orders""",
)
def q_glob_list(spark, d):
    orders, folder = _table(spark, d, "orders"), scratch_path(spark, "globs")
    key, cust = F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("cust")
    slices = {"early_a": "F", "early_b": "O", "late": "P"}
    for name, status in slices.items():
        columns = (cust, key) if name == "early_b" else (key, cust)
        orders.where(F.col("o_orderstatus") == status).select(*columns).write.option("header", True).csv(f"{folder}/{name}")
    return read_trips_csv(spark, [f"{folder}/early_*", f"{folder}/late"])


@_query(
    "header_drift",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS "key", CAST(o_custkey AS VARCHAR) AS cust FROM orders""",
)
def q_header_drift(spark, d):
    orders, folder = _table(spark, d, "orders"), scratch_path(spark, "drift")
    key, cust = F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("cust")
    early, late = orders.where("o_orderdate < '1998-01-01'"), orders.where("o_orderdate >= '1998-01-01'")
    for df in (early.select(key, cust), late.select(cust, key)):
        df.write.mode("append").option("header", True).csv(folder)
    return read_trips_csv(spark, folder)


@_query(
    "trim_headers",
    "SELECT s_suppkey AS id, s_name AS name FROM supplier",
)
def q_trim_headers(spark, d):
    return trim_headers(_table(spark, d, "supplier").selectExpr("s_suppkey AS ` id`", "s_name AS `name `"))


@_query(
    "year_guard",
    """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS text, o_orderdate FROM orders)
SELECT 'contains' AS way, o_orderkey FROM o WHERE contains(text, '1997')
UNION ALL SELECT 'prefix', o_orderkey FROM o WHERE starts_with(text, '1997')
UNION ALL SELECT 'range', o_orderkey FROM o WHERE year(o_orderdate) = 1997""",
)
def q_year_guard(spark, d):
    typed = _table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("Pickup_date"))
    text = typed.withColumn("Pickup_date", F.col("Pickup_date").cast("string"))
    ways = {"contains": text, "prefix": text, "range": typed}
    return union_all([tag(year_guard(df, 1997, mode=way).select("o_orderkey"), way=way) for way, df in ways.items()])


_LINES = """
WITH t AS (
  SELECT l_orderkey, l_linenumber, l_shipdate, CAST(l_linenumber - 1 AS VARCHAR) AS passengers,
    CAST(l_extendedprice - 20000 AS VARCHAR) AS fare, CAST(l_quantity - 10 AS VARCHAR) AS distance,
    CAST(l_partkey % 50 AS VARCHAR) AS lon, CAST(CAST(l_suppkey % 7 AS DOUBLE) AS VARCHAR) AS lat
  FROM lineitem)
SELECT l_orderkey, l_linenumber FROM t WHERE """


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_linenumber") - 1).cast("string").alias("passenger_count"),
        (F.col("l_extendedprice") - 20000).cast("string").alias("fare_amount"),
        (F.col("l_quantity") - 10).cast("string").alias("trip_distance"),
        (F.col("l_partkey") % 50).cast("string").alias("pickup_longitude"),
        (F.col("l_suppkey") % 7).cast("double").cast("string").alias("pickup_latitude"),
        F.col("l_shipdate").cast("string").alias("pickup_datetime"),
        F.lit("1").alias("vendor_id"),
    )


def _line_ids(df: DataFrame) -> DataFrame:
    return df.select("l_orderkey", "l_linenumber")


@_query(
    "drop_unreasonable",
    _LINES + "passengers <> '0' AND NOT starts_with(fare, '-') AND lon <> '0' AND lat <> '0'",
)
def q_drop_unreasonable(spark, d):
    return _line_ids(drop_unreasonable(_lines(spark, d)))


@_query(
    "valid_metered",
    _LINES + "NOT starts_with(fare, '-') AND fare <> '0.0' AND distance <> '0.0' AND lon <> '0.0' AND lat <> '0.0'",
)
def q_valid_metered(spark, d):
    return _line_ids(valid_metered(_lines(spark, d)))


@_query(
    "valid_metered_numeric",
    _LINES
    + "CAST(fare AS DOUBLE) > 0 AND CAST(distance AS DOUBLE) > 0 AND CAST(lon AS DOUBLE) <> 0 AND CAST(lat AS DOUBLE) <> 0",
)
def q_valid_metered_numeric(spark, d):
    return _line_ids(valid_metered(_lines(spark, d), numeric=True))


@_query(
    "drop_unreasonable_numeric",
    _LINES + "CAST(passengers AS INTEGER) <> 0 AND CAST(fare AS DOUBLE) >= 0 AND lon <> '0' AND CAST(lat AS DOUBLE) <> 0",
)
def q_drop_unreasonable_numeric(spark, d):
    return _line_ids(drop_unreasonable(_lines(spark, d), numeric=True))


@_query("located_numeric", _LINES + "CAST(lon AS DOUBLE) <> 0")
def q_located_numeric(spark, d):
    return _line_ids(located(_lines(spark, d), numeric=True))


@_query("priceable_numeric", _LINES + "CAST(fare AS DOUBLE) > 0 AND CAST(distance AS DOUBLE) > 0")
def q_priceable_numeric(spark, d):
    return _line_ids(priceable(_lines(spark, d), numeric=True))


@_query("located", _LINES + "NOT starts_with(lon, '0')")
def q_located(spark, d):
    return _line_ids(located(_lines(spark, d)))


@_query(
    "priceable",
    _LINES
    + "NOT starts_with(fare, '0') AND NOT starts_with(fare, '-') AND NOT starts_with(distance, '0') AND NOT starts_with(distance, '-')",
)
def q_priceable(spark, d):
    return _line_ids(priceable(_lines(spark, d)))


@_query(
    "valid_geo",
    f"WITH {_PINGS} SELECT event_id FROM pings WHERE lon < 0 AND lat > 0 AND passenger_count > 0 AND fare_amount > 0",
)
def q_valid_geo(spark, d):
    return valid_geo(pings(spark, d)).select("event_id")


@_query(
    "regression_input",
    f"""
WITH {_TRIPS}
SELECT taxi_type, fare_amount AS "Fare_amount", trip_distance AS "Trip_distance" FROM trips
WHERE taxi_type IN ('green', 'yellow') AND pickup_ts BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'
  AND trip_distance > 1 AND fare_amount > 1""",
)
def q_regression_input(spark, d):
    return regression_input(trips(spark, d), datetime(1997, 1, 1), datetime(1997, 12, 31))


@_query(
    "in_period",
    "SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20 12:00:00'",
)
def q_in_period(spark, d):
    events = _table(spark, d, "events")
    return in_period(events, datetime(2024, 1, 10), datetime(2024, 1, 20, 12), "ts").select("event_id")


@_query(
    "one_day",
    "SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15' AND event_type IN ('click', 'view')",
)
def q_one_day(spark, d):
    day = one_day(_table(spark, d, "events"), date(2024, 1, 15), "ts")
    return metered_only(day, ["click", "view"], "event_type").select("event_id", "event_type")


@_query(
    "unknown_zone",
    """
SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE NOT contains(n_name, '_1') AND NOT contains(c_mktsegment, 'MACH')""",
)
def q_unknown_zone(spark, d):
    customer, nation = _table(spark, d, "customer"), _table(spark, d, "nation")
    homes = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return drop_unknown_zone(homes, "n_name", "c_mktsegment", ["_1"], ["MACH"]).select("c_custkey", "n_name")


@_query(
    "require",
    """
SELECT o_orderkey, lab FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS lab FROM orders)
WHERE lab IS NOT NULL""",
)
def q_require(spark, d):
    lab = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("lab")
    return require(_table(spark, d, "orders").select("o_orderkey", lab), ["lab"])


@_query(
    "shift_year",
    "SELECT o_orderkey, regexp_replace(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '^1997', '1998') AS pickup_datetime FROM orders",
)
def q_shift_year(spark, d):
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("pickup_datetime")
    return shift_year(_table(spark, d, "orders").select("o_orderkey", text), "1997", "1998")


@_query(
    "safe_casts",
    """
WITH t AS (
  SELECT o_orderkey,
    CASE o_orderstatus WHEN 'F' THEN '' WHEN 'P' THEN 'abc' ELSE CAST(o_totalprice AS VARCHAR) END AS number,
    CASE o_orderpriority WHEN '5-LOW' THEN 'never' WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.0')
      WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M') || ':00'
      ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS moment
  FROM orders)
SELECT o_orderkey, CAST(trunc(TRY_CAST(number AS DOUBLE)) AS INTEGER) AS whole,
  TRY_CAST(number AS DOUBLE) AS price, TRY_CAST(moment AS TIMESTAMP) AS ts
FROM t""",
)
def q_safe_casts(spark, d):
    number = F.expr("CASE o_orderstatus WHEN 'F' THEN '' WHEN 'P' THEN 'abc' ELSE cast(o_totalprice AS string) END")
    priority, text = F.col("o_orderpriority"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    moment = (
        F.when(priority == "5-LOW", "never")
        .when(priority == "1-URGENT", F.concat(text, F.lit(".0")))
        .when(priority == "2-HIGH", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm"))
        .otherwise(text)
    )
    return _table(spark, d, "orders").select(
        "o_orderkey", to_int(number).alias("whole"), to_double(number).alias("price"), parse_ts(moment).alias("ts")
    )


@_query("weekday_true", "SELECT event_id, dayname(ts) AS dow FROM events")
def q_weekday_true(spark, d):
    return _table(spark, d, "events").select("event_id", weekday_name(F.col("ts")).alias("dow"))


@_query(
    "weekday_legacy",
    "SELECT event_id, dayname(make_date(year(ts), 1, day(ts))) AS dow FROM events",
)
def q_weekday_legacy(spark, d):
    return _table(spark, d, "events").select("event_id", weekday_name(F.col("ts"), legacy=True).alias("dow"))


@_query(
    "bucket_ts",
    """
SELECT event_id, time_bucket(INTERVAL 10 MINUTE, ts) AS bucket,
  substr(strftime(ts, '%Y-%m-%d %H:%M'), 1, 15) AS key15 FROM events""",
)
def q_bucket_ts(spark, d):
    ts = F.col("ts")
    return _table(spark, d, "events").select(
        "event_id", bucket_ts(ts).alias("bucket"), bucket_key15(ts).alias("key15")
    )


@_query(
    "calendar_parts",
    """
SELECT o_orderkey, date_trunc('day', o_orderdate) AS midnight, strftime(o_orderdate, '%Y-%m-%d') AS day_key,
  CAST(month(o_orderdate) AS INTEGER) AS "Month", CAST(day(o_orderdate) AS INTEGER) AS "Day",
  dayname(o_orderdate) AS "DOW"
FROM orders""",
)
def q_calendar_parts(spark, d):
    ts = F.col("o_orderdate")
    days = _table(spark, d, "orders").select("o_orderkey", day_of(ts).alias("midnight"), day_key(ts).alias("day_key"))
    return calendar_parts(days, "midnight")


@_query(
    "heat_parts",
    """
SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
  dayname(ts) AS dow, strftime(ts, '%H') AS hour, substr(strftime(ts, '%M'), 1, 1) AS ten,
  substr(strftime(ts, '%M'), 1, 1) || '0' AS ten_mins
FROM events""",
)
def q_heat_parts(spark, d):
    return heat_parts(_table(spark, d, "events").select("event_id", "ts"), "ts").drop("ts")


@_query(
    "month_parts",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS year_month_day, strftime(o_orderdate, '%Y') AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month, strftime(o_orderdate, '%Y-%m') || '-00' AS label
FROM orders""",
)
def q_month_parts(spark, d):
    key = month_key(F.col("o_orderdate")).alias("year_month_day")
    keyed = month_parts(_table(spark, d, "orders").select("o_orderkey", key))
    return keyed.withColumn("label", month_label(F.col("year_month_day")))


# --- sources and sinks --------------------------------------------------------------


@_query("pairs_roundtrip", 'SELECT l_extendedprice AS "Fare_amount", l_quantity AS "Trip_distance" FROM lineitem')
def q_pairs_roundtrip(spark, d):
    path = scratch_path(spark, "pairs")
    write_pairs_csv(_table(spark, d, "lineitem"), path, "l_extendedprice", "l_quantity")
    return read_pairs_csv(spark, path, "Fare_amount", "Trip_distance")


@_query(
    "csv_roundtrip",
    "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey, CAST(s_acctbal AS VARCHAR) AS s_acctbal FROM supplier",
)
def q_csv_roundtrip(spark, d):
    path = scratch_path(spark, "suppliers")
    _table(spark, d, "supplier").write.option("header", True).csv(path)
    return read_trips_csv(spark, path)


@_query(
    "parquet_roundtrip",
    f"""
WITH {_TRIPS}
SELECT pickup_ts AS "Pickup_datetime", location_id AS "locationID", passenger_count AS "Passenger_count",
  trip_distance AS "Trip_distance", fare_amount AS "Fare_amount", l_orderkey, taxi_type,
  CAST(year(pickup_ts) AS INTEGER) AS year
FROM trips""",
)
def q_parquet_roundtrip(spark, d):
    path = scratch_path(spark, "total")
    write_table(jobs.with_year(trips(spark, d)), path, partition_by=["taxi_type", "year"], compact=True)
    return read_table(spark, path)


def _read_once(spark: SparkSession, name: str) -> DataFrame:
    """An external table as a DataFrame, and its name out of the catalog again; the files stay."""
    df = read_warehouse(spark, name)
    spark.sql(f"DROP TABLE {name}")
    return df


@_query("table_publish", _DAILY_SQL)
def q_table_publish(spark, d):
    path = scratch_path(spark, "daily")
    name = f"daily_{path.split('/')[-2]}"
    write_table(jobs.daily_counts(enrich_zone(trips(spark, d), zones(spark, d))), path, compact=True)
    publish_table(spark, name, DAILY, path)
    return _read_once(spark, name)


@_query("map_publish", _MONTH_MAP_SQL)
def q_map_publish(spark, d):
    path = scratch_path(spark, "map")
    name = f"map_{path.split('/')[-2]}"
    write_table(jobs.month_map(pings(spark, d), datetime(2024, 1, 5), datetime(2024, 1, 15)), path, compact=True)
    publish_table(spark, name, MONTH_MAP, path)
    return _read_once(spark, name)


@_query("warehouse_roundtrip", _DAILY_SQL)
def q_warehouse_roundtrip(spark, d):
    path = scratch_path(spark, "daily")
    name = f"daily_{path.split('/')[-2]}"
    daily = jobs.daily_counts(enrich_zone(trips(spark, d), zones(spark, d)))
    write_warehouse(daily, name, path=path)
    return _read_once(spark, name)


# A built-in source in a connector's place: it is named by format, takes the table as an option and writes no catalog.
@_query("warehouse_connector", _DAILY_SQL)
def q_warehouse_connector(spark, d):
    path = scratch_path(spark, "daily")
    daily = jobs.daily_counts(enrich_zone(trips(spark, d), zones(spark, d)))
    write_warehouse(daily, "daily_business", fmt="orc", connector=True, path=path)
    return read_warehouse(spark, "daily_business", fmt="orc", path=path)


@_query(
    "preview",
    """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50""",
)
def q_preview(spark, d):
    orders = _table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return preview(orders, 50, [F.col("o_totalprice").desc(), "o_orderkey"])


@_query(
    "hash_sample",
    "SELECT o_orderkey FROM orders WHERE ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT < 0.1 * 4294967296",
)
def q_hash_sample(spark, d):
    return hash_sample(_table(spark, d, "orders"), "o_orderkey", fraction=0.1).select("o_orderkey")


_EDGES = {"none": 0.0, "one": 2.0**-32, "tenth": 0.1, "below_one": 1 - 2.0**-33, "nearly": 0.9999999999, "all": 1.0}


@_query(
    "hash_sample_edges",
    " UNION ALL ".join(
        f"SELECT '{name}' AS share, o_orderkey FROM orders "
        f"WHERE ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT < {round(fraction * 2**32)}"
        for name, fraction in _EDGES.items()
    ),
)
def q_hash_sample_edges(spark, d):
    orders = _table(spark, d, "orders").select("o_orderkey")
    parts = [tag(hash_sample(orders, "o_orderkey", fraction=f), share=name) for name, f in _EDGES.items()]
    return union_all(parts, fold_case=False)


# Which rows a Bernoulli sample takes depends on the partitions; what SQL can state are its properties.
@_query(
    "bernoulli_sample",
    "SELECT count(*) AS total, true AS subset, true AS no_repeats, true AS share_within FROM orders",
)
def q_bernoulli_sample(spark, d):
    orders = _table(spark, d, "orders").select("o_orderkey")
    drawn = stored(sample_rows(orders, 0.1, 30), "drawn").groupBy(F.col("o_orderkey").alias("key")).agg(F.count("*").alias("n"))
    both = orders.join(drawn, F.col("o_orderkey") == F.col("key"), "full")
    share = F.coalesce(F.sum("n"), F.lit(0)) / F.count("o_orderkey")
    return both.agg(
        F.count("o_orderkey").alias("total"),
        (F.count_if(F.col("o_orderkey").isNull()) == 0).alias("subset"),
        (F.coalesce(F.max("n"), F.lit(1)) == 1).alias("no_repeats"),
        share.between(0.05, 0.15).alias("share_within"),
    )


# --- statistics and regression ------------------------------------------------------

_RANKED = f"""
WITH {_TRIPS}, r AS (
  SELECT fare_amount AS y, trip_distance AS x1, passenger_count AS x2,
    rank() OVER (ORDER BY fare_amount) + (count(*) OVER (PARTITION BY fare_amount) - 1) / 2.0 AS ry,
    rank() OVER (ORDER BY trip_distance) + (count(*) OVER (PARTITION BY trip_distance) - 1) / 2.0 AS r1,
    rank() OVER (ORDER BY passenger_count) + (count(*) OVER (PARTITION BY passenger_count) - 1) / 2.0 AS r2
  FROM trips)
"""


@_query(
    "pearson",
    f"""
WITH {_TRIPS}
SELECT 'Fare_amount' AS label, 'Trip_distance' AS feature, 'pearson' AS method, count(*) AS n,
  {_round('corr(fare_amount, trip_distance)', 6)} AS correlation FROM trips""",
)
def q_pearson(spark, d):
    found = correlate(trips(spark, d), "Fare_amount", "Trip_distance")
    return _rounded(found, "correlation", places=6)


@_query(
    "spearman",
    _RANKED
    + f"""SELECT 'Fare_amount' AS label, 'Trip_distance' AS feature, 'spearman' AS method, count(*) AS n,
  {_round('corr(ry, r1)', 6)} AS correlation FROM r""",
)
def q_spearman(spark, d):
    found = correlate(trips(spark, d), "Fare_amount", "Trip_distance", "spearman")
    return _rounded(found, "correlation", places=6)


@_query(
    "correlation_screen",
    _RANKED
    + f"""SELECT 'Fare_amount' AS label, 'Trip_distance' AS feature, count(*) AS n,
  {_round('corr(y, x1)', 6)} AS pearson, {_round('corr(ry, r1)', 6)} AS spearman FROM r
UNION ALL SELECT 'Fare_amount', 'Passenger_count', count(*), {_round('corr(y, x2)', 6)}, {_round('corr(ry, r2)', 6)} FROM r""",
)
def q_correlation_screen(spark, d):
    found = correlation_screen(trips(spark, d), "Fare_amount", ["Trip_distance", "Passenger_count"])
    return _rounded(found, "pearson", "spearman", places=6)


@_query(
    "correlations",
    f"""
WITH {_PINGS}, m AS (
  SELECT * FROM pings
  WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-15' AND taxi_type IN ('green', 'yellow')
    AND lon < 0 AND lat > 0 AND passenger_count > 0 AND fare_amount > 0),
r AS (
  SELECT *,
    rank() OVER (ORDER BY fare_amount) + (count(*) OVER (PARTITION BY fare_amount) - 1) / 2.0 AS ry,
    rank() OVER (ORDER BY trip_distance) + (count(*) OVER (PARTITION BY trip_distance) - 1) / 2.0 AS rd,
    rank() OVER (ORDER BY lat) + (count(*) OVER (PARTITION BY lat) - 1) / 2.0 AS rlat,
    rank() OVER (ORDER BY lon) + (count(*) OVER (PARTITION BY lon) - 1) / 2.0 AS rlon
  FROM m)
SELECT 'Fare_amount' AS label, 'Trip_distance' AS feature, count(*) AS n,
  {_round('corr(fare_amount, trip_distance)', 6)} AS pearson, {_round('corr(ry, rd)', 6)} AS spearman FROM r
UNION ALL SELECT 'Fare_amount', 'Pickup_latitude', count(*), {_round('corr(fare_amount, lat)', 6)}, {_round('corr(ry, rlat)', 6)} FROM r
UNION ALL SELECT 'Fare_amount', 'Pickup_longitude', count(*), {_round('corr(fare_amount, lon)', 6)}, {_round('corr(ry, rlon)', 6)} FROM r""",
)
def q_correlations(spark, d):
    month = jobs.month_map(pings(spark, d), datetime(2024, 1, 5), datetime(2024, 1, 15))
    return _rounded(jobs.correlations(month), "pearson", "spearman", places=6)


def _fit_sql(source: str, key: str = "taxi_type") -> str:
    """Closed form of the elastic net (penalty 0.3, mixing 0.8) on columns x and y by key."""
    return f"""
s AS ({source}),
a AS (SELECT {key}, count(*) AS n, avg(x) AS mx, avg(y) AS my, stddev_pop(x) AS sx, stddev_pop(y) AS sy,
        corr(y, x) AS r FROM s GROUP BY {key}),
b AS (SELECT *, sign(r) * greatest(abs(r) - 0.24 / sy, 0) / (1 + 0.06 / sy) * sy / sx AS slope FROM a),
c AS (SELECT *, my - slope * mx AS intercept FROM b)
SELECT c.{key}, any_value(c.n) AS n, {_round('any_value(slope)')} AS slope, {_round('any_value(intercept)')} AS intercept,
  {_round('1 - avg((y - slope * x - intercept) ** 2) / any_value(sy * sy)')} AS r2,
  {_round('sqrt(avg((y - slope * x - intercept) ** 2))')} AS rmse,
  {_round('avg(abs(y - slope * x - intercept))')} AS mae
FROM s JOIN c USING ({key}) GROUP BY c.{key}"""


_METRICS = ["slope", "intercept", "r2", "rmse", "mae"]


@_query("fit_price", f"WITH {_TRIPS}, " + _fit_sql("SELECT taxi_type, fare_amount AS y, trip_distance AS x FROM trips"))
def q_fit_price(spark, d):
    return _rounded(fit_price(trips(spark, d), by=["taxi_type"]), *_METRICS)


@_query(
    "fit_price_ml",
    f"WITH {_TRIPS}, m AS (WITH "
    + _fit_sql("SELECT 1 AS one, fare_amount AS y, trip_distance AS x FROM trips", "one")
    + ") SELECT slope, intercept, r2, rmse, mae FROM m",
)
def q_fit_price_ml(spark, d):
    rows = trips(spark, d)
    return _rounded(model_metrics(fit_price_ml(rows), rows), *_METRICS)


@_query(
    "price_regression",
    f"WITH {_TRIPS}, "
    + _fit_sql(
        """SELECT taxi_type, fare_amount AS y, trip_distance AS x FROM trips
  WHERE taxi_type IN ('green', 'yellow') AND pickup_ts BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-12-31'
    AND trip_distance > 1 AND fare_amount > 1
    AND ('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8))::BIGINT < 0.1 * 4294967296"""
    ),
)
def q_price_regression(spark, d):
    models = jobs.price_regression(
        trips(spark, d),
        datetime(1997, 1, 1),
        datetime(1999, 12, 31),
        sample_key=["l_orderkey"],
        via_csv=scratch_path(spark, "pairs"),
    )
    return _rounded(models, *_METRICS)


@_query(
    "price_regression_all",
    f"WITH {_TRIPS}, "
    + _fit_sql(
        """SELECT taxi_type, fare_amount AS y, trip_distance AS x FROM trips
  WHERE taxi_type IN ('green', 'yellow') AND pickup_ts BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-12-31'
    AND trip_distance > 1 AND fare_amount > 1"""
    ),
)
def q_price_regression_all(spark, d):
    models = jobs.price_regression(trips(spark, d), datetime(1997, 1, 1), datetime(1999, 12, 31), fraction=None)
    return _rounded(models, *_METRICS)


# The default draw depends on the partitions; SQL can state that its models are near those of all rows.
@_query(
    "price_regression_drawn",
    """
SELECT DISTINCT taxi_type, true AS share_within, true AS rmse_near
FROM (SELECT CASE o_orderstatus WHEN 'F' THEN 'green' ELSE 'yellow' END AS taxi_type FROM orders WHERE o_orderstatus IN ('F', 'O'))""",
)
def q_price_regression_drawn(spark, d):
    period = datetime(1992, 1, 1), datetime(1999, 12, 31)
    drawn = jobs.price_regression(trips(spark, d), *period)
    whole = jobs.price_regression(trips(spark, d), *period, fraction=None)
    both = drawn.select("taxi_type", F.col("n").alias("few"), F.col("rmse").alias("near")).join(whole, "taxi_type")
    return both.select(
        "taxi_type",
        (F.col("few") / F.col("n")).between(0.05, 0.15).alias("share_within"),
        (F.col("near") / F.col("rmse")).between(0.8, 1.25).alias("rmse_near"),
    )


@_query(
    "warehouse_regression",
    f"WITH {_PINGS}, "
    + _fit_sql(
        """SELECT CASE taxi_type WHEN 'green' THEN 'Green' ELSE 'Yellow' END AS taxi_type, fare_amount AS y, trip_distance AS x
  FROM pings WHERE taxi_type IN ('green', 'yellow') AND fare_amount >= 1 AND trip_distance >= 1"""
    ),
)
def q_warehouse_regression(spark, d):
    green, yellow = (jobs.clean_metered({2018: _warehouse_pings(spark, d, t)}, t) for t in ("green", "yellow"))
    return _rounded(jobs.warehouse_regression(green, yellow), *_METRICS)


# --- training-data operators ---------------------------------------------------------


def _add_llm() -> None:
    """Add the training-data queries where their subpackage and all it needs can be imported; else say what is missing."""
    try:
        import corpus_pipeline
        from tripflow.llm import queries as llm
    except ImportError as missing:
        warnings.warn(f"without the training-data queries: {missing}", stacklevel=2)
        return
    QUERIES.update(llm.QUERIES)
    ORACLE.update(llm.ORACLE)
    QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL


_add_llm()


# --- contract -----------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: daily trips by borough and taxi type."""
    return q_daily_business(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
