"""Table schemas and the per-year layouts of the raw trip files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import DataType, DoubleType, IntegerType, LongType, StringType, StructType, TimestampType

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "timestamp": TimestampType(),
}


def _table(columns: str) -> StructType:
    """A schema from ``name type, name type``; needs no session, unlike a DDL parse."""
    schema = StructType()
    for column in columns.split(", "):
        name, kind = column.split(" ")
        schema = schema.add(name, _TYPES[kind])
    return schema


# --- fixed values: column names and types of the published tables -------------------

CANONICAL = [
    "Pickup_date",
    "Pickup_longitude",
    "Pickup_latitude",
    "Passenger_count",
    "Trip_distance",
    "Fare_amount",
    "City",
    "taxi_type",
    "locationID",
]

TOTAL = _table(
    "Pickup_datetime timestamp, locationID int, City string, taxi_type string, "
    "Pickup_longitude double, Pickup_latitude double, Passenger_count int, "
    "Trip_distance double, Fare_amount double, borough string, Count int"
)

DAILY = _table(
    "Pickup_DateDay timestamp, borough string, taxi_type string, Count int, "
    "Month int, Day int, DOW string"
)

MONTH_MAP = _table(
    "City string, taxi_type string, Pickup_longitude double, Pickup_latitude double, "
    "Passenger_count int, Trip_distance double, Fare_amount double, Count int, "
    "Pickup_DataTimeTenMins timestamp"
)

MONTHLY = _table(
    "year_month_day string, zone_name string, count bigint, taxi_type string, "
    "year string, month int, year_month_day_new string"
)

HEAT = _table(
    "vendor_id string, pickup_datetime string, pickup_longitude string, "
    "pickup_latitude string, year string, month string, day string, dow string, "
    "hour string, ten_mins string, taxi_type string, Count int, City string"
)

PRICES = _table(
    "pickup_datetime string, borough string, taxi_type string, "
    "fare_amount_avg double, trip_distance_avg double"
)

ZONES = _table("zone_id string, borough string")

CITY = "New York"
BOROUGHS = ["EWR", "Bronx", "Queens", "Brooklyn", "Manhattan", "Staten Island"]
METERED = ["green", "yellow"]


# --- raw files ----------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Where one type and year keeps the canonical fields.

    Names are folded (trimmed, lower case), so blank-padded and re-cased headers need
    no entry of their own. ``None`` means the files do not carry the field.
    """

    pickup: str
    lon: str | None = None
    lat: str | None = None
    passengers: str | None = None
    distance: str | None = None
    fare: str | None = None
    location: str | None = None
    guard: str = "contains"

    def sources(self) -> dict[str, str | None]:
        return {
            "Pickup_date": self.pickup,
            "Pickup_longitude": self.lon,
            "Pickup_latitude": self.lat,
            "Passenger_count": self.passengers,
            "Trip_distance": self.distance,
            "Fare_amount": self.fare,
            "locationID": self.location,
        }


_MEASURES = {"passengers": "passenger_count", "distance": "trip_distance", "fare": "fare_amount"}
_COORDS = {"lon": "pickup_longitude", "lat": "pickup_latitude"}
_ZONE = {"location": "pulocationid"}

# Fixed values: (taxi type, first year, last year, layout).
_RANGES = [
    ("fhv", 2015, 2016, Layout("pickup_date", location="locationid")),
    ("fhv", 2017, 2017, Layout("pickup_datetime", **_ZONE)),
    ("fhvhv", 2019, 2019, Layout("pickup_datetime", guard="prefix", **_ZONE)),
    ("green", 2013, 2016, Layout("lpep_pickup_datetime", **_COORDS, **_MEASURES)),
    ("green", 2017, 2019, Layout("lpep_pickup_datetime", **_ZONE, **_MEASURES)),
    (
        "yellow",
        2009,
        2009,
        Layout(
            "trip_pickup_datetime",
            lon="start_lon",
            lat="start_lat",
            passengers="passenger_count",
            distance="trip_distance",
            fare="fare_amt",
        ),
    ),
    ("yellow", 2010, 2014, Layout("pickup_datetime", **_COORDS, **_MEASURES)),
    ("yellow", 2015, 2016, Layout("tpep_pickup_datetime", **_COORDS, **_MEASURES)),
    ("yellow", 2017, 2019, Layout("tpep_pickup_datetime", **_ZONE, **_MEASURES)),
]

LAYOUTS: dict[tuple[str, int], Layout] = {
    (taxi_type, year): layout
    for taxi_type, first, last, layout in _RANGES
    for year in range(first, last + 1)
}


def layout_for(taxi_type: str, year: int) -> Layout:
    try:
        return LAYOUTS[(taxi_type, year)]
    except KeyError:
        raise ValueError(f"no raw layout known for {taxi_type} {year}") from None
