"""The composite jobs: from raw or warehouse tables to the tables analysts use.

Each job returns a lazy DataFrame; writing is left to ``sources.writers``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripflow.functions.timeparts import bucket_ts, heat_parts, month_key, shift_year
from tripflow.operators.aggregate import bucket_prices, daily_business, monthly_business
from tripflow.operators.align import align_year, project_fhv, project_metered, tag, union_all
from tripflow.operators.clean import (
    drop_unknown_zone,
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
from tripflow.operators.regress import fit_price
from tripflow.operators.sample import hash_sample, sample_rows
from tripflow.operators.stats import correlation_screen
from tripflow.sources.readers import read_pairs_csv, read_trips_csv
from tripflow.sources.schemas import CITY, HEAT, METERED, MONTH_MAP, layout_for
from tripflow.sources.writers import stored, write_pairs_csv

# The periods and labels of the published tables.
MAP_PERIOD = (datetime(2015, 12, 1), datetime(2016, 1, 1))
REGRESSION_PERIOD = (datetime(2019, 1, 1), datetime(2019, 12, 31))
HEAT_DAY = date(2016, 3, 31)
WAREHOUSE_TYPES = {"fhv": "FHV", "green": "Green", "yellow": "Yellow"}


def unify_trips(
    spark: SparkSession,
    paths: Mapping[tuple[str, int], str | Sequence[str]],
    zones: DataFrame,
    dedup_dim: bool = True,
    schemas: Mapping[tuple[str, int], StructType] | None = None,
) -> DataFrame:
    """Raw files by (taxi type, year) as the one typed fact table.

    ``schemas`` declares the header of a (type, year), whose files are then not looked at
    before the scan; a file with another header fails it.
    """
    schemas = schemas or {}
    frames = {key: read_trips_csv(spark, path, schemas.get(key)) for key, path in paths.items()}
    return unify_frames(frames, zones, dedup_dim)


def unify_frames(
    frames: Mapping[tuple[str, int], DataFrame], zones: DataFrame, dedup_dim: bool = True
) -> DataFrame:
    """As ``unify_trips`` for raw tables read already."""
    aligned = []
    for (taxi_type, year), df in frames.items():
        trips = year_guard(align_year(df, taxi_type, year), year, mode=layout_for(taxi_type, year).guard)
        # Hired vehicles without a zone say nothing; metered ones may have coordinates.
        aligned.append(trips if taxi_type in METERED else require(trips, ["locationID"]))
    return type_fact(enrich_zone(union_all(aligned, fold_case=False), zones, dedup_dim=dedup_dim))


def with_year(total: DataFrame) -> DataFrame:
    """The fact table with a ``year`` column to partition it by when written."""
    return total.withColumn("year", F.year("Pickup_datetime"))


def _years_of(total: DataFrame, lo: date, hi: date) -> DataFrame:
    """Limits a fact table partitioned by ``with_year`` to the folders a period can touch.

    A day on either side allows for a session time zone other than the writer's.
    """
    if "year" not in total.columns:
        return total
    day = timedelta(days=1)
    return total.where(F.col("year").between((lo - day).year, (hi + day).year))


def daily_counts(total: DataFrame, legacy_dow: bool = False, count_type: str = "int") -> DataFrame:
    """Business per day, borough and taxi type."""
    return daily_business(total, legacy_dow=legacy_dow, count_type=count_type)


def month_map(
    total: DataFrame,
    lo: datetime | date = MAP_PERIOD[0],
    hi: datetime | date = MAP_PERIOD[1],
    types: Sequence[str] = METERED,
    minutes: int = 10,
) -> DataFrame:
    """Positions and prices of metered trips of a period, by ten minutes, for a map."""
    trips = valid_geo(metered_only(in_period(_years_of(total, lo, hi), lo, hi), types))
    start = bucket_ts(F.col("Pickup_datetime"), minutes)
    return trips.withColumn("Pickup_DataTimeTenMins", start).select(*MONTH_MAP.fieldNames())


def correlations(
    month: DataFrame,
    label: str = "Fare_amount",
    features: Sequence[str] = ("Trip_distance", "Pickup_latitude", "Pickup_longitude"),
) -> DataFrame:
    """Which measures go with the fare."""
    return correlation_screen(month, label, features)


def price_regression(
    total: DataFrame,
    lo: datetime | date = REGRESSION_PERIOD[0],
    hi: datetime | date = REGRESSION_PERIOD[1],
    types: Sequence[str] = METERED,
    fraction: float | None = 0.1,
    seed: int = 30,
    sample_key: Sequence[str] = (),
    via_csv: str | None = None,
) -> DataFrame:
    """Fare on distance, one model per taxi type.

    The sample is Bernoulli unless ``sample_key`` names columns to hash; ``fraction=None``
    uses all rows. A Bernoulli draw is stored before the fit, which reads its rows twice and
    must see the same ones. ``via_csv`` writes the pairs below that folder in one pass, a
    folder per type, and fits on what is read back.
    """
    trips = regression_input(_years_of(total, lo, hi), lo, hi, types, keep=sample_key)
    drawn = fraction is not None and not sample_key
    if fraction is not None:
        trips = sample_rows(trips, fraction, seed) if drawn else hash_sample(trips, *sample_key, fraction=fraction)
    if via_csv:
        write_pairs_csv(trips, via_csv, "Fare_amount", "Trip_distance", partition_by=["taxi_type"])
        trips = read_pairs_csv(trips.sparkSession, via_csv, "Fare_amount", "Trip_distance", ["taxi_type"])
    elif drawn:
        trips = stored(trips, "sample")
    return fit_price(trips, by=["taxi_type"])


# --- warehouse side -----------------------------------------------------------------


def clean_metered(
    frames: Mapping[int, DataFrame], taxi_type: str, legacy: bool = False, numeric: bool = False
) -> DataFrame:
    """Valid green or yellow trips of several years as text, or with ``numeric`` typed.

    Coordinates are required of the years that record them. ``legacy`` requires them of
    2017 as well, which records none, and so drops that year. Typed tests reach the scan.
    """
    parts = []
    for year, df in frames.items():
        coords = layout_for(taxi_type, year).lon is not None or (legacy and year == 2017)
        parts.append(valid_metered(project_metered(df, numeric), coords=coords, numeric=numeric))
    return union_all(parts, fold_case=False)


def clean_fhv(frames: Mapping[int, DataFrame], year: str | None = None) -> DataFrame:
    """Hired-vehicle trips of several years, or of one, with a known zone."""
    if year:
        # On a timestamp the year is a range a scan can use.
        frames = {
            y: year_guard(df, int(year), "pickup_datetime", "prefix" if _is_text(df, "pickup_datetime") else "range")
            for y, df in frames.items()
        }
    trips = union_all([project_fhv(df) for df in frames.values()], fold_case=False)
    trips = require(trips, ["location_id", "pickup_datetime", "borough", "zone", "service_zone"])
    return drop_unknown_zone(trips)


def _is_text(df: DataFrame, col: str) -> bool:
    return dict(df.dtypes)[col] == "string"


def zoned(trips: DataFrame, zones: DataFrame, key: str, dedup_dim: bool = True) -> DataFrame:
    """Trips of known zones with zone name and borough."""
    trips = trips.drop("borough")
    return enrich_zone(trips, zones, key, "inner", columns=("zone_name", "borough"), dedup_dim=dedup_dim)


def monthly_zone_counts(
    fhv: Mapping[int, DataFrame],
    green: Mapping[int, DataFrame],
    yellow: Mapping[int, DataFrame],
    zones: DataFrame,
    *,
    fhv_year: str | None,
    relabel_fhv_to: str | None,
    legacy: bool = False,
    dedup_dim: bool = True,
    numeric: bool = False,
) -> DataFrame:
    """Trips per month, zone and taxi type over three warehouse families.

    Hired-vehicle data end a year before the metered ones. Whether one year alone is kept
    (``fhv_year``) and shown as another (``relabel_fhv_to``) is for the caller to say; ``None``
    for the first keeps all years, for the second shows them as they are.
    """
    if relabel_fhv_to is not None and fhv_year is None:
        raise ValueError("relabel_fhv_to shows one year as another: name it as fhv_year")
    hired = clean_fhv(fhv, fhv_year)
    if relabel_fhv_to is not None:
        hired = shift_year(hired, fhv_year, relabel_fhv_to)
    families = {
        "fhv": (hired, "location_id"),
        "green": (clean_metered(green, "green", legacy, numeric), "pickup_location_id"),
        "yellow": (clean_metered(yellow, "yellow", legacy, numeric), "pickup_location_id"),
    }
    # Unions of the few needed columns come first, so one join and one aggregation do.
    month = month_key(F.col("pickup_datetime")).alias("pickup_datetime")
    trips = union_all(
        [
            tag(df.select(F.col(key).alias("zone"), month), taxi_type=WAREHOUSE_TYPES[t])
            for t, (df, key) in families.items()
        ],
        fold_case=False,
    )
    named = enrich_zone(trips, zones, "zone", "inner", columns=("zone_name",), dedup_dim=dedup_dim)
    return monthly_business(named)


def heat_one_day(
    green: DataFrame, yellow: DataFrame, day: date = HEAT_DAY, legacy_dow: bool = False
) -> DataFrame:
    """Positions of one day's metered trips with clock parts, for a heat map."""
    parts = [
        tag(_heat_slice(df, day), taxi_type=WAREHOUSE_TYPES[t]) for t, df in (("green", green), ("yellow", yellow))
    ]
    trips = heat_parts(union_all(parts, fold_case=False), legacy_dow=legacy_dow)
    return tag(trips, Count=1, City=CITY).select(*HEAT.fieldNames())


def _heat_slice(df: DataFrame, day: date) -> DataFrame:
    # The day filter sits on the source's own column type, where a scan can use it.
    return located(project_metered(one_day(df, day)))


def warehouse_regression(green: DataFrame, yellow: DataFrame, numeric: bool = False) -> DataFrame:
    """Fare on distance of cleaned warehouse trips, one model per type.

    Both types come in by the same definition: cleaned, with a usable price.
    """
    return fit_price(_priced(green, yellow, numeric), "fare_amount", "trip_distance", by=["taxi_type"])


def _priced(green: DataFrame, yellow: DataFrame, numeric: bool) -> DataFrame:
    parts = [
        tag(priceable(df, numeric=numeric), taxi_type=WAREHOUSE_TYPES[t])
        for t, df in (("green", green), ("yellow", yellow))
    ]
    return union_all(parts, fold_case=False)


def borough_prices(
    green: DataFrame, yellow: DataFrame, zones: DataFrame, numeric: bool = False, dedup_dim: bool = True
) -> DataFrame:
    """Mean fare and distance per ten minutes, borough and type of cleaned trips."""
    trips = zoned(_priced(green, yellow, numeric), zones, "pickup_location_id", dedup_dim)
    return bucket_prices(trips)
