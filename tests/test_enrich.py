import pytest
from pyspark.sql import functions as F

from tests.plans import SMALL_SKEW, final_plan, plan, settings
from tripflow.operators.enrich import enrich_zone, fits_broadcast


@pytest.fixture(scope="module")
def zones(spark):
    rows = [("3", "Bronx"), ("56", "Queens"), ("56", "Queens")] + [("103", "Manhattan")] * 3
    return spark.createDataFrame(rows, "zone_id string, borough string")


@pytest.fixture(scope="module")
def trips(spark):
    return spark.createDataFrame([("56",), ("103",), ("57",), ("3",), (None,)], "locationID string")


def test_left_join_keeps_unknown_zones(trips, zones, rows):
    got = rows(enrich_zone(trips, zones).select("borough"))
    assert got == sorted([("Queens",), ("Manhattan",), (None,), ("Bronx",), (None,)], key=str)


def test_repeated_keys_multiply_only_on_request(trips, zones):
    counts = enrich_zone(trips, zones, dedup_dim=False).groupBy("borough").count()
    assert {r["borough"]: r["count"] for r in counts.collect()} == {"Queens": 2, "Manhattan": 3, None: 2, "Bronx": 1}


def test_inner_join(trips, zones, rows):
    got = rows(enrich_zone(trips, zones, how="inner"))
    assert got == sorted([("56", "Queens"), ("103", "Manhattan"), ("3", "Bronx")], key=str)
    with pytest.raises(ValueError):
        enrich_zone(trips, zones, how="full")


def test_key_types_may_differ(spark, zones, rows):
    trips = spark.createDataFrame([(3,), (4,)], "locationID int")
    bad = zones.union(spark.createDataFrame([("n/a", "?")], zones.schema))
    assert rows(enrich_zone(trips, bad)) == [(3, "Bronx"), (4, None)]


def test_differing_copies_resolve_the_same_way_every_run(spark, trips):
    zones = spark.createDataFrame([("56", "Queens"), ("56", None), ("56", "Bronx")], "zone_id string, borough string")
    for n in (1, 2, 3):
        got = enrich_zone(trips.where("locationID = '56'"), zones.repartition(n)).first()["borough"]
        assert got == "Queens"


def test_size_check(zones, spark):
    assert fits_broadcast(zones)
    assert not fits_broadcast(zones, max_bytes=100)
    assert fits_broadcast(zones.where("false"))


def test_small_dimension_leaves_trips_unshuffled(spark, data):
    trips = spark.read.parquet(f"{data}/orders.parquet").withColumn("locationID", (F.col("o_custkey") % 25).cast("int"))
    zones = spark.read.parquet(f"{data}/nation.parquet").selectExpr("n_nationkey AS zone_id", "n_name AS borough")
    text = plan(enrich_zone(trips, zones, dedup_dim=False))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "Arguments: hashpartitioning" not in text


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_zone_of_a_large_dimension_is_split(spark, how):
    """A third of all trips in one zone, a third without zone, dimension beyond the bound."""
    trips = spark.range(0, 300_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 3000).cast("int").alias("locationID"),
        F.rand(1).alias("fare"),
    )
    zones = spark.range(4000).select((F.col("id") % 2000).cast("int").alias("zone_id"), F.lit("Bronx").alias("borough"))
    want = enrich_zone(trips, zones, how=how).groupBy("locationID", "borough").count()
    with settings(spark, SMALL_SKEW):
        got = enrich_zone(trips, zones, how=how, max_broadcast_bytes=0)
        text = final_plan(got.groupBy("borough").agg(F.sum("fare")))
        assert "SortMergeJoin(skew=true)" in text
        counts = got.groupBy("locationID", "borough").count()
        assert counts.exceptAll(want).count() == 0 and want.exceptAll(counts).count() == 0
