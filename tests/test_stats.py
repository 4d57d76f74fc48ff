import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.plans import SMALL_SKEW, final_plan, settings
from tripflow.operators import stats
from tripflow.operators.regress import fit_price, fit_price_ml, model_metrics
from tripflow.operators.sample import hash_sample, sample_rows
from tripflow.operators.stats import _spearman, correlate, correlation_screen


def average_rank_correlation(frame, a, b):
    """Brute force: Pearson of the average ranks of complete pairs."""
    pairs = frame[[a, b]].dropna()
    return pairs[a].rank().corr(pairs[b].rank())


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(5)
    n = 4000
    x = rng.gamma(2.0, 3.0, n).round(1)
    frame = pd.DataFrame(
        {
            "Fare_amount": (2.5 + 2.6 * x + rng.normal(0, 3, n)).round(2),
            "Trip_distance": x,
            # One value holds well over a third of the rows.
            "Passenger_count": np.where(rng.random(n) < 0.6, 1, rng.integers(2, 7, n)),
            "Pickup_latitude": rng.normal(40.7, 0.1, n),
            "taxi_type": rng.choice(["green", "yellow", "fhv"], n),
        }
    )
    frame.loc[rng.random(n) < 0.05, "Trip_distance"] = np.nan
    frame.loc[rng.random(n) < 0.05, "Fare_amount"] = np.nan
    return frame


@pytest.fixture(scope="module")
def trips(spark, frame):
    df = spark.createDataFrame(frame)
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if t == "double" else c for c, t in df.dtypes]).repartition(7)


def test_pearson_and_spearman_match_brute_force(trips, frame):
    features = ["Trip_distance", "Passenger_count", "Pickup_latitude"]
    got = {r["feature"]: r for r in correlation_screen(trips, "Fare_amount", features).collect()}
    assert set(got) == set(features)
    for f in features:
        pairs = frame[["Fare_amount", f]].dropna()
        assert got[f]["n"] == len(pairs)
        assert got[f]["pearson"] == pytest.approx(pairs["Fare_amount"].corr(pairs[f]), abs=1e-12)
        assert got[f]["spearman"] == pytest.approx(average_rank_correlation(frame, "Fare_amount", f), abs=1e-12)


def test_spearman_is_the_same_for_any_partitioning(spark, trips, frame):
    want = average_rank_correlation(frame, "Fare_amount", "Trip_distance")
    for shuffle in ("1", "3", "61"):
        with settings(spark, {**SMALL_SKEW, "spark.sql.shuffle.partitions": shuffle}):
            row = correlate(trips, "Fare_amount", "Trip_distance", "spearman").first()
        assert row["correlation"] == pytest.approx(want, abs=1e-12)


def test_spearman_ignores_monotone_maps_and_sees_sign(trips):
    mapped = trips.withColumns({"e": F.exp(F.col("Trip_distance") / 10), "m": -F.col("Trip_distance")})
    got = {r["feature"]: r["spearman"] for r in correlation_screen(mapped, "Fare_amount", ["Trip_distance", "e", "m"]).collect()}
    assert got["e"] == pytest.approx(got["Trip_distance"], abs=1e-12)
    assert got["m"] == pytest.approx(-got["Trip_distance"], abs=1e-12)


def test_correlation_edge_cases(spark):
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 4.0)], "a double, b double")
    row = correlate(flat, "a", "b", "spearman").first()
    assert row["n"] == 2 and row["correlation"] is None
    with pytest.raises(ValueError):
        correlate(flat, "a", "b", "kendall")


def test_screen_keeps_one_row_per_row_whatever_the_features(spark, monkeypatch):
    """Rows are not stored once more for each feature, nor the label's values."""
    kept, plain = [], stats.stored

    def counted(df, name):
        found = plain(df, name)
        kept.append(found.count())
        return found

    monkeypatch.setattr(stats, "stored", counted)
    n, cycles = 3000, (50, 7, 11)
    df = spark.range(n).select(
        ((F.col("id") * 7919) % 100_003 / 4).alias("y"), *[(F.col("id") % c).cast("double").alias(f"f{c}") for c in cycles]
    )
    assert len(correlation_screen(df, "y", [f"f{c}" for c in cycles]).collect()) == 3
    # The rows, and twice (counted, ranked) the distinct values of the features.
    assert sum(kept) == n + 2 * sum(cycles)


def test_screen_of_features_with_their_own_nulls_ties_and_offsets(spark):
    rng = np.random.default_rng(17)
    n = 6000
    frame = pd.DataFrame({"y": rng.normal(0, 1, n) + 1e8, "x": rng.normal(0, 1, n), "tied": rng.integers(0, 4, n) * 1.0})
    frame["x"] = frame["x"] + 0.5 * (frame["y"] - 1e8) - 1e8
    frame["rare"] = np.where(rng.random(n) < 0.02, rng.random(n), np.nan)
    frame["tied_nulls"] = np.where(frame["y"] > 1e8 + 0.3, np.nan, frame["tied"] + (frame["y"] > 1e8))
    frame.loc[rng.random(n) < 0.3, "y"] = 1e8 - 0.25  # one label holds a third
    frame.loc[rng.random(n) < 0.05, "y"] = np.nan
    features = ["x", "tied", "rare", "tied_nulls", "x"]
    df = spark.createDataFrame(frame)
    df = df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in df.columns])
    df = df.withColumns({"none": F.lit(None).cast("double"), "flat": F.lit(2.0)})
    ways = [{}, {**SMALL_SKEW, "spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}]
    for way in ways:
        with settings(spark, way):
            got = correlation_screen(df.repartition(5), "y", [*features, "none", "flat"]).collect()
            flat = correlation_screen(df, "flat", ["x"]).collect()
        assert sorted(r["feature"] for r in got) == sorted([*features, "none", "flat"])
        for r in got:
            if r["feature"] == "none":
                assert (r["n"], r["pearson"], r["spearman"]) == (0, None, None)
                continue
            if r["feature"] == "flat":
                assert (r["n"], r["pearson"], r["spearman"]) == (frame["y"].notna().sum(), None, None)
                continue
            pairs = frame[["y", r["feature"]]].dropna()
            centred = pairs - pairs.mean()
            assert r["n"] == len(pairs)
            assert r["pearson"] == pytest.approx(centred["y"].corr(centred[r["feature"]]), abs=1e-9)
            assert r["spearman"] == pytest.approx(average_rank_correlation(frame, "y", r["feature"]), abs=1e-12)
        assert [(r["pearson"], r["spearman"]) for r in flat] == [(None, None)]
    empty = df.where("y < 0")
    assert [r["n"] for r in correlation_screen(empty, "y", ["x", "rare"]).collect()] == [0, 0]
    assert correlate(empty, "y", "x", "spearman").collect() == []


def test_closed_form_equals_spark_ml_per_group(spark, trips):
    fitted = {r["taxi_type"]: r for r in fit_price(trips, by=["taxi_type"]).collect()}
    assert set(fitted) == {"green", "yellow", "fhv"}
    for t, row in fitted.items():
        part = trips.where(F.col("taxi_type") == t)
        want = model_metrics(fit_price_ml(part), part).first()
        for metric in ("slope", "intercept", "r2", "rmse", "mae"):
            assert row[metric] == pytest.approx(want[metric], rel=1e-6), (t, metric)
        assert row["slope"] > 2 and row["r2"] > 0.8


def test_fit_without_groups_and_by_shuffle(spark, trips, rows):
    whole = fit_price(trips).first()
    want = model_metrics(fit_price_ml(trips), trips).first()
    assert whole["mae"] == pytest.approx(want["mae"], rel=1e-6)
    assert whole["n"] == trips.dropna(subset=["Fare_amount", "Trip_distance"]).count()

    def fitted():
        return fit_price(trips, by=["taxi_type"]).select("taxi_type", *[F.round(c, 9) for c in ("slope", "mae")])

    near = rows(fitted())
    assert "BroadcastHashJoin" in final_plan(fitted())
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        assert rows(fitted()) == near


def test_hot_group_is_split_when_models_are_joined_by_shuffle(spark):
    """A third of the rows is one group, the others are thousands."""
    n = 120_000
    df = spark.range(0, n, 1, 16).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 5000 END AS k", "CAST(id % 17 AS double) AS x", "CAST(2 * (id % 17) + id % 3 AS double) AS y"
    )
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    with settings(spark, {**SMALL_SKEW, **off, "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        models = fit_price(df, "y", "x", by=["k"])
        shuffled = [line for line in final_plan(models).splitlines() if line.startswith("Arguments: hashpartitioning(") and "_salt" in line]
        assert shuffled  # the hot group's rows go to as many tasks as it has parts
        assert models.agg(F.sum("n")).first()[0] == n
        hot = models.where("k = 0").first()
        rows = df.where("k = 0").toPandas()
        assert hot["mae"] == pytest.approx((rows.y - hot["slope"] * rows.x - hot["intercept"]).abs().mean())


def test_fit_without_spread_is_the_mean(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 2.0), (None, 5.0, 1.0), (None, 5.0, 2.0)], "k string, y double, x double")
    got = {r["k"]: r for r in fit_price(df, "y", "x", by=["k"]).collect()}
    assert (got["a"]["slope"], got["a"]["intercept"], got["a"]["mae"]) == (0.0, 2.0, 1.0)
    assert (got[None]["slope"], got[None]["intercept"], got[None]["r2"]) == (0.0, 5.0, None)


def test_fit_skips_unusable_text(spark):
    df = spark.createDataFrame([("1.0", "1"), ("3.0", "2"), ("n/a", "3"), (None, "4")], "y string, x string")
    assert fit_price(df, "y", "x").first()["n"] == 2


def test_samples(spark, data, rows):
    orders = spark.read.parquet(f"{data}/orders.parquet").select("o_orderkey")
    one, many = hash_sample(orders.repartition(1), "o_orderkey"), hash_sample(orders.repartition(9), "o_orderkey")
    assert rows(one) == rows(many)
    assert 0.05 < one.count() / orders.count() < 0.15
    assert hash_sample(orders, "o_orderkey", fraction=1.0).count() == orders.count()
    for almost in (1 - 2**-33, 1 - 1e-10):
        assert hash_sample(orders, "o_orderkey", fraction=almost).count() == orders.count()
    for wrong in (-0.1, 1.1):
        with pytest.raises(ValueError):
            hash_sample(orders, "o_orderkey", fraction=wrong)
    assert hash_sample(orders, "o_orderkey", fraction=0.0).count() == 0
    half = hash_sample(orders, "o_orderkey", fraction=0.5)
    assert one.exceptAll(half).count() == 0 and 0.45 < half.count() / orders.count() < 0.55
    assert 0.05 < sample_rows(orders).count() / orders.count() < 0.15


def test_hot_value_is_split_in_the_rank_joins(spark):
    """A third of all pairs share one value of the feature, each with its own label."""
    rng = np.random.default_rng(9)
    n = 120_000
    frame = pd.DataFrame({"y": rng.random(n), "x": np.where(np.arange(n) % 3 == 0, 0.5, rng.integers(0, 5000, n) / 5000)})
    df = spark.createDataFrame(frame).repartition(16)
    # A skewed partition is split along the map tasks that fed it: keep the stored tables in several.
    several_tasks = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "200KB",
        "spark.sql.files.openCostInBytes": "1KB",
    }
    with settings(spark, {**SMALL_SKEW, **several_tasks}):
        result = _spearman(df, "y", ["x"])
        text = final_plan(result)
        assert "SortMergeJoin(skew=true)" in text
        assert result.first()["spearman"] == pytest.approx(average_rank_correlation(frame, "y", "x"), abs=1e-10)
