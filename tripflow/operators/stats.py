"""Pearson and Spearman correlation of trip measures."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.functions.casts import to_double
from tripflow.sources.writers import stored


def correlate(df: DataFrame, a: str, b: str, method: str = "pearson") -> DataFrame:
    """One row: ``label, feature, method, n, correlation``. Pairs with a NULL are left out."""
    ways = {"pearson": _pearson, "spearman": _spearman}
    if method not in ways:
        raise ValueError(f"unknown method {method}")
    return ways[method](df, a, [b]).select(
        F.lit(a).alias("label"), "feature", F.lit(method).alias("method"), "n", F.col(method).alias("correlation")
    )


def correlation_screen(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """``label, feature, n, pearson, spearman``, one row per candidate feature.

    Both come from the stored measures, so the input is read once.
    """
    names = F.array(*[F.lit(f) for f in features])
    return _both_correlations(df, label, features).select(
        F.lit(label).alias("label"), names[F.col("feature")].alias("feature"), "n", "pearson", "spearman"
    )


def _pearson(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """All features in one pass over the data."""
    y = to_double(F.col(label))
    rows = []
    for f in features:
        x = to_double(F.col(f))
        n = F.count_if(y.isNotNull() & x.isNotNull()).alias("n")
        rows.append(F.struct(F.lit(f).alias("feature"), n, F.corr(y, x).alias("pearson")))
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def _spearman(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Pearson correlation of average ranks, exact and without a global sort."""
    names = F.array(*[F.lit(f) for f in features])
    found = _both_correlations(df, label, features).where("n > 0")
    return found.select(names[F.col("feature")].alias("feature"), "n", "spearman")


def _both_correlations(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """``feature, n, pearson, spearman``, features by their place in the list.

    The measures are written once to the shared scratch folder, since every later step
    reads them. A feature's values are counted and ranked first and joined to the rows;
    what a label value needs of its rows is then a sum, so the rows are shuffled only to
    be added up by label, with all features in one row.
    """
    xs = [f"x{i}" for i in range(len(features))]
    measures = [to_double(F.col(f)).alias(x) for f, x in zip(features, xs)]
    rows = stored(
        df.select(to_double(F.col(label)).alias("y"), *measures).where(
            F.col("y").isNotNull() & F.coalesce(*xs).isNotNull()
        ),
        "measures",
    )
    ranks = _average_ranks(rows, xs)
    joined, sums, each, spreads = rows, [], [], []
    for i, x in enumerate(xs):
        # A file of its own: Spark broadcasts the ranks of a feature of few values.
        side = stored(ranks.where(F.col("feature") == i).drop("feature"), f"ranks{i}")
        joined = joined.join(
            side.select(F.col("v").alias(x), F.col("dev").alias(f"dev{i}"), F.col("rank").alias(f"rank{i}")), x, "left"
        )
        sums += [
            F.count(x).alias(f"n{i}"),
            F.coalesce(F.sum(f"dev{i}"), F.lit(0.0)).alias(f"dx{i}"),
            F.coalesce(F.sum(f"rank{i}"), F.lit(0.0)).alias(f"rx{i}"),
        ]
        each.append(F.struct(F.lit(i).alias("feature"), *[F.col(f"{c}{i}").alias(c) for c in _OF_RANGE]))
        w = F.col("w")
        spreads.append(
            side.agg(
                F.lit(i).alias("feature"),
                F.max("my").alias("my"),
                F.sum(w * F.col("dev") * F.col("dev")).alias("xx"),
                F.sum(w * F.col("rank") * F.col("rank")).alias("rxx"),
            )
        )
    spreads = reduce(DataFrame.unionByName, spreads)
    ranges = _label_ranges(joined.groupBy("y").agg(*sums), spreads, len(xs)).select("part", F.inline(F.array(*each)))

    # One row per feature and range: as few as the shuffle has partitions.
    whole = Window.partitionBy("feature")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n, mid = F.col("n"), F.col("mid")
    found = (
        ranges.withColumn("mid", F.sum("n").over(before) - n / 2 - F.sum("n").over(whole) / 2)
        .groupBy("feature")
        .agg(
            F.sum("n").alias("n"),
            F.sum("xy").alias("xy"),
            F.sum("yy").alias("yy"),
            F.sum(F.col("rxy") + mid * F.col("rx")).alias("rxy"),
            F.sum(F.col("ryy") + n * mid * mid).alias("ryy"),
        )
    )
    both = spreads.join(found, "feature", "left")
    return both.select(
        "feature",
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
        F.try_divide("xy", F.sqrt("xx") * F.sqrt("yy")).alias("pearson"),
        F.try_divide("rxy", F.sqrt("rxx") * F.sqrt("ryy")).alias("spearman"),
    )


# What a range of label values gives for a feature: rows, sum of the feature's ranks, and the
# (co)moments of deviations and of ranks, the latter with the label's ranks centred in the range.
_OF_RANGE = ["n", "rx", "xy", "yy", "rxy", "ryy"]


def _label_ranges(labels: DataFrame, means: DataFrame, k: int) -> DataFrame:
    """``part`` and ``_OF_RANGE`` of each feature, from the distinct label values and their sums.

    A label's rank is its rank inside its range plus the rows of the ranges before, which
    is the same for the whole range. The moments of a range therefore need nothing of the
    others, and the ranges, met only here, need not be stored.
    """
    my = means.agg(*[F.max(F.when(F.col("feature") == i, F.col("my"))).alias(f"my{i}") for i in range(k)])
    ranged = labels.repartitionByRange("y").withColumn("part", F.spark_partition_id())
    whole = Window.partitionBy("part").orderBy("y")
    upto_now = whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_of_it = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranks, moments = [], []
    for i in range(k):
        n, dx, rx, ry = (F.col(f"{c}{i}") for c in ("n", "dx", "rx", "ry"))
        dy = F.col("y") - F.col(f"my{i}")
        ranks.append((F.sum(n).over(upto_now) - n / 2 - F.sum(n).over(all_of_it) / 2).alias(f"ry{i}"))
        found = [F.sum(n), F.sum(rx), F.sum(dx * dy), F.sum(n * dy * dy), F.sum(rx * ry), F.sum(n * ry * ry)]
        moments += [m.alias(f"{c}{i}") for c, m in zip(_OF_RANGE, found, strict=True)]
    ranked = ranged.select("*", *ranks).crossJoin(F.broadcast(my))  # one row
    return ranked.groupBy("part").agg(*moments)


def _average_ranks(rows: DataFrame, xs: Sequence[str]) -> DataFrame:
    """``feature, v, w, dev, rank, my``: the distinct values of each feature and their rows.

    ``rank`` and the deviation ``dev`` are centred on zero, so that nothing cancels in later
    sums; ``my`` is the mean label of the feature's rows. Equal values are counted first, so
    ties cost nothing however many rows they hold. The number of rows below a value is a
    running sum inside its value range plus the totals of the ranges before. Spark's range
    partitioning makes the ranges: it balances *distinct* values, so none is large because
    of one frequent value. The range numbers are stored with the values, as they must not
    change between the two uses.
    """
    # Features travel as small numbers: they are part of every shuffled key.
    entries = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(x).alias("v")) for i, x in enumerate(xs)])
    counts = (
        rows.select("y", F.inline(entries))
        .where(F.col("v").isNotNull())
        .groupBy("feature", "v")
        .agg(F.count("*").alias("w"), F.sum("y").alias("sy"))
    )
    ranged = counts.repartitionByRange("feature", "v").withColumn("part", F.spark_partition_id())
    values = stored(ranged, "value_counts")
    upto_now = (Window.unboundedPreceding, Window.currentRow)
    # One row per range: as few as the shuffle has partitions.
    whole = Window.partitionBy("feature")
    before = whole.orderBy("part").rowsBetween(*upto_now)
    totals = (
        values.groupBy("feature", "part")
        .agg(F.sum("w").alias("total"), F.sum(F.col("w") * F.col("v")).alias("sv"), F.sum("sy").alias("sy"))
        .select(
            "feature",
            "part",
            (F.sum("total").over(before) - F.col("total")).alias("below"),
            F.sum("total").over(whole).alias("n"),
            (F.sum("sv").over(whole) / F.sum("total").over(whole)).alias("mx"),
            (F.sum("sy").over(whole) / F.sum("total").over(whole)).alias("my"),
        )
    )
    inside = Window.partitionBy("feature", "part").orderBy("v").rowsBetween(*upto_now)
    rank = F.col("below") + F.col("upto") - (F.col("w") - 1) / 2
    return (
        values.drop("sy")
        .withColumn("upto", F.sum("w").over(inside))
        .join(F.broadcast(totals), ["feature", "part"])
        .select(
            "feature", "v", "w", (F.col("v") - F.col("mx")).alias("dev"), (rank - (F.col("n") + 1) / 2).alias("rank"), "my"
        )
    )
