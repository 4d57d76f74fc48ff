"""Elastic-net regression of the fare on one measure."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.casts import to_double
from tripflow.sources.writers import stored

# Settings of the published models.
MAX_ITER, REG_PARAM, ELASTIC_NET = 10, 0.3, 0.8
# Into how many parts the error pass splits a group.
SALTS = 16


def fit_price(
    df: DataFrame,
    label: str = "Fare_amount",
    feature: str = "Trip_distance",
    by: Sequence[str] = (),
    reg: float = REG_PARAM,
    alpha: float = ELASTIC_NET,
) -> DataFrame:
    """One model per group: the ``by`` columns, ``n, slope, intercept, r2, rmse, mae``.

    With one feature the elastic net has a closed form in the first two moments, so all
    groups are fitted in one aggregation. The models are stored in the shared scratch
    folder, so their size is known when the second pass, which measures the errors, joins
    them: Spark broadcasts them below its threshold and otherwise shuffles by group and one
    of ``SALTS`` parts, so that a hot group is never one task. Rows whose label or feature
    is NULL or NaN are left out.
    """
    by = list(by)
    data = df.select(
        *by, to_double(F.col(label)).alias("_y"), to_double(F.col(feature)).alias("_x")
    ).dropna(subset=["_y", "_x"])
    models = stored(_closed_form(data, by, reg, alpha), "models")
    coefficients = ["n", "slope", "intercept", "sy"]
    if by:
        keyed = models.select(
            *[F.col(c).alias(f"_{c}") for c in by],
            *coefficients,
            F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_part"),
        )
        same_group = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
        part = F.pmod(F.xxhash64("_y", "_x"), F.lit(SALTS)).cast("int").alias("_salt")
        scored = data.select("*", part).join(keyed, reduce(lambda a, b: a & b, same_group, F.col("_salt") == F.col("_part")))
    else:
        one = models.select(F.struct(*coefficients).alias("model")).scalar()
        scored = data.withColumn("_model", one).select("_y", "_x", F.lit(0).alias("_salt"), "_model.*")
    residual = F.col("_y") - F.col("slope") * F.col("_x") - F.col("intercept")
    parts = scored.groupBy(*by, "_salt").agg(
        *[F.max(c).alias(c) for c in coefficients],
        F.sum(residual * residual).alias("squares"),
        F.sum(F.abs(residual)).alias("errors"),
    )
    errors = parts.groupBy(*by).agg(
        *[F.max(c).alias(c) for c in coefficients],
        (F.sum("squares") / F.nullif(F.max("n"), F.lit(0))).alias("mse"),
        (F.sum("errors") / F.nullif(F.max("n"), F.lit(0))).alias("mae"),
    )
    r2 = 1 - F.try_divide(F.col("mse"), F.col("sy") ** 2)
    return errors.select(*by, "n", "slope", "intercept", r2.alias("r2"), F.sqrt("mse").alias("rmse"), "mae")


def _closed_form(data: DataFrame, by: Sequence[str], reg: float, alpha: float) -> DataFrame:
    moments = data.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg("_x").alias("mx"),
        F.avg("_y").alias("my"),
        F.stddev_pop("_x").alias("sx"),
        F.stddev_pop("_y").alias("sy"),
        F.covar_pop("_x", "_y").alias("cov"),
    )
    sx, sy, cov = F.col("sx"), F.col("sy"), F.col("cov")
    # Soft-thresholded, shrunk coefficient of the standardised problem; without spread
    # in either column the model is the mean.
    r = cov / (sx * sy)
    shrunk = F.signum(r) * F.greatest(F.abs(r) - alpha * reg / sy, F.lit(0.0)) / (1 + (1 - alpha) * reg / sy)
    slope = F.when((sx > 0) & (sy > 0), shrunk * sy / sx).otherwise(F.lit(0.0))
    return moments.withColumn("slope", slope).select(
        *by, "n", "slope", (F.col("my") - F.col("slope") * F.col("mx")).alias("intercept"), "sy"
    )


def fit_price_ml(
    df: DataFrame,
    label: str = "Fare_amount",
    feature: str = "Trip_distance",
    max_iter: int = MAX_ITER,
    reg: float = REG_PARAM,
    alpha: float = ELASTIC_NET,
) -> LinearRegressionModel:
    """The same model as a Spark ML object, for one group."""
    pairs = df.select(to_double(F.col(label)).alias("label"), to_double(F.col(feature)).alias("x"))
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(pairs.dropna())
    return LinearRegression(maxIter=max_iter, regParam=reg, elasticNetParam=alpha).fit(
        rows.select("label", "features")
    )


def model_metrics(model: LinearRegressionModel, df: DataFrame) -> DataFrame:
    """Coefficients and training metrics of a fitted model as a one-row table."""
    s = model.summary
    values = [model.coefficients[0], model.intercept, s.r2, s.rootMeanSquaredError, s.meanAbsoluteError]
    schema = "slope double, intercept double, r2 double, rmse double, mae double"
    return df.sparkSession.createDataFrame([tuple(float(v) for v in values)], schema)
